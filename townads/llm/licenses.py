"""License notices in texts, as column expressions.

Texts and templates become runs of five-word shingles. Every template's windows of 1, 2 or 4 shingles
(the largest size it holds) are min-hashed into bands; so are all windows of a text, one word apart. A
text window with a band value of a template retrieves it and the place where it would begin; there the
exact share of the template's shingles is taken. A template of one to four words is one shingle of that
many words, looked for among the runs of as many words of a text.

Guarantee: a band is one min-hash (a random order of shingle hashes), so windows of Jaccard similarity
s share one of the two bands with probability 1 - (1 - s)^2, and equal windows always do. A template of
n shingles found to at least 0.8 leaves an intact run: all of it for n < 5; for n < 25 edits can only be
near its ends, as one inside costs five shingles; for larger n the intact shingles fall into at most
n / 25 + 1 runs of on average at least ten. A run of four or more contains an equal window, hence no
match of 0.8 or more is missed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm.frames import table

SHINGLE = 5
SIMILARITY = 0.8
MAX_TEMPLATES = 2000  # they become constants of the plan
# Random orders of shingle hashes, one for each band.
BANDS = (0x1B873593CC9E2D51, 0x52DCE729DA3ED7B5)

# Notices as licences ask to give them, and sentences of their texts (fixed values).
TEMPLATES = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    "gpl-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    "cc-by-nc-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "cc-by-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "bsd-3-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
}


def with_shingles(rows: DataFrame, text: str, run: str, short: Iterable[int] = ()) -> DataFrame:
    """Adds the hashes of all runs of five words, in order, in place of the text, and those of ``short`` numbers
    of words in columns with that number at the end; words are runs of letters (lower-cased), digits and
    non-ASCII characters."""
    words = F.array_remove(F.split(F.lower(F.col(text)), r"[\x00-/:-`{-\x7F]+"), "")
    hashes = F.col(run)

    def runs(n: int) -> Column:
        def hashed(h: Column, i: Column) -> Column:
            return F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, n)))

        return F.slice(F.transform(hashes, hashed), F.lit(1), F.greatest(F.size(hashes) - (n - 1), F.lit(0)))

    # In steps: an array that a lambda reads must be a column, or it is made anew for every element.
    hashed_words = rows.withColumn(run, F.transform(words, lambda w: F.xxhash64(w))).drop(text)
    # The run itself last and alone: a lambda beside it would read the new column.
    return hashed_words.withColumns({f"{run}{n}": runs(n) for n in short}).withColumn(run, runs(SHINGLE))


def _window_min(run: Column, h: Column, i: Column, size: int, band: int) -> Column:
    keys = [h.bitwiseXOR(F.lit(band)), *(F.get(run, i + k).bitwiseXOR(F.lit(band)) for k in range(1, size))]
    return F.least(*keys) if size > 1 else keys[0]


def _retrieving(run: Column, kind: int, size: int, band: int, values: list[int]):
    """For each place of a text the band value there, if a template has it."""

    def place(h: Column, i: Column) -> Column:
        key = _window_min(run, h, i, size, band)
        return F.when(key.isin(values), F.struct(F.lit(kind).alias("kind"), key.alias("key"), i.alias("at")))

    return place


def _bands(size: int) -> tuple[int, ...]:
    return BANDS if size > 1 else BANDS[:1]  # all orders of one shingle are the same


def _size(n: int) -> int:
    return 4 if n >= 4 else 2 if n >= 2 else 1


def _templates(spark: SparkSession, templates: dict[str, tuple[str, ...]]) -> list[tuple[str, int, list[int]]]:
    """Licence, words of a shingle and shingles of each template."""
    rows = [(name, text) for name, texts in templates.items() for text in texts]
    if len(rows) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    made = with_shingles(spark.createDataFrame(rows, "name string, text string"), "text", "run", range(1, SHINGLE))
    found = []
    for row in made.collect():
        runs = {SHINGLE: row["run"]} | {n: row[f"run{n}"] for n in range(SHINGLE - 1, 0, -1)}
        length = next((n for n, run in runs.items() if run), 0)
        if not length:
            raise ValueError("a template needs a word")
        found.append((row["name"], length, runs[length]))
    return found


def scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """Licences found in each text: rows (id, ``license``, ``containment``, ``at``).

    ``containment`` is the largest share of a template's distinct shingles found in one place: from a
    quarter of the template's length before the place where it begins to a quarter after its end;
    ``at`` is the word where the first such place begins. Only shares of ``similarity`` or more count.

    Nulls and edges: null and empty texts hold no licence; rows with null or repeated ids
    are judged one by one, and equal rows give equal results as often as they occur; other columns are
    not read. Notices that differ in a single word (versions of one licence) can both reach the threshold;
    the larger containment tells them apart. Templates are a list of bounded size with at least one word each;
    one of fewer than five words counts where it stands unchanged.
    """
    known = _templates(docs.sparkSession, templates)
    run = F.col("run")
    hits = []
    bands: dict[tuple[int, int, int], dict[int, list[tuple[int, int]]]] = {}
    for t, (_, length, shingled) in enumerate(known):
        size = _size(len(shingled))
        for band in _bands(size):
            for at in range(len(shingled) - size + 1):
                signed = [_signed((h ^ band) & (2**64 - 1)) for h in shingled[at : at + size]]
                bands.setdefault((length, size, band), {}).setdefault(min(signed), []).append((t, at))
    short = sorted({length for _, length, _ in known if length < SHINGLE})
    own = run  # the runs that a hit was found in
    for kind, ((length, size, band), keys) in enumerate(bands.items()):
        source = run if length == SHINGLE else F.col(f"run{length}")
        hits.append(F.array_compact(F.transform(source, _retrieving(source, kind, size, band, sorted(keys)))))
        if length < SHINGLE:
            own = F.when(F.col("hit.kind") == kind, source).otherwise(own)
    runs = ["run", *(f"run{n}" for n in short)]
    retrieved = docs.sparkSession.createDataFrame(
        [(k, key, t, at) for k, keys in enumerate(bands.values()) for key, found in keys.items() for t, at in found],
        "kind int, key long, template int, offset int",
    )
    described = docs.sparkSession.createDataFrame(
        [(t, name, sorted(set(shingled)), len(shingled)) for t, (name, _, shingled) in enumerate(known)],
        "template int, license string, wanted array<bigint>, n int",
    )
    longest = max(len(shingled) for _, _, shingled in known)
    reach = longest + longest // 4 + 1
    found = (
        with_shingles(
            docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.col(text).alias("text")),
            "text",
            "run",
            short,
        )
        .select("row", "id", *runs, (F.concat(*hits) if len(hits) > 1 else hits[0]).alias("hits"))
        # An outer explode: a filter on the arrays would move down and make them anew for every element.
        .select("row", "id", *runs, F.explode_outer("hits").alias("hit"))
        .where("hit IS NOT NULL")
        # Only the surroundings of a hit go on, so a text with many notices is not copied for each.
        .select(
            "row",
            "id",
            "hit.*",
            F.greatest(F.col("hit.at") - reach, F.lit(0)).alias("base"),
            F.slice(own, F.greatest(F.col("hit.at") - reach, F.lit(0)) + 1, F.lit(2 * reach)).alias("near"),
        )
        .join(retrieved, ["kind", "key"])
        .join(described, "template")
    )
    start = F.col("at") - F.col("offset")
    slack = F.floor(F.col("n") / 4).cast("int")
    low = F.greatest(start - slack, F.col("base"))
    there = F.slice("near", low - F.col("base") + 1, start + F.col("n") + slack - low)
    share = F.size(F.array_intersect("wanted", there)) / F.size("wanted")
    best = F.struct(share.alias("containment"), (-start).alias("minus_at"))
    return (
        found.select("row", "id", "license", best.alias("best"))
        .where(F.col("best.containment") >= similarity)
        .groupBy("row", "id", "license")
        .agg(F.max("best.containment").alias("containment"), F.min(-F.col("best.minus_at")).alias("first"))
        .select(
            F.col("id").alias(id), "license", "containment", F.greatest("first", F.lit(0)).cast("long").alias("at")
        )
    )


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents."""
    return scan(table(spark, sf_dir, "documents")).select("doc_id", "license", "containment")


QUERIES = {"op4_license_scan": op4_license_scan}


def _oracle() -> str:
    """Every place of every text against every template, without bands."""
    rows = [(name, text.replace("'", "''")) for name, texts in TEMPLATES.items() for text in texts]
    values = ", ".join(f"('{name}', '{text}')" for name, text in rows)
    words = r"list_filter(regexp_split_to_array(lower({0}), '[\x00-/:-`{{-\x7F]+'), lambda x: x <> '')"
    run = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))"
    return f"""
WITH template AS (
  SELECT license, {run} AS run FROM (SELECT license, {words.format('t')} AS w FROM (VALUES {values}) v(license, t))
), text AS (
  SELECT doc_id, {run} AS run FROM (SELECT doc_id, {words.format('text')} AS w FROM documents WHERE text IS NOT NULL)
), likely AS (
  SELECT doc_id, license, text.run AS run, template.run AS wanted, len(template.run) AS n
  FROM (
    SELECT DISTINCT a.doc_id, b.run AS wanted
    FROM (SELECT doc_id, unnest(run) AS shingle FROM text) a JOIN (SELECT run, unnest(run) AS shingle FROM template) b USING (shingle)
  ) JOIN text USING (doc_id) JOIN template ON wanted = template.run
), place AS (
  SELECT doc_id, license, run, wanted, n, unnest(range(1 - n, len(run) + 1)) AS s FROM likely
), shares AS (
  SELECT doc_id, license, len(list_filter(list_distinct(wanted),
      lambda x: list_contains(list_slice(run, greatest(s - n // 4, 0) + 1, s + n + n // 4), x)))
    / len(list_distinct(wanted)) AS containment
  FROM place
)
SELECT doc_id, license, max(containment) AS containment FROM shares
WHERE containment >= 0.8 GROUP BY doc_id, license
"""


ORACLE = {"op4_license_scan": _oracle()}
