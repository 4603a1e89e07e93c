"""Language of texts: first the family, then the language within it, by linear support vector machines.

Every pair of families has one machine and so has every pair of languages of one family. Votes decide,
the sum of margins breaks ties. Features are the hashed runs of one to three bytes of the whole text;
they are counted in tasks, where the broadcast weights (of size machines x FEATURES) are applied, too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townads.llm.frames import stored, table
from townads.llm.words import FOLDED, buffers, parts

FEATURES = 2048
UNKNOWN = "und"
# About so many texts of each language are learnt from, chosen by a hash of the id.
TRAINING_TEXTS = 1500
BATCH_BYTES = 3 << 20

# Families of languages (fixed values); a language not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk"),
    "indo-aryan": ("hi", "bn", "ur", "mr", "gu", "pa"),
    "semitic": ("ar", "he"),
}
_FAMILY = {language: family for family, languages in FAMILIES.items() for language in languages}

_LETTER = FOLDED.copy()
_LETTER[0x30:0x3A] = 0


def _has_letter(data: np.ndarray) -> bool:
    kinds = _LETTER[data]
    if ((kinds >= 0x61) & (kinds <= 0x7A)).any():
        return True
    return bool(kinds.any()) and any(map(str.isalpha, data.tobytes().decode()))


def features(data: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed byte runs, per length of run; the bytes are of one text."""
    folded = np.where((data >= 0x41) & (data <= 0x5A), data + 32, data).astype(np.uint32)
    out = np.zeros(FEATURES, dtype=np.float32)
    key = folded
    for length in (1, 2, 3):
        if length > 1:
            key = key[:-1] * np.uint32(257) + folded[length - 1 :] + np.uint32(1)
        if len(key):
            slot = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - FEATURES.bit_length() + 1)
            out += np.bincount(slot, minlength=FEATURES).astype(np.float32) / len(key)
    return np.sqrt(out / 3)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in (part for batch in batches for part in parts(batch, "text", BATCH_BYTES)):
        data, offsets = buffers(rows["text"])
        made = [features(data[a:b]).tolist() for a, b in zip(offsets[:-1], offsets[1:])]
        yield from pa.table({"lang": rows["lang"], "features": pa.array(made, pa.list_(pa.float32()))}).to_batches()


class Model:
    """Families and languages with the machines of each pair: weights and offset, positive for the first."""

    def __init__(self, families: dict[str, list[str]], machines: dict[tuple[str, str], tuple[np.ndarray, float]]):
        self.families = families
        self.pairs = list(machines)
        self.weights = np.array([machines[p][0] for p in self.pairs], dtype=np.float32).reshape(-1, FEATURES)
        self.offsets = np.array([machines[p][1] for p in self.pairs], dtype=np.float32)

    def _best(self, names: list[str], margins: np.ndarray, share: float) -> tuple[str, float]:
        votes = {name: [0, 0.0] for name in names}
        for (a, b), m in zip(self.pairs, margins.tolist()):
            if a in votes and b in votes:
                votes[a if m > 0 else b][0] += 1
                votes[a][1] += m
                votes[b][1] -= m
        best = max(names, key=lambda name: votes[name])
        for (a, b), m in zip(self.pairs, margins.tolist()):
            if best in (a, b) and a in votes and b in votes:
                share = min(share, float(1 / (1 + np.exp(-4 * (m if best == a else -m)))))
        return best, share

    def predict(self, data: np.ndarray) -> tuple[str, float]:
        if not self.families or not _has_letter(data):
            return UNKNOWN, 0.0
        margins = self.weights @ features(data) + self.offsets
        family, share = self._best(sorted(self.families), margins, 1.0)
        return self._best(self.families[family], margins, share)


def train(texts: DataFrame, per_language: int = TRAINING_TEXTS) -> Model:
    """Learns from rows (``key``, ``text``, ``lang``) without nulls: about ``per_language`` texts of each
    language, those with the least hashes of their keys; this bounds what is learnt from at any size."""
    counts = {row["lang"]: row["count"] for row in texts.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    chosen = F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < share * (1 << 20)
    sample = stored(
        texts.where(chosen).select("lang", "text").mapInArrow(_featured, "lang string, features array<float>"), "languages"
    ).select("lang", array_to_vector(F.col("features").cast("array<double>")).alias("features"))
    present = sorted(row["lang"] for row in sample.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for lang in present:
        families.setdefault(f"family {_FAMILY.get(lang, lang)}", []).append(lang)
    family = F.lit(None).cast("string")
    for name, languages in families.items():
        family = F.when(F.col("lang").isin(languages), F.lit(name)).otherwise(family)
    machines = {}
    for pairs, of in ((combinations(sorted(families), 2), family), *((combinations(x, 2), F.col("lang")) for x in families.values())):
        for a, b in pairs:
            rows = sample.where(of.isin(a, b)).select((of == a).cast("double").alias("label"), "features")
            fitted = LinearSVC(maxIter=40, regParam=1e-4, standardization=False).fit(rows.coalesce(4))
            machines[a, b] = (fitted.coefficients.toArray(), float(fitted.intercept))
    return Model(families, machines)


def _predicted(model, kept: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            made = [model.value.predict(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
            columns = [batch.column(n) for n in kept]
            columns += [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "lang_pred", "score"])

    return run


def identify(rows: DataFrame, model: Model, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The rows, without ``text`` unless it is to be kept, with ``lang_pred`` and ``score``.

    The score is the least certainty (a logistic of the margin) among the machines that the language and
    its family had to win, 0 to 1. A null text, or one without any letter, is ``und`` with score 0, and
    so is every text if nothing was learnt; with a single language known its score is 1. Columns that
    are called ``lang_pred`` or ``score`` already are replaced.
    """
    kept = [f for f in rows.schema.fields if f.name not in ("lang_pred", "score") and (keep_text or f.name != text)]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string", "score double"])
    weights = rows.sparkSession.sparkContext.broadcast(model)
    own = rows.select(*(F.col(f"`{f.name}`") for f in kept if f.name != text), F.col(text).alias("text"))
    names = ["text" if f.name == text else f.name for f in kept]
    made = own.mapInArrow(_predicted(weights, names), ddl.replace(f"`{text}` ", "`text` "))
    return made.withColumnRenamed("text", text) if keep_text else made


def held_out(id: str) -> Column:
    """Every third row by the checksum of its id; never learnt from. A null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 3 == 1, F.lit(False))


def learnt(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """A model from the rows that are not held out and have an id, a text and a language."""
    known = docs.where(~held_out(id)).select(F.col(id).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    return train(known.dropna())


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents, learnt from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", held_out("doc_id").alias("held_out"), "text"), learnt(docs))


QUERIES = {"op10_language_id": op10_language_id}
