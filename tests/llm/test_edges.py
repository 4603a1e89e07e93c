"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

from __future__ import annotations

import json
import random
from itertools import combinations

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from townads.llm import (
    bpe,
    decontamination,
    frames,
    language,
    licenses,
    neighbours,
    similar,
    substrings,
    token_counts,
    tool_calls,
    url_filter,
    vocabulary,
    words,
)
from townads.session import scratch_folder

WORDS = public_tokenizers.path("word_bpe_49k.json")
PASSAGE = " ".join(f"w{i}" for i in range(30))
NOTICE = "Licensed under the Apache License, Version 2.0."


def _texts():
    draw = random.Random(3)
    filler = lambda n: " ".join(f"{draw.choice('abcdef')}{draw.randrange(90000)}" for _ in range(n))
    long = filler(60000)
    return [
        (1, f"{filler(20)} {PASSAGE} {filler(5)}"),
        (2, f"{PASSAGE} {filler(300)}"),
        (2, f"{filler(3)} {PASSAGE}"),
        (2, f"{filler(3)} {PASSAGE}"),
        (3, None),
        (4, ""),
        (5, " \t\n"),
        (6, "one two"),
        (7, "One, two!"),
        (None, f"{filler(40)} {PASSAGE}"),
        (None, None),
        (8, long),
        (9, long + " end"),
        (10, "x" * 5000),
        (11, f"{NOTICE} Éa ñ ß 数 {filler(4)}"),
        (12, "a " * 400),
        (13, "a " * 400),
        (-5, PASSAGE.upper()),
        (14, "12 34 !! 56"),
    ]


CLASHING = ("id", "own_id", "row", "node", "values", "block", "bucket", "count", "label", "score", "key", "path")


def _frame(spark, rows, text="text"):
    frame = spark.createDataFrame(rows, f"doc_id long, {text} string").repartition(3)
    frame = frame.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    return frame.withColumn("n_chars", F.length(text).cast("long")).withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="module")
def docs(spark):
    return frames.stored(_frame(spark, _texts()), "edges")


@pytest.fixture(scope="module")
def none(spark):
    return _frame(spark, [])


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, PASSAGE), (2, "one two"), (3, None), (4, ""), (None, "a a a"), (5, "a a a a"), (6, PASSAGE)]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("id", F.lit("x"))


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def same(frame, expected):
    assert rows(frame) == sorted(expected, key=repr)


ITEMS = [(1, PASSAGE), (2, "one two"), (None, "a a a"), (5, "a a a a"), (6, PASSAGE)]


def test_contamination(docs, items, none):
    same(decontamination.verdicts(docs, items), brute.contamination(_texts(), ITEMS))
    same(decontamination.verdicts(docs, items.limit(0)), brute.contamination(_texts(), []))
    assert rows(decontamination.verdicts(none, items)) == []


def test_contamination_in_blocks(docs, items, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 14)
    same(decontamination.verdicts(docs, items), brute.contamination(_texts(), ITEMS))


def test_long_item_is_cut_into_blocks(spark, monkeypatch):
    item = " ".join(f"u{i}" for i in range(200))
    texts = [(1, item), (2, f"x {' '.join(item.split()[40:90])} y"), (3, PASSAGE), (4, " ".join(item.split()[:12]))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, PASSAGE)], "item_id long, text string")
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 300)
    blocks = list(decontamination._blocks(items, "item_id", "text", 13))
    assert len(blocks) > 5 and all(first[-1] < 300 + 13 for _, _, first, _ in blocks)
    same(decontamination.verdicts(docs, items), brute.contamination(texts, [(1, item), (2, PASSAGE)]))


def test_contamination_in_shards_of_equal_words(spark, monkeypatch):
    # Partitions of several shards each that hold the same words: names of shards must not meet.
    texts = [(i, f"{PASSAGE} {PASSAGE}" if i % 3 else " ".join(reversed(PASSAGE.split()))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 1)
    index = decontamination.build_index(docs, scratch_folder(spark, "shards"))
    assert index.where("bucket = -1").count() == index.select("shard").distinct().count() == 60
    same(decontamination.verdicts(docs, items), brute.contamination(texts, [(1, PASSAGE)]))


def test_proximity(spark, items):
    docs = spark.createDataFrame([(1, "b x a y c"), (2, "a b"), (3, "c b a"), (4, "a x x x x b c")], "doc_id long, text string")
    wanted = spark.createDataFrame([(7, "a b c")], "item_id long, text string")
    index = decontamination.build_index(docs, scratch_folder(spark, "near"))
    found = decontamination.find_phrases(index, wanted, length=None, span=5)
    assert rows(found.select("id", "items")) == [(1, [7]), (2, []), (3, [7]), (4, [])]
    assert rows(decontamination.find_phrases(index, wanted, length=None).select("id", "items")) == [(i, []) for i in (1, 2, 3, 4)]


def test_repeats(docs, none):
    expected = [(d, n, n - len(kept), " ".join(kept)) for d, n, kept in brute.repeats(_texts())]
    same(substrings.remove_repeats(docs, outputs=("n_words", "n_removed", "kept")), expected)
    carried = substrings.remove_repeats(docs, outputs=("left", "removed"), carried=("id", "values"))
    assert carried.columns == ["doc_id", "id", "values", "left", "removed"]
    by_id = {r.doc_id: r for r in carried.collect()}
    assert by_id[3].left is None and by_id[5].left == " \t\n" and by_id[13].left == ""
    assert rows(substrings.remove_repeats(none)) == []


def test_near_copies(docs, none):
    found = similar.near_copies(docs)
    same(found.select("doc_id", "class_id", "n_links"), brute.near_copies(_texts()))
    assert rows(similar.near_copies(none)) == []


def test_near_copies_in_large_groups(spark, monkeypatch):
    draw = random.Random(5)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(60):
        own = list(base)
        for _ in range(draw.randrange(3)):
            own[draw.randrange(200)] = f"new{i}"
        texts.append((i, " ".join(own)))
    texts += [(100 + i, " ".join(base[:40] + [f"z{i}-{j}" for j in range(200)])) for i in range(30)]
    monkeypatch.setattr(similar, "SMALL", 4)
    monkeypatch.setattr(similar, "BLOCK_NODES", 7)
    found = similar.near_copies(_frame(spark, texts))
    same(found.select("doc_id", "class_id", "n_links"), brute.near_copies(texts))


def test_licences(docs, none):
    assert rows(licenses.scan(docs).select("doc_id", "license", "containment")) == [(11, "apache-2.0", 1.0)]
    assert rows(licenses.scan(none)) == []


def test_licence_with_edits(spark):
    mit = licenses.TEMPLATES["mit"][2].split()
    edited = " ".join(["lead"] * 9 + mit[:2] + ["inserted"] + mit[2:])
    far = " ".join(x for w in mit for x in (w, "x"))
    docs = spark.createDataFrame([(1, edited), (1, edited), (2, far)], "doc_id long, text string")
    found = rows(licenses.scan(docs).select("doc_id", "license"))
    assert found == [(1, "mit"), (1, "mit")]


def test_licences_of_few_words(spark):
    templates = {"reserved": ("All rights reserved.",), "one": ("Copyleft",), "apache-2.0": licenses.TEMPLATES["apache-2.0"]}
    texts = ["(c) us. ALL RIGHTS, reserved!", "all rights", "all the rights reserved", f"copyleft {NOTICE} All rights reserved", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = rows(licenses.scan(docs, templates=templates).where("containment = 1").select("doc_id", "license", "at"))
    assert found == [(0, "reserved", 2), (3, "apache-2.0", 0), (3, "one", 0), (3, "reserved", 9)]
    with pytest.raises(ValueError):
        licenses.scan(docs, templates={"none": ("...",)})


def test_encoding(docs, none):
    model = Tokenizer.from_file(WORDS)
    ids = [(d, model.encode(t or "", add_special_tokens=False).ids) for d, t in _texts()]
    coded = bpe.encode(docs, WORDS, outputs=("ids", "decoded"))
    same(coded, [(d, x, model.decode(x, skip_special_tokens=False)) for d, x in ids])
    again = bpe.decode(coded.drop("decoded"), WORDS)
    same(again, rows(coded))
    assert rows(bpe.encode(none, WORDS)) == []
    with pytest.raises(ValueError):
        bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t\x1c\x85 Σ'İ́<|endoftext|>")), max_size=60))
def test_words_have_the_tokens_of_the_text(text):
    model = Tokenizer.from_file(WORDS) if not hasattr(test_words_have_the_tokens_of_the_text, "m") else test_words_have_the_tokens_of_the_text.m
    test_words_have_the_tokens_of_the_text.m = model
    parts = [w.decode() for w in text.encode().split()]
    together = [i for e in model.encode_batch(parts, add_special_tokens=False) for i in e.ids]
    assert together == model.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts(name, spark, docs, none):
    path, cache = public_tokenizers.path(name), scratch_folder(spark, "cache")
    coder = vocabulary.Encoder(vocabulary.shipped(spark, path))
    expected = [(d, len((t or "").encode()), len(coder.ids([t or ""])[0])) for d, t in _texts()]
    same(token_counts.count_tokens(docs, path, cache), expected)
    before = spark.read.parquet(cache).count()
    same(token_counts.count_tokens(docs, path, cache), expected)
    assert spark.read.parquet(cache).count() == before  # nothing was encoded again
    assert rows(token_counts.count_tokens(none, path, cache)) == []


def test_urls(spark):
    links = spark.createDataFrame(
        [
            ("http://a.net/1", "http://b.com/de/x"),
            ("https://B.com/de/x/?utm_source=q#f", "http://c.net/"),
            ("http://d.net/", "http://b.example.org/es/1"),
            ("http://d.net/", "http://e.org/ok"),
            ("http://lonely.net/", None),
            (None, None),
            ("nothing", "http://c.net/"),
        ],
        "a string, b string",
    )
    pages = spark.createDataFrame(
        [
            (1, "http://a.net:80/1"), (2, "http://b.com/de/x"), (3, "http://c.net"), (3, "http://c.net"),
            (4, "http://d.net"), (5, "http://B.Example.ORG/es/1"), (6, "http://e.org/ok"), (7, None), (8, "nothing"),
            (None, "http://x.com/fr/de"), (9, "http://x.example.org/en/1/2"), (10, "http://notorg/"), (11, "ftp://x.org"),
        ],
        "page_id long, url string",
    ).withColumn("node", F.lit("x")).withColumn("group", F.lit("y"))
    got = rows(url_filter.judge(pages, links).select("page_id", "rule", "verdict"))
    expected = [
        (1, None, "block"), (2, "com/de/", "block"), (3, None, "block"), (3, None, "block"), (4, None, "allow"),
        (5, "example.org/es/", "block"), (6, "org/", "allow"), (7, None, "allow"), (8, None, "allow"),
        (None, "com/fr/", "allow"), (9, "example.org/en/1", "block"), (10, None, "allow"), (11, None, "allow"),
    ]
    assert got == sorted(expected, key=repr)
    assert rows(url_filter.judge(pages.limit(0), links)) == []


def test_page_links(spark):
    pages = spark.createDataFrame(
        [
            ("http://a.net/x/y?q", "<LINK href='/z' rel='canonical'>"),
            ("http://a.net/x/y", '<meta http-equiv="refresh" content="0; url=w">'),
            ("http://a.net/x", "<link rel=canonical href=//b.net/k>"),
            ("http://a.net/x", "<a rel='canonical' href='/no'>"),
            ("http://a.net/x", None),
            (None, "<link rel=canonical href=/z>"),
        ],
        "url string, html string",
    )
    got = [b for _, b in rows(url_filter.page_links(pages))]
    assert sorted(got) == ["http://a.net/x/w", "http://a.net/z", "http://b.net/k"]


def test_page_links_of_both_kinds(spark):
    here = "http://a.net/x"
    html = (
        "<link rel=canonical href='http://a.net/x'><link rel=canonical><link rel=canonical href=/k><link rel=canonical href=/k>"
        '<meta http-equiv=refresh content="5"><meta http-equiv=refresh content="0; url=http://b.com/de/x">'
    )
    pages = spark.createDataFrame([(1, here, html), (2, "http://b.com/de/x", None), (3, "http://a.net/k", "")], "page_id long, url string, html string")
    links = url_filter.page_links(pages)
    assert rows(links) == [(here, "http://a.net/k"), (here, here), (here, "http://b.com/de/x")]
    assert {r.verdict for r in url_filter.judge(pages, links).collect()} == {"block"}


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (41, 40)]
    edges += [(200 + draw.randrange(30), 230 + draw.randrange(30)) for _ in range(60)]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = frames.components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(got) == sorted(label.items(), key=repr)
    assert rows(frames.components(spark.createDataFrame([], "a long, b long"))) == []


def test_neighbours(spark):
    good = [(i, [1.0, float(i), 0.5]) for i in range(1, 8)]
    bad = [(20, None), (21, [0.0, 0.0, 0.0]), (22, [1.0, None, 2.0]), (23, [float("nan"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (24, [float("inf"), 1.0, 1.0])]
    twins = [(i, [5.0, 5.0, 5.0]) for i in range(30, 37)]
    table = spark.createDataFrame(good + bad + twins, "vec_id long, embedding array<double>").withColumn("exact", F.lit("x"))
    queries = spark.createDataFrame([(i,) for i in (1, 20, 21, 33, 99)], "id long")
    got = rows(neighbours.nearest(table, queries))
    assert {g[0] for g in got} == {1, 33}
    assert [g[2] for g in got if g[0] == 33] == [30, 31, 32, 34, 35]
    assert [g[1] for g in got if g[0] == 1] == [1, 2, 3, 4, 5]
    two = spark.createDataFrame(good[:2], "vec_id long, embedding array<double>")
    assert [g[:3] for g in rows(neighbours.nearest(two, queries))] == [(1, 1, 2)]
    assert rows(neighbours.nearest(two.limit(0), queries)) == []


def test_neighbours_among_copies(spark):
    draw = np.random.default_rng(6)
    # Many copies, a dense group of vectors that differ in the fourth decimal, and others.
    dense = draw.standard_normal(16) + 2e-4 * draw.standard_normal((600, 16))
    x = np.concatenate([np.tile(draw.standard_normal(16), (600, 1)), dense, draw.standard_normal((300, 16))])
    ids = draw.permutation(len(x))
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(4)
    asked = [int(i) for i in (*ids[:8], *ids[600:660])]
    got = {}
    for q, rank, other, _ in rows(neighbours.nearest(table, spark.createDataFrame([(i,) for i in asked], "id long"))):
        got.setdefault(q, {})[rank] = other
    copies = sorted(int(i) for i in ids[:600])
    for q in asked[:8]:
        assert [got[q][r] for r in range(1, 6)] == [i for i in copies if i != q][:5]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = 0
    for q, at in zip(asked[8:], range(600, 660)):
        apart = np.linalg.norm(unit - unit[at], axis=1)
        apart[at] = 9
        found += len({int(i) for i in ids[np.argsort(apart)[:5]]} & set(got[q].values()))
    assert found >= 0.9 * 5 * 60


def test_votes_and_scores(spark):
    # Random machines: the winner of a round often loses single ones, and votes are often equal.
    draw = np.random.default_rng(5)
    families = {"f1": ["a", "b", "c"], "f2": ["d"], "f3": ["e", "f", "g", "h"]}
    pairs = [p for names in (families, *families.values()) for p in combinations(sorted(names), 2)]
    machines = {p: (draw.normal(0, 3, language.FEATURES), float(draw.normal(0, 0.3))) for p in pairs}
    pick = random.Random(5)
    texts = [(d, t) for d, t in _texts() if d not in (8, 9)]
    texts += [(100 + i, "".join(pick.choices("abcXYZ éß数 .7", k=pick.randrange(1, 40)))) for i in range(150)]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in language.identify(docs, language.Model(families, machines)).collect()}
    assert len(got) == len(texts)
    for i, (_, text) in enumerate(texts):
        name, score = brute.language_of(text, families, machines, language.FEATURES)
        assert got[i].lang_pred == name and got[i].score == pytest.approx(score, abs=1e-4), text
    assert len({r.lang_pred for r in got.values()}) > 5 and min(r.score for r in got.values() if r.lang_pred != "und") < 0.5


def test_language(spark, docs, none):
    draw = random.Random(2)
    kinds = {"en": "the and ing tion", "de": "der und ung sch", "fr": "le eau oux ment", "es": "el ción ado ñ"}
    make = lambda k: " ".join(draw.choice(kinds[k].split()) + draw.choice("aeiou") for _ in range(30))
    texts = [(i, make(k), k) for i, k in enumerate(list(kinds) * 30)] + [(900, None, "en"), (901, "x", None), (None, "y", "en")]
    known = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    model = language.learnt(known)
    told = language.identify(known.select("doc_id", "text", F.lit(1).alias("score")), model)
    got = {r.doc_id: r.lang_pred for r in told.collect()}
    assert all(got[i] == k for i, _, k in texts[:120]) and got[900] == "und"
    asked = {r.doc_id: r for r in language.identify(docs.select("doc_id", "text", "id", "path"), model).collect()}
    assert {d for d, r in asked.items() if r.lang_pred == "und"} >= {3, 4, 5, 14}
    assert asked[8].lang_pred != "und" and asked[14].score == 0
    nothing = language.learnt(none)
    assert {r.lang_pred for r in language.identify(docs.select("doc_id", "text"), nothing).collect()} == {"und"}
    assert rows(language.identify(none.select("doc_id", "text"), model)) == []


def test_arguments_that_cannot_be_written(spark):
    schema = "conversation long, call_id string, after array<string>, name string, arguments string"
    texts = {
        "half": '{"text":"\\ud800","n_words":1}',
        "pair": '{"text":"\\ud83d\\ude00","n_words":1}',
        "name": '{"\\udc00":1}',
        "endless": '{"text":"x","n_words":1e999}',
        "whole": '{"text":"x","n_words":1.0}',
        "part": '{"text":"x y","n_words":1.5}',
    }
    calls = spark.createDataFrame([(1, k, None, "measure", v) for k, v in texts.items()], schema)
    results = spark.createDataFrame([], "conversation long, call_id string, content string")
    got = {r.call_id: r for r in tool_calls.link(calls, results, tool_calls.SCHEMAS).collect()}
    assert {k for k, r in got.items() if r.errors == ["arguments are no JSON"]} == {"half", "name", "endless"}
    assert {k for k, r in got.items() if r.valid} == {"pair", "whole"}
    assert json.loads(got["half"].record)["arguments"] is None and "\U0001f600" in got["pair"].record


def test_equal_as_json():
    enum = lambda value, *among: tool_calls.errors(value, {"enum": list(among)})
    assert enum(True, 1) and enum(0, False) and enum([True], [1]) and enum("1", 1) and enum({"a": 1}, {"a": True})
    assert not enum(1.0, 1) and not enum({"a": [1, None]}, {"a": [1.0, None]}) and not enum(True, 1, True)
    assert tool_calls.errors(True, {"type": "number"}) and not tool_calls.errors(True, {"type": "boolean"})
    assert tool_calls.errors(float("inf"), {"type": "integer"}) and not tool_calls.errors(2.0, {"type": "integer"})


def test_tool_calls(spark):
    schema = "conversation long, call_id string, after array<string>, name string, arguments string"
    ok = '{"n_words": 1, "text": "é\\u0041"}'
    calls = spark.createDataFrame(
        [
            (1, "a", None, "measure", ok),
            (1, "b", ["a", "gone"], "measure", '{"text":"x"}'),
            (1, "c", ["a", "b", "b"], "measure", None),
            (1, "d", ["e"], "measure", ok),
            (1, "e", ["d"], "other", ok),
            (1, "f", ["e"], "measure", '{"n_words":1,"n_words":2,"text":"x"}'),
            (1, "g", ["g"], "measure", '{"n_words":true,"text":"x"}'),
            (2, "a", [], "measure", '{"n_words":99,"text":"x","more":[1.50,{"z":1,"y":null}]}'),
            (2, "a", [], "measure", '{"n_words":99,"text":"x","more":[1.50,{"z":1,"y":null}]}'),
            (None, "a", [], "measure", ok),
            (2, None, [], "measure", ok),
        ],
        schema,
    )
    results = spark.createDataFrame(
        [(1, "a", "r"), (1, "b", None), (2, "z", 'q"'), (2, "a", "2"), (2, "a", "1"), (None, "a", "r")],
        "conversation long, call_id string, content string",
    )
    got = {(r.conversation, r.call_id): r for r in tool_calls.link(calls, results, tool_calls.SCHEMAS).collect()}
    assert {k: r.level for k, r in got.items()} == {
        (1, "a"): 1, (1, "b"): 2, (1, "c"): 3, (1, "d"): None, (1, "e"): None, (1, "f"): None, (1, "g"): None,
        (2, "a"): 1, (2, "z"): None,
    }
    assert {k for k, r in got.items() if r.valid} == {(1, "a"), (1, "d")}
    assert got[1, "b"].errors == ["$.n_words: missing"] and got[1, "b"].status == "answered"
    assert got[1, "e"].errors == ["unknown tool"] and got[1, "c"].status == "unanswered"
    assert got[1, "g"].errors == ["$.n_words: not of type integer"]
    assert got[2, "a"].errors == ["$.more: unknown", "$.n_words: above maximum"]
    assert got[1, "a"].record == '{"arguments":{"n_words":1,"text":"éA"},"call_id":"a","name":"measure","result":"r"}'
    assert json.loads(got[2, "a"].record)["result"] == "1" and got[2, "z"].status == "orphan result"
    assert rows(tool_calls.link(calls.limit(0), results.limit(0), {})) == []


def test_levels(spark):
    draw = random.Random(4)
    edges = {(f"c{i}", f"c{i - 1}") for i in range(1, 70)}  # one long chain
    edges |= {(f"d{i}", f"d{j}") for i in range(1, 14) for j in draw.sample(range(i), min(i, 1 + i % 3))}
    edges |= {("d3", "c69"), ("e1", "d13"), ("e2", "e1"), ("x", "y"), ("y", "z"), ("z", "x"), ("w", "x"), ("v", "w"), ("v", "c1")}
    nodes = sorted({n for e in edges for n in e} | {"lone"})
    expected: dict[str, int] = {}
    for _ in nodes:
        for n in nodes:
            after = [b for a, b in edges if a == n]
            if all(b in expected for b in after):
                expected[n] = 1 + max((expected[b] for b in after), default=0)
    found = tool_calls.levels(
        spark.createDataFrame([(n,) for n in nodes], "node string"), spark.createDataFrame(sorted(edges), "node string, after string")
    )
    assert rows(found) == sorted(expected.items(), key=repr)


def test_pipeline_edges(spark, docs, none, small):
    # Stages take documents that hold nulls, repeats and other columns.
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, small).count() <= docs.count()
        assert stage(spark, none, small).count() == 0
    kept = corpus_pipeline._drop_near_copies(spark, docs, small)
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id in (-5, 2, 6, 7, 8, 9)) == [-5, 2, 6, 8]


def test_fingerprints_of_words():
    import pyarrow as pa

    texts = [t for _, t in _texts()]
    for kind, expected in ((words.FOLDED, brute.folded), (words.UNCHANGED, lambda t: brute.UNCHANGED.findall(t or ""))):
        made = words.words_of(pa.array(texts), kind)
        plain = [(i, w) for i, t in enumerate(texts) for w in expected(t)]
        assert made.rows.tolist() == [i for i, _ in plain]
        prints = {}
        assert all(prints.setdefault(w, p) == p for (_, w), p in zip(plain, made.prints.tolist()))
        assert len(set(prints.values())) == len(prints)


def test_graph_rounds_compare_only_pairs_with_a_new_member():
    vectors = np.array([[100, 0], [90, 10], [80, 30], [0, 100]], dtype=np.int16)
    group = pa.table(
        {
            "centre": [7] * 4,
            "id": [1, 2, 3, 4],
            "fresh": [False, False, True, False],
            "coarse": [v.tobytes() for v in vectors],
            "least": [-1.5] * 4,
        }
    ).to_batches()
    made = [row for batch in neighbours._all_pairs("centre")(iter(group)) for row in batch.to_pylist()]
    near = {row["id"]: np.frombuffer(row["near"], np.int64).tolist() for row in made}
    assert near == {1: [3], 2: [3], 3: [2, 1, 4], 4: [3]}
    assert [row["n_fresh"] for row in made] == [1, 1, 3, 1]


def test_a_neighbour_proposed_again_stays_known():
    def listed(fresh):
        near, far = np.array([5, 6]), np.array([0.9, 0.8])
        return (1, near.tobytes(), far.tobytes(), np.array(fresh).tobytes(), int(sum(fresh)))

    names = ["id", "near", "far", "fresh", "n_fresh"]
    rows = [listed([True, True]), listed([False, True])]
    batch = pa.table({n: list(c) for n, c in zip(names, zip(*rows))}).to_batches()
    (merged,) = [row for b in neighbours._merged(iter(batch)) for row in b.to_pylist()]
    assert np.frombuffer(merged["near"], np.int64).tolist() == [5, 6]
    assert np.frombuffer(merged["fresh"], np.bool_).tolist() == [False, True]
    assert merged["n_fresh"] == 1
