"""Periodic runs, repeated bytes and ranked search against plain versions, with edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from townads.llm import bwt_dedup, frames, lexical, periodic, registry, similar

LAST = (1 << 63) - 1
SCHEMA = "doc_id long, text string"


def rows(frame):
    return sorted((tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in frame.collect()), key=repr)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


# --- periodic runs -----------------------------------------------------------------------------


def plain_runs(words, exponent=4, least=6):
    n, out = len(words), set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                run = words[i : i + length]
                if not any(run[d:] == run[:-d] for d in range(1, q)):
                    out.add((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 7), st.integers(0, 12), st.integers(2, 5))
def test_automaton_finds_all_runs(words, period, often, exponent):
    words = words + words[-period:] * often
    assert periodic.runs_of(words, exponent) == plain_runs(words, exponent)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=30), min_size=1, max_size=5), st.integers(1, 5), st.integers(0, 9))
def test_stretches_hold_all_runs(texts, period, often):
    texts = [t + t[-period:] * often for t in texts]
    first = np.append(0, np.cumsum([len(t) for t in texts]))
    every = np.array([w for t in texts for w in t], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    found = {row: [] for row in range(len(texts))}
    for low, high in periodic._stretches(every, owner, first, 4).tolist():
        row = int(owner[low])
        assert first[row] <= low and high <= first[row + 1]
        named = np.unique(every[low:high], return_inverse=True)[1].tolist()
        found[row] += [(s + low - int(first[row]), n, q) for s, n, q in periodic.runs_of(named)]
    assert [sorted(found[row], key=lambda r: (r[0], r[2])) for row in found] == [plain_runs(t) for t in texts]


RUNS = [
    (1, "a b c " * 5 + "end"),
    (1, "a b c " * 5 + "end"),
    (2, None),
    (3, ""),
    (4, " \t\n"),
    (None, "x " * 9),
    (5, "x\ty x y " * 6 + "z z z z z z z"),
    (6, "one two three"),
    (7, " ".join(f"w{i}" for i in range(30000)) + " again" * 400),
    (8, ("p q " * 4 + "r ") * 5),
    (9, "é ß " * 7),
]


def test_runs_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BATCH_BYTES", 500)
    table = spark.createDataFrame([(i, t, "runs", 1) for i, t in RUNS], SCHEMA + ", runs string, n_words int")
    outputs = ("n_words", "n_runs", "runs", "start", "length", "period", "exponent_milli", "collapsed", "runs_sha256", "collapsed_sha256")
    expected = []
    for i, text in RUNS:
        words = brute.UNCHANGED.findall(text or "")
        runs = plain_runs(words) if len(words) < 5000 else [(30000, 400, 1)]
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else None
        kept = collapsed(words, runs)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        milli = best and 1000 * best[1] // best[2]
        expected.append((i, len(words), len(runs), runs, *(best or (None,) * 3), milli, kept, sha(lines), sha(kept)))
    got = [
        tuple([tuple(x) for x in v] if k == "runs" else v for k, v in zip(("doc_id", *outputs), r))
        for r in periodic.find_runs(table, outputs=outputs).collect()
    ]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert rows(periodic.find_runs(table.limit(0))) == []
    with pytest.raises(ValueError):
        periodic.find_runs(table, exponent=1)


def test_run_query(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    expected = {}
    for doc, text in docs:
        words = brute.UNCHANGED.findall(text or "")
        n, h = len(words), crc32(str(doc).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs = plain_runs(words)
        best = None
        for run in runs:
            if best is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        milli = best and 1000 * best[1] // best[2]
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        expected[doc] = (doc, len(runs), *(best or (None,) * 3), milli, sha(lines), sha(collapsed(words, runs)))
    got = {r[0]: r for r in rows(registry.QUERIES["op11_periodic_runs"](spark, small))}
    assert len(got) == len(docs) and len(expected) > 150
    assert {doc: got[doc] for doc in expected} == expected
    assert any(e[1] for e in expected.values())


# --- repeated bytes ----------------------------------------------------------------------------


def plain_bytes(docs, length):
    """Rows (id, n_bytes, n_removed, n_spans, removed, left)."""
    own = [(LAST if i is None else i, (t or "").encode()) for i, t in docs]
    least = {}
    for i, data in own:
        for at in range(len(data) - length + 1):
            key = data[at : at + length]
            least[key] = min(least.get(key, i), i)
    out = []
    for (doc, _), (i, data) in zip(docs, own):
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if least[data[at : at + length]] < i:
                gone[at : at + length] = b"\1" * length
        spans = [list(m.span()) for m in re.finditer(rb"\x01+", gone)]
        out.append((doc, len(data), sum(gone), len(spans), spans, bytes(b for b, g in zip(data, gone) if not g)))
    return sorted(out, key=repr)


BYTES = ("n_bytes", "n_removed", "n_spans", "removed", "left")


def _byte_docs(seed, n=120):
    draw = random.Random(seed)
    passages = ["".join(draw.choice("abé \0") for _ in range(draw.randrange(10, 200))) for _ in range(10)]
    docs = []
    for i in range(n):
        text = "".join(
            draw.choice(passages)[draw.randrange(5) :] if draw.random() < 0.6 else "".join(draw.choice("abcdefgh ") for _ in range(draw.randrange(60)))
            for _ in range(draw.randrange(8))
        )
        docs.append((draw.choice([i, i, i, 7, None]), draw.choice([text, text, text, None, "", "a" * 300, "ab" * 200])))
    return docs


@pytest.mark.parametrize(
    "length,block,bucket,ordered", [(50, 2 << 20, 8 << 20, 1 << 18), (50, 3000, 2000, 300), (17, 1000, 3000, 5000), (70, 4000, 2000, 900)]
)
def test_bytes_in_small_blocks(spark, monkeypatch, length, block, bucket, ordered):
    for name, value in (("BLOCK_BYTES", block), ("BUCKET_BYTES", bucket), ("PART_BYTES", max(bucket // 4, 1)), ("_ORDERED", ordered)):
        monkeypatch.setattr(bwt_dedup, name, value)
    docs = _byte_docs(length)
    table = spark.createDataFrame([(i, t, 5) for i, t in docs], SCHEMA + ", n_bytes int").repartition(3)
    got = rows(bwt_dedup.remove_repeated_bytes(table, length=length, outputs=BYTES))
    assert got == plain_bytes(docs, length)
    assert sum(r[2] for r in got) > 1000


def test_bytes_of_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "_SLICE", 700)  # a text lies in many slices
    draw = random.Random(4)
    long = "".join(draw.choice("abcdefghij ") for _ in range(9000))
    docs = [(5, long), (3, long[4000:4200] + "x"), (8, "y" + long[1:]), (9, long[:49]), (9, long[:50]), (1, "z" * 2000)]
    table = spark.createDataFrame(docs, SCHEMA)
    assert rows(bwt_dedup.remove_repeated_bytes(table, outputs=BYTES)) == plain_bytes(docs, 50)
    assert rows(bwt_dedup.remove_repeated_bytes(table.limit(0))) == []
    with pytest.raises(ValueError):
        bwt_dedup.remove_repeated_bytes(table, length=16)


def test_copies_are_one_string_in_a_block(spark):
    """However many documents of a block hold a passage, the block sends its strings once."""
    draw = random.Random(5)
    passage = "".join(draw.choice("abcdefghij ") for _ in range(600))
    docs = spark.createDataFrame([(i, f"{i} {passage}") for i in range(200)], SCHEMA).coalesce(1)
    packed = docs.select(F.col("doc_id").alias("key"), F.col("doc_id").alias("own_id"), "text").mapInArrow(bwt_dedup._pack, "block string, rows binary")
    row = packed.first()
    data, ids, _, begin, matches, whose, keys = bwt_dedup._strings(bwt_dedup._unpack(row.rows), 50)
    shared = pa.table({"block": [row.block], "bucket": [0], "keys": pa.array([(np.unique(keys) >> np.uint64(32)).astype(np.uint32).tobytes()])})
    block = pa.table({"block": [row.block], "rows": pa.array([bytes(row.rows)])})
    sent = bwt_dedup._send_shards(50, 1, 1)((), block, shared)
    taken = np.frombuffer(zstandard.decompress(sent["sizes"][0].as_py()), np.int32)
    assert len(begin) > 200 * 20
    assert len(taken) < 200 * 2 + 40  # the strings that the differing ids reach into, and the passage's own


def _sorted_symbols(monkeypatch, folder):
    """Makes tasks note how many symbols they put in order; gives their sum."""
    order = bwt_dedup._suffix_order

    def noted(text, rest, shard):
        with open(f"{folder}/symbols", "a") as f:
            f.write(f"{len(text)}\n")
        return order(text, rest, shard)

    monkeypatch.setattr(bwt_dedup, "_suffix_order", noted)
    return lambda: sum(map(int, (folder / "symbols").read_text().split())) if (folder / "symbols").exists() else 0


def test_strings_of_many_blocks_are_sent_once(spark, monkeypatch, tmp_path):
    """However many blocks hold a passage, its strings are put in order and merged about once."""
    monkeypatch.setattr(bwt_dedup, "BLOCK_BYTES", 3500)
    symbols = _sorted_symbols(monkeypatch, tmp_path)
    draw = random.Random(6)
    passage = "".join(draw.choice("abcdefghij ") for _ in range(3000))
    docs = [(i, f"{i} {passage}") for i in range(30)]
    assert rows(bwt_dedup.remove_repeated_bytes(spark.createDataFrame(docs, SCHEMA), outputs=BYTES)) == plain_bytes(docs, 50)
    assert 3000 < symbols() < 10 * 3000  # a string is about four times what no other shares with it


def test_equal_keys_in_other_surroundings_go_no_further(spark, monkeypatch, tmp_path):
    """Keys that many documents share make no work if no match around them can repeat."""
    symbols = _sorted_symbols(monkeypatch, tmp_path)
    draw = random.Random(7)

    def other(n):
        return "".join(draw.choice("abcdefghij ") for _ in range(n))

    docs = [(i, other(draw.randrange(40, 90)) + "a common text here, " + other(draw.randrange(40, 90))) for i in range(300)]
    assert rows(bwt_dedup.remove_repeated_bytes(spark.createDataFrame(docs, SCHEMA), outputs=BYTES)) == plain_bytes(docs, 50)
    assert symbols() < 100
    # A byte less than a match, and all lengths from where a print can be shared.
    shared = other(49)
    docs += [(1000 + i, other(60) + shared[: 20 + i] + other(60)) for i in range(30)]
    assert rows(bwt_dedup.remove_repeated_bytes(spark.createDataFrame(docs, SCHEMA), outputs=BYTES)) == plain_bytes(docs, 50)
    assert not any(r[2] for r in plain_bytes(docs, 50))


@pytest.mark.parametrize("length", [17, 18, 34, 50])
def test_a_match_alone_is_found(spark, length):
    """Two documents that share one match, wherever its key stands."""
    draw = random.Random(length)
    docs = []
    for i in range(150):
        match = "".join(draw.choice("abcdefghij") for _ in range(length))
        docs += [(2 * i + k, "".join(draw.choice(mark) for _ in range(30)) + match + "".join(draw.choice(mark) for _ in range(30))) for k, mark in enumerate(("klmnop", "qrstuv"))]
    got = rows(bwt_dedup.remove_repeated_bytes(spark.createDataFrame(docs, SCHEMA).repartition(4), length=length, outputs=BYTES))
    assert got == plain_bytes(docs, length)
    assert sum(r[2] for r in got) >= 150 * length


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=14), min_size=1, max_size=8, unique=True), st.integers(1, 6))
def test_interleave_is_the_order_of_suffixes(strings, length):
    """Two shards' transforms, merged, against sorting."""
    shards = [s for s in (strings[::2], strings[1::2]) if s]
    symbols, heads, owner, first, string_first = [], [], [], [], []
    for number, shard in enumerate(shards):
        data = np.frombuffer("".join(shard).encode(), np.uint8)
        sizes = np.array([len(s) for s in shard])
        begin = np.cumsum(sizes) - sizes
        own, found, _ = bwt_dedup._transforms(data, begin, sizes, np.zeros(len(shard), np.int64))
        first.append(sum(map(len, symbols)))
        string_first.append(len(heads))
        heads += (own + first[-1]).tolist()
        symbols.append(found + np.uint16(1))
        owner += [number] * len(found)
    symbols, heads, owner = np.concatenate(symbols), np.array(heads), np.array(owner)
    symbols[heads] = 0
    back = bwt_dedup._walk(symbols, heads, owner, np.array(first), np.array(string_first))
    source, interval = bwt_dedup.merged(symbols, back, length)
    # Every element as its string from its place on, read by going right to left.
    text = {}
    for head, string in zip(range(len(heads)), [s for shard in shards for s in shard]):
        shard = owner[heads[head]]
        at = first[shard] + head - string_first[shard]
        text[at] = ""
        for i in range(len(string) - 1, -1, -1):
            at = int(back[at])
            text[at] = string[i:]
    whole = [(text[int(e)][:length], int(k)) for e, k in zip(source, interval) if len(text[int(e)]) >= length]
    assert [t for t, _ in whole] == sorted(t for t, _ in whole)
    assert len({t for t, _ in whole}) == len({k for _, k in whole}) == len(set(whole))


# --- ranked search -----------------------------------------------------------------------------


def plain_search(docs, items, best=20):
    terms = [(LAST if i is None else i, brute.folded(t)) for i, t in docs]
    n_docs, length = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = Counter(term for _, t in terms for term in set(t))
    out = []
    for item, text in set(items):
        asked = Counter(brute.folded(text))
        scores = []
        for doc, words in terms:
            tf, score = Counter(words), 0
            for term, often in asked.items():
                if tf[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 75 + 25 * len(words) * n_docs // length
                    score += often * weight * (1_000_000_000 * tf[term] // (1000 * tf[term] + 12 * m))
            if score > 0:
                scores.append((-score, doc))
        out += [(item, r, None if doc == LAST else doc, -s) for r, (s, doc) in enumerate(sorted(scores)[:best], 1)]
    return sorted(out, key=repr)


def _search_docs(seed):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Éa", "ñ", "THE", "The"]
    pick = lambda n: " ".join(words[min(int(draw.expovariate(0.08)), 63)] for _ in range(n))
    docs = [(draw.choice([i, i, i, 3, None]), draw.choice([pick(draw.randrange(60)), None, "", "?!", "w1 w2"])) for i in range(150)]
    docs += [(900, pick(20000)), (901, "w5 " * 3000)]
    items = [(i, pick(draw.randrange(1, 30))) for i in range(12)]
    return docs, items + [(1, "w7 w7 w9"), (2, None), (3, ""), (None, "the w1"), (0, items[0][1]), (77, "unheard of")]


@pytest.mark.parametrize("seed,block,piece,batch", [(1, 1 << 19, 1 << 20, 3 << 20), (2, 40, 300, 2000)])
def test_search(spark, monkeypatch, seed, block, piece, batch):
    for name, value in (("BLOCK_TERMS", block), ("SLICE_TERMS", piece), ("BATCH_BYTES", batch)):
        monkeypatch.setattr(lexical, name, value)
    docs, items = _search_docs(seed)
    table = spark.createDataFrame([(i, t, "x") for i, t in docs], SCHEMA + ", item_id string").repartition(4)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    assert rows(lexical.search(table, asked)) == plain_search(docs, items)
    assert rows(lexical.search(table, asked, best=3)) == plain_search(docs, items, 3)


def test_search_without_rows(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], SCHEMA)
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(lexical.search(docs.limit(0), items)) == []
    assert rows(lexical.search(docs, items.limit(0))) == []
    assert lexical.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert [r[:3] for r in rows(lexical.search(docs, items))] == [(1, 1, 1)]


def test_equal_scores_go_by_id(spark):
    docs = spark.createDataFrame([(i, "same words here") for i in range(100, 0, -1)] + [(0, "else")], SCHEMA).repartition(5)
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert [r[2] for r in rows(lexical.search(docs, items).orderBy("rank"))] and [
        r.doc_id for r in lexical.search(docs, items).orderBy("rank").collect()
    ] == list(range(1, 21))


# --- candidate edges of near copies -------------------------------------------------------------


@pytest.mark.parametrize("n", [400, 900])
def test_candidate_edges_grow_with_the_nodes(spark, n):
    """A group of n texts that differ in a word each is held together by fewer than 3n edges."""
    draw = random.Random(8)
    base = [f"{draw.choice('abcdef')}{draw.randrange(90000)}" for _ in range(120)]
    docs = []
    for i in range(n):
        words = list(base)
        words[draw.randrange(120)] = f"changed{i}"
        docs.append((i, " ".join(words)))
    table = spark.createDataFrame(docs, SCHEMA).select(F.col("doc_id").alias("id"), similar.row_key("doc_id", "text").alias("key"), "text")
    made = table.mapInArrow(similar._noded, similar._NODES)
    nodes = similar.stored(made.select("node", "paths", "sketch").dropDuplicates(["node"]), "nodes")
    edges = similar._candidates(nodes).distinct()
    assert edges.count() < 3 * n
    assert similar.components(edges).select("component").distinct().count() == 1


def _group(n, changes):
    """Texts of 120 words that differ in a few words each."""
    draw = random.Random(8)
    base = [f"{draw.choice('abcdef')}{draw.randrange(90000)}" for _ in range(120)]
    docs = []
    for i in range(n):
        words = list(base)
        for at in draw.sample(range(120), changes):
            words[at] = f"changed{i}"
        docs.append((i, " ".join(words)))
    return docs


def test_candidate_edges_of_many_buckets(spark, monkeypatch):
    """Nodes that meet in many buckets are held together by little more than one edge a node."""
    monkeypatch.setattr(similar, "SMALL", 16)
    table = spark.createDataFrame(_group(300, 3), SCHEMA)
    keyed = table.select(F.col("doc_id").alias("id"), similar.row_key("doc_id", "text").alias("key"), "text")
    made = keyed.mapInArrow(similar._noded, similar._NODES)
    edges = similar._candidates(similar.stored(made.select("node", "paths", "sketch"), "nodes")).distinct()
    assert edges.count() < 1.5 * 300
    assert [r["count"] for r in similar.components(edges).groupBy("component").count().collect()] == [300]


def test_edges_of_a_group_in_many_blocks(spark, monkeypatch):
    """The edges of a group that is compared in blocks do not grow with its nodes times its blocks."""
    found = []

    def seen(edges, components=similar.components):
        found.append(edges.where("a <> b").distinct().count())
        return components(edges)

    monkeypatch.setattr(similar, "components", seen)
    monkeypatch.setattr(similar, "BLOCK_NODES", 10)
    docs = _group(100, 1)
    got = similar.near_copies(spark.createDataFrame(docs, SCHEMA)).select("doc_id", "class_id", "n_links")
    assert rows(got) == sorted(brute.near_copies(docs), key=repr)
    assert len(found) == 2 and 99 <= found[1] < 2 * 100


def test_pipeline_keeps_one_of_a_group_in_many_blocks(spark, monkeypatch):
    found = []

    def seen(edges, components=similar.components):
        found.append(edges.where("a <> b").distinct().count())
        return components(edges)

    monkeypatch.setattr(similar, "components", seen)
    monkeypatch.setattr(similar, "BLOCK_NODES", 10)
    docs = spark.createDataFrame([*_group(100, 1), (100, "alone"), (0, "else"), (101, None)], SCHEMA)
    kept = rows(corpus_pipeline._drop_near_copies(spark, docs, "").select("doc_id", F.length("text") < 9))
    assert kept == [(0, False), (0, True), (100, True), (101, None)]
    assert len(found) == 2 and all(n < 2 * 100 for n in found)


def test_components_read_only_edges_that_are_left(spark, monkeypatch):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(300)] + [(500, 501 + i) for i in range(300)]
    edges += [(1000 + draw.randrange(300), 1000 + draw.randrange(300)) for _ in range(300)]
    label = {x: {x} for a, b in edges for x in (a, b) if a != b}
    for a, b in edges:
        if a != b and label[a] is not label[b]:
            label[a] |= label[b]
            for x in label[b]:
                label[x] = label[a]
    read = []

    def stored(frame, name, keep=frames.stored):
        made = keep(frame, name)
        if name == "edges":
            read.append(made.count())
        return made

    monkeypatch.setattr(frames, "stored", stored)
    got = frames.components(spark.createDataFrame(edges, "a long, b long"))
    assert rows(got) == sorted(((x, min(of)) for x, of in label.items()), key=repr)
    assert read[-1] == 0 and sum(read) < 2 * len(edges) and len(read) < 9
