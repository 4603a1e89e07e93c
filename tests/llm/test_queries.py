"""Registered queries against SQL or against plain versions, over whole small tables."""

from __future__ import annotations

from zlib import crc32

import brute
import compare
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from townads.llm import registry

compare._FAMILIES["boolean"] = "BOOLEAN"


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="module")
def docs(spark, small):
    return [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql(name, spark, medium):
    result = registry.QUERIES[name](spark, medium)
    assert compare.difference(result, compare.connect(medium), registry.ORACLE[name]) is None


def test_decontamination(spark, small, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    expected = [
        (doc, n, hit, len(found), brute.sha(",".join(sorted(map(str, found)))), bad)
        for doc, n, hit, found, bad in brute.contamination(docs, items)
    ]
    assert rows(registry.QUERIES["op1_decontamination"](spark, small)) == sorted(expected, key=repr)
    assert any(e[-1] for e in expected)


def test_near_copies(spark, small, docs):
    assert rows(registry.QUERIES["op3_ngram_join"](spark, small)) == sorted(brute.near_copies(docs), key=repr)


def test_tokens(spark, small, docs):
    model = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    coded, counted = [], []
    for doc, text in docs:
        ids = model.encode(text or "", add_special_tokens=False).ids
        decoded = model.decode(ids, skip_special_tokens=False)
        coded.append((doc, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(decoded)))
        counted.append((doc, len((text or "").encode()), len(ids), len(ids) > 2048))
    assert rows(registry.QUERIES["op5_bpe"](spark, small)) == sorted(coded, key=repr)
    assert rows(registry.QUERIES["op6_token_counts"](spark, small)) == sorted(counted, key=repr)


def test_repeated_passages(spark, small, docs):
    expected = [(doc, n, n - len(kept), brute.sha(" ".join(kept))) for doc, n, kept in brute.repeats(docs)]
    assert rows(registry.QUERIES["op8_substring_dedup"](spark, small)) == sorted(expected, key=repr)
    assert any(e[2] for e in expected)


def test_neighbours(spark, medium):
    table = spark.read.parquet(f"{medium}/embeddings.parquet").toPandas()
    ids, x = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    norm = np.linalg.norm(x, axis=1)
    got = {}
    for query, rank, other, score in map(tuple, registry.QUERIES["op9_nearest"](spark, medium).collect()):
        got.setdefault(query, {})[rank] = (other, score)
    assert set(got) == {int(i) for i in ids if i % 50 == 0}
    found = 0
    for query, ranked in got.items():
        i = int(np.flatnonzero(ids == query)[0])
        score = x @ x[i] / (norm * norm[i])
        score[i] = -2
        best = [int(v) for v in ids[np.lexsort((ids, -score))[:5]]]
        assert sorted(ranked) == [1, 2, 3, 4, 5]
        found += len(set(best) & {other for other, _ in ranked.values()})
        for other, value in ranked.values():
            assert abs(score[int(np.flatnonzero(ids == other)[0])] - value) < 1e-12
        assert [ranked[r][1] for r in range(1, 6)] == sorted((s for _, s in ranked.values()), reverse=True)
    assert found >= 0.9 * 5 * len(got)


def test_language(spark, medium):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{medium}/documents.parquet").collect()}
    got = {r.doc_id: r for r in registry.QUERIES["op10_language_id"](spark, medium).collect()}
    assert set(got) == set(langs)
    assert all(r.held_out == (crc32(str(doc).encode()) % 3 == 1) and 0 <= r.score <= 1 for doc, r in got.items())
    held = [doc for doc, r in got.items() if r.held_out]
    assert sum(got[doc].lang_pred == langs[doc] for doc in held) >= 0.95 * len(held)


def test_pipeline(spark, small):
    frame = spark.read.parquet(f"{small}/documents.parquet")
    columns = frame.columns
    kept = frame.collect()
    for (_, stage), last in zip(corpus_pipeline.STAGES, [False] * 4 + [True]):
        before, frame = kept, corpus_pipeline.stored(stage(spark, frame, small), "stage")
        kept = frame.collect()
        if stage is corpus_pipeline._drop_near_copies:
            expected = {d for d, c, _ in brute.near_copies([(r.doc_id, r.text) for r in before]) if d == c}
            assert sorted(r.doc_id for r in kept) == sorted(expected)
        elif stage is corpus_pipeline._cut_repeats:
            expected = {d: words for d, _, words in brute.repeats([(r.doc_id, r.text) for r in before])}
            assert {r.doc_id: brute.UNCHANGED.findall(r.text) for r in kept} == expected
            assert all(r.n_chars == len(r.text) for r in kept)
        elif stage is corpus_pipeline._decontaminate:
            items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
            judged = brute.contamination([(r.doc_id, r.text) for r in before], items)
            assert {r.doc_id for r in kept} == {j[0] for j in judged if not j[4]}
        elif stage is corpus_pipeline._identify_language:
            assert len(kept) >= 0.97 * len(before)
        assert last or frame.columns == columns
    assert {r.doc_id for r in kept} == {r.doc_id for r in before}
    assert all(r.n_tokens == len(r.ids) for r in kept)
