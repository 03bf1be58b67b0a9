from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest

import corpus_pipeline
from pulsegrid.llm import line_crf
from pulsegrid.llm.catalog import tokenizer_path
from test_inverted_index import brute as contaminated
from test_ngram_join import brute as components

SF = "/root/testdata/sf0.001"


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), set()
    while True:
        share = sum(weight[s] for s in sizes if s not in fixed)
        level = (total - sum(3 * sizes[s] for s in fixed)) / share if share else level  # noqa: F821
        beyond = {s for s in sizes if weight[s] * level > 3 * sizes[s]}
        if beyond == fixed:
            return {s: 3.0 * sizes[s] if s in fixed else weight[s] * level for s in sizes}
        fixed = beyond


def brute(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"] for r in line_crf.score_documents(docs, labels).collect() if r["predicted"]}
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect() if r["doc_id"] in good]
    least = {i: c for i, _, c in components([(i, t) for i, t, _ in rows], 5, 80)}
    rows = [r for r in rows if least[r[0]] is None or least[r[0]] == r[0]]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {x[0] for x in contaminated([(i, t) for i, t, _ in rows], items) if x[5]}
    rows = [r for r in rows if r[0] not in hit]
    size = {i: len((t or "").encode().split()) for i, t, _ in rows}
    sizes: dict = {}
    for i, _, s in rows:
        sizes[s] = sizes.get(s, 0) + size[i]
    target = targets(sizes)
    tokenizer = Tokenizer.from_file(str(tokenizer_path()))
    out, start = [], 0
    for i, t, s in sorted(rows, key=lambda r: r[0]):
        rate = target[s] / sizes[s] if sizes[s] else 1.0
        u = int(hashlib.md5(f"mix-1:{i}".encode()).hexdigest()[:13], 16) / 16**13
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for _ in range(int(rate) + (u < rate - int(rate))):
            out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
    return out


def test_run_equals_brute_force(spark):
    got = sorted(tuple(r)[:4] for r in corpus_pipeline.run(spark, SF).collect())
    assert got == sorted(brute(spark))


def test_stages_keep_columns_and_take_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, "The same text of quite a few words, given here.", "en", "a", 1)] * 3
    rows += [(2, None, None, None, None), (None, "Another text that stands here with a null id.", "en", "b", 2), (2, "", "en", "a", 0), (2, "", "en", "a", 0)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).count() == 0
        if name == "near_duplicates":
            kept = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
            assert kept == sorted([(1, rows[0][1]), (None, rows[4][1]), (2, None), (2, ""), (2, "")], key=str)
        if name == "decontamination":
            assert out.count() == len(rows)


def test_stages_take_columns_of_any_name(spark):
    names = ["_id", "_crc", "best", "component", "uid", "stays", "Row_ID", "items", "hits", "score", "_part", "_source", "copies", "rate"]
    rows = [(1, "The same text of quite a few words, given here.", "en", "a", 1)] * 2 + [(2, "Quite another text of many words, and one more.", "en", "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", *(f"{k} as `{n}`" for k, n in enumerate(names)))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert sorted({r["doc_id"] for r in out.collect()}) == [1, 2], name
        if name != "token_files":
            assert out.columns == docs.columns, name
