from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pytest

from pulsegrid.llm import anchor_dedup as ad
from pulsegrid.llm.anchor_dedup import COVERS, cover_for, remove_repeated_passages
from pulsegrid.llm.catalog import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def brute(rows, width):
    least: dict = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for k in range(len(w) - width + 1) if i is not None else ():
            key = tuple(w[k : k + width])
            least[key] = min(i, least.get(key, i))
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - width + 1) if i is not None else ():
            if least[tuple(w[k : k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def got(spark, rows, width, **columns):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = remove_repeated_passages(docs, width).collect()
    for r in found:
        spans = [tuple(s) for s in r["removed"]]
        assert all(a[0] + a[1] < b[0] for a, b in zip(spans, spans[1:]))
    return sorted(((r["doc_id"], r["n_words"], sum(s[1] for s in r["removed"]), r["kept"]) for r in found), key=str)


@pytest.mark.parametrize("v", sorted(COVERS))
def test_covers_align_any_two_places(v):
    cover = set(COVERS[v])
    for d in range(v):
        assert any((x + d) % v in cover for x in cover)
    assert cover_for(50) == (31 if 31 in COVERS else v, COVERS[31])


@pytest.mark.parametrize("width,blocks,ranges", [(50, 500_000, 1_000_000), (12, 60, 40), (1, 30, 20), (5, 300, 50)])
def test_equals_brute_force(spark, monkeypatch, width, blocks, ranges):
    monkeypatch.setattr(ad, "BLOCK_WORDS", blocks)
    monkeypatch.setattr(ad, "RANGE_KEYS", ranges)
    rng = random.Random(width)
    passages = [[f"p{p}w{rng.randrange(40)}" for _ in range(rng.randrange(1, 3 * width + 4))] for p in range(6)]
    rows = []
    for i in range(120):
        words: list = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += p[a : a + rng.randrange(1, 2 * width + 2)] if rng.random() < 0.6 else p
            words += [f"u{rng.randrange(30)}" for _ in range(rng.randrange(width))]
        rows.append((rng.randrange(90), " ".join(words)))
    rows += [(7, None), (8, ""), (None, " ".join(passages[0])), (-5, "  \t".join(passages[1]))]
    assert got(spark, rows, width) == brute(rows, width)


def test_edges_of_a_match(spark):
    w = [f"w{k}" for k in range(200)]
    rows = [(1, " ".join(w))]
    rows += [(10 + k, " ".join(["x"] * k + w[30 : 30 + n] + ["y"])) for k, n in ((0, 50), (1, 49), (13, 51), (30, 50), (47, 120))]
    assert got(spark, rows, 50) == brute(rows, 50)


def test_hot_group_and_repeats_within_a_document(spark, monkeypatch):
    monkeypatch.setattr(ad, "BLOCK_WORDS", 3000)
    p = " ".join(f"w{k}" for k in range(60))
    rows = [(k, p + f" tail{k}") for k in range(400)] + [(1000, "a " * 300), (1001, "a " * 49), (1002, "b " * 300)]
    out = got(spark, rows, 50)
    assert out == brute(rows, 50)
    assert sum(r[2] for r in out) == 399 * 60


def test_odd_input(spark):
    docs = spark.createDataFrame([(1, "a", 1, 2)], "doc_id long, text string, block long, part int")
    assert remove_repeated_passages(docs).count() == 1
    assert remove_repeated_passages(docs.limit(0)).collect() == []
    same = [(4, " ".join(map(str, range(80))))] * 2
    assert [r[2] for r in got(spark, same, 50)] == [0, 0]


def test_query_equals_sql_and_brute_force(spark):
    found = queries()["op11_anchor_dedup"](spark, SF).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = {(i, n, g, hashlib.sha256(k.encode()).hexdigest()) for i, n, g, k in brute(docs, 50)}
    assert {tuple(r) for r in found} == expected
    assert any(r[2] for r in found)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert set(con.execute(f"select doc_id, n_words, n_removed, kept_sha256 from ({oracle_sql()['op11_anchor_dedup']})").fetchall()) == expected
