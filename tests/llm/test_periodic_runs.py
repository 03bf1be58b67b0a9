from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import periodic_runs as pr
from pulsegrid.llm.catalog import queries
from pulsegrid.llm.periodic_runs import Grammar, find_runs, periodic_runs

SF = "/root/testdata/sf0.001"


def brute_runs(w):
    """All stretches by definition: for each period the maximal stretches, the smallest period of each."""
    n, best = len(w), {}
    for q in range(n // 4, 0, -1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e + q - i >= max(6, 4 * q):
                best[(i, e + q)] = q
            i = e
    return sorted((s, e - s, q) for (s, e), q in best.items())


def brute(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    dropped = set()
    for s, length, q in runs:
        dropped.update(range(s + q, s + length))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
        sha(b" ".join(x for i, x in enumerate(w) if i not in dropped)),
    )


words = st.one_of(
    st.lists(st.integers(0, 1), max_size=60),
    st.lists(st.integers(0, 3), max_size=80),
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 30), st.lists(st.integers(0, 2), max_size=9)).map(
        lambda t: t[2] + t[0] * t[1] + t[2]
    ),
)


@settings(max_examples=400, deadline=None)
@given(words)
def test_runs_equal_brute_force(w):
    found = find_runs(np.array(w, np.int64))
    assert list(zip(*(x.tolist() for x in found))) == sorted(brute_runs(w), key=lambda r: (r[0], r[2]))


@settings(max_examples=100, deadline=None)
@given(words, st.randoms())
def test_extensions_equal_comparison(w, random):
    if len(w) < 2:
        return
    w = w * 3
    g = Grammar(np.array(w, np.int64))
    i = np.array([random.randrange(len(w) - 1) for _ in range(40)])
    j = np.array([random.randrange(a + 1, len(w)) for a in i.tolist()])
    right, left = g.extend(i, j), g.extend(i, j, forward=False)
    for a, b, r, k in zip(i.tolist(), j.tolist(), right.tolist(), left.tolist()):
        n = 0
        while b + n < len(w) and w[a + n] == w[b + n]:
            n += 1
        m = 0
        while m < a and w[a - 1 - m] == w[b - 1 - m]:
            m += 1
        assert (n, m) == (r, k)


def test_rounds_are_few_for_long_repetitions():
    w = np.tile(np.arange(1000), 200)
    g = Grammar(w)
    assert len(g.levels) < 120
    assert g.extend(np.array([0]), np.array([1000])).tolist() == [199_000]
    assert len(Grammar(np.zeros(100_000, np.int64)).levels) <= 3


def test_one_word_repeated_and_long_documents(spark):
    rows = [(3, "a " * 30_000), (4, "x " * 5), (5, " ".join(f"w{k % 7000}" for k in range(40_000))), (6, "b b c " * 40)]
    got = {r["doc_id"]: r for r in periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [tuple(x) for x in got[3]["runs"]] == [(0, 30_000, 1)] and got[3]["collapsed"] == "a"
    assert got[4]["runs"] == [] and got[4]["n_words"] == 5
    assert [tuple(x) for x in got[5]["runs"]] == [(0, 40_000, 7000)]
    assert got[5]["collapsed"] == " ".join(f"w{k}" for k in range(7000))
    assert [tuple(x) for x in got[6]["runs"]] == [(0, 120, 3)]


def test_odd_input(spark):
    rows = [(1, None, 0), (1, "", 0), (None, "a a a a a a", 1), (7, "\x0b\x1c é é é é é é \r\n", 2), (7, "\x0b\x1c é é é é é é \r\n", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumnRenamed("runs", "n_words")
    got = sorted(periodic_runs(docs).collect(), key=str)
    assert sorted((str(r["doc_id"]), r["n_words"], len(r["runs"]), r["collapsed"]) for r in got) == [
        ("1", 0, 0, ""), ("1", 0, 0, ""), ("7", 7, 1, "\x1c é"), ("7", 7, 1, "\x1c é"), ("None", 6, 1, "a"),
    ]
    assert periodic_runs(docs.limit(0)).collect() == []


@pytest.mark.parametrize("block", [pr.BLOCK_WORDS, 1])
def test_query_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(pr, "BLOCK_WORDS", block)
    columns = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = {tuple(r) for r in queries()["op12_periodic_runs"](spark, SF).select(*columns).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert got == {brute(r["doc_id"], r["text"]) for r in docs}
    assert any(r[1] for r in got)
