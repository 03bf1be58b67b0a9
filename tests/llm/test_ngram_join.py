from __future__ import annotations

import random

import numpy as np
import pytest

from pulsegrid.llm import ngram_join as nj
from pulsegrid.llm.components import connected_components

SCHEMA = "doc_id long, text string, uid long, token long, block int"


def ngrams(t, width):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    w = low.encode().split()
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows, width, percent):
    sets = [ngrams(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(30)]
    passage = " ".join(rng.choice(vocab) for _ in range(25))
    bases = [[rng.choice(vocab) for _ in range(rng.randrange(1, 60))] for _ in range(n // 8)]
    rows = []
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice(vocab + [f"x{i}"])
        t = rng.choice([" ", "\n", "\x0b"]).join(w)
        rows.append((i, t.upper() if i % 5 == 0 else t + (" " + passage if i % 7 == 0 else "")))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t"), (None, rows[3][1]), (3, rows[3][1]), (n + 3, "one two"), (n + 4, "One  two"), (n + 5, "z y x w " * 10_000), (None, "lonely words of a null id")]
    return rows


@pytest.mark.parametrize("seed,width,percent,small", [(1, 4, 85, False), (2, 5, 80, True), (3, 2, 60, True), (4, 4, 85, True)])
def test_equals_brute_force(spark, monkeypatch, seed, width, percent, small):
    if small:  # many blocks, ranges, groups and trees
        monkeypatch.setattr(nj, "BLOCK_WORDS", 400)
        monkeypatch.setattr(nj, "RANGE_KEYS", 500)
        monkeypatch.setattr(nj, "GROUP", 4)
    rows = corpus(seed, 160)
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], SCHEMA).repartition(3)
    got = nj.similar_documents(docs, width, percent)
    found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str)
    assert found == brute(rows, width, percent)
    assert nj.similar_documents(docs.limit(0), width, percent).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_tree_finds_what_sets_say(seed):
    rng = random.Random(seed)
    base = rng.sample(range(1, 2**47), 60)
    sets = []
    for u in range(80):
        s = [x for x in base if rng.random() < rng.choice([0.99, 0.9, 0.5])] + rng.sample(range(2**47, 2**48), rng.randrange(6))
        sets.append((u, set(s)))
    rank = {x: k for k, x in enumerate(base)}
    pack = lambda s: np.array(sorted(s, key=lambda x: (rank.get(x, 99), x)), "<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    tree = nj.PrefixTree([(u, len(s), pack(s)) for u, s in sets if s])
    for percent in (50, 85, 95):
        own = sets[rng.randrange(80)][1]
        got = sorted(tree.join(nj.unpack_set(pack(own)), len(own), percent))
        assert got == [u for u, s in sets if s and 100 * len(s & own) >= percent * len(s | own)]


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(50)] + [(100 + rng.randrange(40), 100 + rng.randrange(40)) for _ in range(30)] + [(7, 200), (300, 301), (400, 400)]
    root = {x: x for ab in links for x in ab}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k != 400}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_hot_hubs_and_groups_are_split(spark):
    """An n-gram in half of all rows, and a component of a third of all documents."""
    from pyspark.sql import functions as F

    from pulsegrid.llm import ngram_join as nj
    from pulsegrid.llm.common import stored
    from test_line_dedup import skewed_plan

    hot = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 4000).cast("long")
    prefixes = stored(
        spark.range(0, 20_000, 1, 10).select(hot.alias("token"), F.col("id").alias("uid"), F.lit(20).alias("n"), F.lit(0).alias("pos")),
        "test-prefixes",
    )
    assert "skew=true" in skewed_plan(spark, lambda: nj._hub_pairs(prefixes, 80))
    assert "skew=true" in skewed_plan(spark, lambda: nj.feasible(prefixes, 80))
    links = prefixes.filter("uid % 2 = 0").select(F.lit(0).cast("long").alias("a"), F.col("uid").alias("b"))
    roots = {(r["node"], r["root"]) for r in nj.connected_components(links).collect()}
    assert roots == {(k, 0) for k in range(0, 20_000, 2)}
