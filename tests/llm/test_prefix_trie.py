from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

from pulsegrid.llm import prefix_trie as pt
from pulsegrid.llm.catalog import oracle_sql, queries
from pulsegrid.llm.prefix_trie import NODE_COLUMNS, conversation_trie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_rebuilt(rows):
    own: dict = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    digest = lambda t: hashlib.md5(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[0], t[1], digest(t)))] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
    return out


def brute(convs):
    members: dict = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(ts[:d], []).append(c)
    children: dict = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        own = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * own + sum(saved[k] for k in kids)
    out = set()
    for node, ms in members.items():
        ends = ",".join(str(c) for c in sorted(ms) if len(convs[c]) == len(node))
        out.add(
            (
                min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), len(children.get(node, [])),
                leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return out


def got(df):
    rows = [tuple(r[c] for c in NODE_COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def sample(seed, n, turns=12, words=2):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(n * 3), n):
        for t in range(rng.randrange(1, turns)):
            rows.append((c, t, rng.choice(["user", "bot", None]), rng.choice(["", None, "é" * 3, "x", "yes"][: words + 1])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("cells", [1 << 16, 8])
@pytest.mark.parametrize("seed,words", [(1, 2), (2, 4)])
def test_equals_brute_force(spark, monkeypatch, cells, seed, words):
    # eight cells: the sketch proves next to nothing, every prefix is grouped
    monkeypatch.setattr(pt, "LEAST_CELLS", cells)
    monkeypatch.setattr(pt, "MOST_CELLS", max(cells, 8))
    monkeypatch.setattr(pt, "CHUNK", min(cells, pt.CHUNK))
    rows = sample(seed, 150, words=words)
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(brute_rebuilt(rows))


def test_conversations_cut_by_partitions(spark, monkeypatch):
    """Two equal conversations with a third of all rows each, and one that shares half of it, over many partitions."""
    monkeypatch.setattr(pt, "HOT_PARENTS", 4)
    long = [("user", f"t{k % 50}") for k in range(400)]
    rows = [(c, k, r, t) for c in (10, 20) for k, (r, t) in enumerate(long)]
    rows += [(30, k, r, t + ("x" if k > 200 else "")) for k, (r, t) in enumerate(long)] + sample(3, 60)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(brute_rebuilt(rows))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sketch_never_estimates_too_low(spark):
    d = np.repeat(np.arange(500), np.arange(500) % 3 + 1)
    df = spark.createDataFrame([(int(x), int(x) * 7) for x in d], "d1 long, d2 long").repartition(5)
    bits = np.unpackbits(pt.count_min(df, 1 << 16))
    single = np.zeros(500, bool)
    for place in pt.cells_of(np.arange(500), np.arange(500) * 7, 1 << 16):
        single |= bits[place] == 0
    assert not single[np.arange(500) % 3 > 0].any()
    assert single[np.arange(500) % 3 == 0].mean() > 0.9


def test_odd_input(spark):
    rows = [
        (None, 0, "user", "lost"), (5, None, None, None), (5, 0, "user", "a"), (5, 0, "user", "a"), (5, 0, "bot", "b"),
        (-7, 1, "u", "x" * 100_000), (9, 3, "", None), (8, 1, None, ""), (0, 0, "user", "a"),
    ]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", depth int, d1 int")
    # a negative id's family follows Spark's remainder, which keeps the sign
    expected = [r for r in rows if r[0] is None or r[0] >= 0]
    assert got(conversation_trie(docs.filter("conv_id is null or conv_id >= 0"))) == brute(brute_rebuilt(expected))
    assert conversation_trie(docs).count() > 0
    assert got(conversation_trie(docs.limit(0))) == set()


def test_many_conversations_end_at_one_node(spark):
    rows = [(c, 0, "user", "hello") for c in range(0, 15_000, 5)] + [(7, k, "user", f"q{k}") for k in range(9)]
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(12))) == brute(brute_rebuilt(rows))


def test_query_equals_brute_force_and_sql(spark):
    expected = brute(brute_rebuilt([tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]))
    assert got(queries()["op13_prefix_trie"](spark, SF)) == expected
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    assert set(con.execute(f"select {', '.join(NODE_COLUMNS)} from ({oracle_sql()['op13_prefix_trie']})").fetchall()) == expected
