from __future__ import annotations

import random
import zlib

import duckdb
import pytest

from pulsegrid.llm import catalog
from pulsegrid.llm.mixing import mix, plan_mix
from pulsegrid.llm.sharding import shard_by_bytes

DOCS = "doc_id long, text string, source string, shard int, key string, rate double"


def minimax(sizes: list[int], shards: int) -> int:
    """Smallest capacity by trying the greedy fill at growing capacities."""
    best = max(max(sizes), -(-sum(sizes) // shards))
    while True:
        used, room = 1, best
        for s in sizes:
            if s > room:
                used, room = used + 1, best
            room -= s
        if used <= shards:
            return best
        best += 1


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x", 0.5) for i, t, s in rows], DOCS)


@pytest.mark.parametrize("seed,shards,cells", [(1, 5, 64), (2, 24, 64), (3, 3, 16384)])
def test_capacity_is_minimal_and_slots_gapless(spark, seed, shards, cells, monkeypatch):
    from pulsegrid.llm import sharding

    monkeypatch.setattr(sharding, "MAX_CELLS", cells)
    monkeypatch.setattr(sharding.minimax_cuts, "__defaults__", (cells,))
    rng = random.Random(seed)
    texts = ["w" * rng.choice([0, 1, 5, 40, 700]) + str(rng.randrange(60)) for _ in range(150)]
    rows = [(i, rng.choice(texts), "a") for i in range(400)]
    rows += [(400, None, None), (401, "", "a"), (402, "ü" * 5000, "a"), (403, None, "b"), (5, rows[5][1], "a")]
    got = shard_by_bytes(table(spark, rows), shards).collect()
    assert len(got) == len(rows)
    groups: dict = {}
    for i, t, _ in rows:
        g = groups.setdefault(t, [i, 0])
        g[0], g[1] = min(g[0], i), g[1] + (len(t.encode()) if t else 0) + 8
    sizes = [s for _, s in sorted(groups.values())]
    by: dict = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert max(sum(r["size"] for r in v) for v in by.values()) == minimax(sizes, shards)
    for v in by.values():
        assert sorted(r["slot"] for r in v) == list(range(len(v)))
    texts_of = {(i, zlib.crc32((t or "").encode())): t for i, t, _ in rows}
    where: dict = {}
    for r in got:
        t = texts_of[(r["doc_id"], r["text_crc32"])]
        where.setdefault(t, set()).add(r["shard"])
        assert r["size"] == (len(t.encode()) if t else 0) + 8
    assert all(len(v) == 1 for v in where.values())
    firsts = sorted((r["group_first"], r["shard"]) for r in got)
    assert [s for _, s in firsts] == sorted(s for _, s in firsts)  # contiguous in group order


def test_empty_table(spark):
    assert shard_by_bytes(table(spark, []).limit(0)).count() == 0
    assert plan_mix(table(spark, []).limit(0)).count() == 0


def test_mix_takes_what_it_plans(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 30))), rng.choice("aaaab")) for i in range(600)]
    rows += [(600, None, "c"), (601, "x y z\x0bq", None), (602, "", "empty"), (602, "", "empty"), (None, "a b", "a")]
    docs = table(spark, rows)
    planned = plan_mix(docs).collect()
    assert len(planned) == len(rows)
    total = sum(r["size"] for r in planned)
    sources = {r["source"]: r for r in planned}
    assert sum(r["target"] for r in sources.values()) == pytest.approx(total)
    for s, r in sources.items():
        assert r["target"] <= 3 * r["source_size"] + 1e-9
        taken = sum(x["size"] * x["copies"] for x in planned if x["source"] == s)
        if r["source_size"] > 500:
            assert taken == pytest.approx(r["target"], rel=0.15)
    assert all(0 <= r["copies"] <= 3 for r in planned)
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in planned)
    assert sources[None]["size"] == 3


def test_mixing_sql(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    got = sorted(map(tuple, catalog.op6_mixing(spark, sf).collect()))
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    assert got == sorted(con.sql(catalog.MIXING_SQL).fetchall())
