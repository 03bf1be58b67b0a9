from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import inverted_index as ix

SCHEMA = "doc_id long, text string, item_id string, n_words int, items string"
ITEMS = "item_id long, text string, doc_id int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, window=10):
    out = []
    for i, t in docs:
        w = words(t)
        hit, found = set(), set()
        for item, text in items:
            v = words(text)
            n = min(window, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for s in range(len(w) - n + 1):
                    if w[s : s + n] == v[a : a + n]:
                        hit.update(range(s, s + n))
                        found.add("" if item is None else str(item))
        ids = sorted(found)
        out.append((i, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    vocab = ["a", "The", "of", "x1", "Éa", "日本", "zz", "q"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 25)))) for k in range(12)]
    items += [(3, "the the the"), (None, "x1 zz, Q."), (20, None), (21, "...")]
    docs = []
    for i in range(60):
        t = " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 40)))
        if i % 3 == 0:
            t += rng.choice([" ", ", ", "\n"]) + rng.choice(items)[1].upper() if rng.choice(items)[1] else ""
        docs.append((i, t))
    docs += [(60, None), (61, ""), (None, "x1 zz q"), (5, docs[5][1]), (5, "X1-ZZ-Q"), (62, "a " * 30_000 + "x1 zz q")]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "z", 1, "y") for i, t in docs], SCHEMA),
        spark.createDataFrame([(i, t, 9) for i, t in items], ITEMS),
    )


@pytest.mark.parametrize("block,shard", [(200_000, 400_000), (40, 100)])
def test_equals_brute_force(spark, monkeypatch, block, shard):
    monkeypatch.setattr(ix, "BLOCK_WORDS", block)
    monkeypatch.setattr(ix, "SHARD_WORDS", shard)
    docs, items = case(1)
    items = [(i, t) for i, t in items if t is None or docs[62] is None or len(t) < 500]
    d, t = frames(spark, docs, items)
    got = sorted((tuple(r)[:6] for r in ix.decontamination_report(d, t).collect()), key=str)
    assert got == brute(docs, items)
    kept = ix.drop_contaminated(d, t)
    assert kept.columns == d.columns
    clean = sorted((i, x or "") for i, x in docs if not brute([(i, x)], items)[0][5] and i is not None)
    assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect() if r["doc_id"] is not None) == clean


def test_many_blocks_of_a_shuffled_table_and_items_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(ix, "BLOCK_WORDS", 40)
    rng = random.Random(9)
    long = [f"w{rng.randrange(60)}" for _ in range(700)]
    items = [(1, " ".join(long)), (2, "w1 w2 w3"), (3, " ".join(long[300:380])), (4, "q0 q1 q2 q3")]
    docs = [(i, " ".join(long[a : a + rng.randrange(5, 60)] + ["x"])) for i, a in enumerate(rng.randrange(690) for _ in range(80))]
    docs += [(90, "q0 q1 q2 q3"), (91, "w1 w2 w3"), (92, "nothing here")]
    d, t = frames(spark, docs, items)
    for block in ix.item_blocks(t):
        assert sum(len(words) for _, words in block) <= 40
    # rows come in another order each time the table is read
    shuffled = d.repartition(7).orderBy(F.rand())
    got = sorted((tuple(r)[:6] for r in ix.decontamination_report(shuffled, t).collect()), key=str)
    assert got == brute(docs, items)


def test_clashing_columns_stay(spark):
    d, t = frames(spark, [(1, "x1 zz q"), (2, "fine")], [(1, "x1 zz q")])
    d = d.selectExpr("doc_id", "text", "1 as _id", "2 as _CRC", "3 as n_hit", "4 as row_id", "5 as items")
    kept = ix.drop_contaminated(d, t)
    assert kept.columns == d.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_empty_tables(spark):
    d, t = frames(spark, [(1, "a b")], [(1, "a b")])
    assert ix.decontamination_report(d.limit(0), t).count() == 0
    row = ix.decontamination_report(d, t.limit(0)).first()
    assert (row["n_words"], row["n_hit"], row["items_sha256"]) == (2, 0, hashlib.sha256(b"").hexdigest())


def test_stored_index_answers_phrases_and_proximity(spark, monkeypatch):
    monkeypatch.setattr(ix, "SHARD_WORDS", 60)
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choice("abcdef") for _ in range(30))) for i in range(20)]
    d, _ = frames(spark, docs, [])
    index = ix.build_index(d)
    got = sorted((r["doc_id"], r["start"]) for r in ix.phrase_matches(index, [("p", "a B c")]).collect())
    assert got == sorted((i, s) for i, t in docs for s in range(28) if t.split()[s : s + 3] == ["a", "b", "c"])
    near = ix.proximity_matches(index, [("q", "a f c")], slop=5).collect()
    text = dict(docs)
    assert near
    for r in near:
        span = text[r["doc_id"]].split()[r["start"] : r["start"] + r["length"]]
        assert r["length"] <= 5 and {"a", "f", "c"} <= set(span)
    holds = {i for i, t in docs if any({"a", "f", "c"} <= set(t.split()[s : s + 5]) for s in range(26))}
    assert {r["doc_id"] for r in near} == holds


@pytest.mark.parametrize("shard", [1, 60, 400_000])
def test_proximity_gives_every_minimal_stretch(spark, monkeypatch, shard):
    monkeypatch.setattr(ix, "SHARD_WORDS", shard)
    rng = random.Random(6)
    docs = [(0, "a b a")] + [(i, " ".join(rng.choice("abcdef") for _ in range(30))) for i in range(1, 20)]
    docs += [(20, "b " * 50), (21, "a " * 10)]
    index = ix.build_index(frames(spark, docs, [])[0])
    for item, slop in (("a b", 2), ("a f c", 5), ("b", 3)):
        terms, want = set(item.split()), []
        for i, t in docs:
            w = t.split()
            holds = lambda a, b: terms <= set(w[a : b + 1])
            want += [
                (i, a, b - a + 1) for a in range(len(w)) for b in range(a, min(a + slop, len(w)))
                if holds(a, b) and not holds(a + 1, b) and not holds(a, b - 1)
            ]
        found = ix.proximity_matches(index, [("q", item)], slop=slop).collect()
        assert sorted((r["doc_id"], r["start"], r["length"]) for r in found) == sorted(want)


def test_text_crc_is_the_texts(spark):
    d, t = frames(spark, [(1, "Aé"), (2, None)], [(1, "zz")])
    assert sorted(r["text_crc32"] for r in ix.phrase_hits(d, t).collect()) == sorted([zlib.crc32("Aé".encode()), 0])
