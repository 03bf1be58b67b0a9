from __future__ import annotations

import math
import random

import pytest

from pulsegrid.llm import catalog
from pulsegrid.llm import toxic_segments as tox

DOCS = "doc_id long, text string, score double, toxic int, label int"


def brute_segments(values):
    """Split recursively: the best segment first (the longest prefix-free of
    equal ones), then left and right of it."""
    def best(lo, hi):
        top = None
        for a in range(lo, hi):
            s = 0.0
            for b in range(a, hi):
                s += values[b]
                if s > 1e-12 and (top is None or s > top[0] + 1e-12):
                    top = (s, a, b)
        if top is None:
            return []
        s, a, b = top
        return best(lo, a) + [(a, b, s)] + best(b + 1, hi)
    return best(0, len(values))


@pytest.mark.parametrize("seed", range(40))
def test_maximal_segments_equal_recursive_search(seed):
    rng = random.Random(seed)
    values = [rng.choice([-0.7, -0.7, -0.7, 0.31, 1.9, 2.83, 5.17]) + (rng.random() * 1e-3 if rng.random() < 1 else 0) for _ in range(30)]
    values = [v if v > 0 else -0.7 for v in values]
    got = tox.maximal_segments([(k, v) for k, v in enumerate(values) if v > 0], 0.7)
    want = brute_segments(values)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in want])


def test_rate_is_the_root():
    rate = tox.rate_of({-0.1: 1000.0, 3.0: 1.0})
    assert (1000 * math.exp(-0.1 * rate) + math.exp(3 * rate)) / 1001 == pytest.approx(1, abs=1e-9)


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(i, t, 0.5, 0, 1) for i, t in docs], DOCS),
        spark.createDataFrame([(i, 1, y) for i, y in labels], "doc_id long, quality int, toxic int"),
    )


def test_passages_and_odd_rows(spark):
    rng = random.Random(3)
    plain = [f"w{k}" for k in range(80)]

    def text(toxic):
        words = [rng.choice(plain) for _ in range(60)]
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(20, 30), "Grumblo" + rng.choice(["n", "nes", "st", "rix"]))
        return " ".join(words)

    docs = [(i, text(i % 3 == 0)) for i in range(400)]
    labels = [(i, int(i % 3 == 0)) for i in range(400)] + [(3, 1), (9999, 1), (5, None), (None, 1), (7, 1)]
    docs += [(400, None), (401, ""), (402, "...!"), (None, "w1 w2"), (403, "grumbloxx, GRUMBLONS!"), (404, "w1 " * 60_000 + "grumblon grumblost grumblones grumblorix"), (3, docs[3][1])]
    d, lab = frames(spark, docs, labels)
    got = tox.score_documents(d, lab).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert all(by[i] == (i % 3 == 0) for i in range(400))
    assert [by[i] for i in (400, 401, 402, None, 403, 404)] == [0, 0, 0, 0, 1, 1]
    model = tox.fit(d, lab)
    found = [r for r in tox.toxic_passages(d, model).collect() if r["doc_id"] == 0]
    words = docs[0][1].lower().split()
    assert found and all(words[r["first_word"]].startswith("grumblo") and words[r["last_word"]].startswith("grumblo") for r in found)
    assert sum(w.startswith("grumblo") for r in found for w in words[r["first_word"] : r["last_word"] + 1]) == 4
    assert {r["predicted"] for r in tox.score_documents(d, lab.limit(0)).collect()} == {0}
    assert tox.score_documents(d.limit(0), lab).count() == 0


@pytest.mark.parametrize("size", [1, 2, 61, 62, 63, 64, 65, 66, 67, 68, 69, 70, 127, 128, 129, 130, 131, 500])
def test_every_unit_stands_in_one_stretch(size):
    rng = random.Random(size)
    word = "".join(rng.choice("ab\u4e2d\u6587") for _ in range(size))
    got = tox.stretches(word.encode())
    whole = f"^{word}$"
    want = {whole[k : k + n] for n in tox.GRAMS for k in range(len(whole) - n + 1)}
    assert set().union(*map(tox.units, got)) - set(got) == want - set(got)
    begins = [sum(len(t) - n + 1 > k for k in range(tox.STRETCH)) for t in got for n in (3,)]
    assert sum(begins) == max(0, len(whole) - 2)
    assert len(got) == 1 or size > 64


def test_long_runs_are_scored_by_their_units(spark):
    rng = random.Random(4)
    signs = [chr(0x4E00 + k) for k in range(300)]

    def run(toxic, size=400):
        text = [rng.choice(signs) for _ in range(size)]
        for k in range(4 if toxic else 0):
            text.insert(60 + 90 * k, "\u9f98\u9f49\u9f56\u9f6a")
        return "".join(text)

    plain = [f"w{k}" for k in range(80)]
    spaced = [[rng.choice(plain) for _ in range(60)] + ["grumblon", "grumblones"] * (2 * (i % 3 == 0)) for i in range(300)]
    docs = [(i, run(i % 3 == 0) if i >= 300 else " ".join(spaced[i])) for i in range(600)]
    labels = [(i, int(i % 3 == 0)) for i in range(600)]
    glued = "grumblon" * 4 + "grumblones" * 40
    docs += [(700, glued), (701, "".join(plain * 3)), (702, run(True, 3_000)), (703, run(False, 3_000)), (704, "w1 w2 " + run(False) + " w3 " + glued + " w4")]
    d, lab = frames(spark, docs, labels)
    by = {r["doc_id"]: r["predicted"] for r in tox.score_documents(d, lab).collect()}
    right = sum(by[i] == (i % 3 == 0) for i in range(600))
    assert right >= 594
    assert [by[i] for i in (700, 701, 702, 703, 704)] == [1, 0, 1, 0, 1]
    found = [r for r in tox.toxic_passages(d, tox.fit(d, lab)).collect() if r["doc_id"] == 704]
    assert found and all(r["first_word"] == r["last_word"] == 4 for r in found)  # words, not stretches


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in catalog.op3_toxicity(spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    toxic = [r for r in got if labels[r["doc_id"]] == 1]
    clean = [r for r in got if labels[r["doc_id"]] == 0]
    caught = sum(r["predicted"] for r in toxic) / len(toxic)
    spared = sum(r["predicted"] == 0 for r in clean) / len(clean)
    print(caught, spared)
    assert caught >= 0.8 and spared >= 0.97
