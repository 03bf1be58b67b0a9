from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import interpolated_lm as lm
from pulsegrid.llm import packed

SCHEMA = "doc_id long, text string, block int, role string, tokens int"


def tokens(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [w.decode() for w in low.encode().split()] + ["</s>"]


def role(i):
    crc = zlib.crc32(str(i).encode()) if i is not None else 0
    return lm.TEST if crc % 7 == 2 else lm.FIT if crc // 7 % 8 == 0 else lm.TRAIN


def counts(rows, roles):
    one, two = Counter(), Counter()
    for i, t in rows:
        if role(i) in roles:
            w = tokens(t)
            one.update(w)
            two.update(zip(["</s>"] + w, w))
    return one, two


def brute(rows):
    """The same model with plain dictionaries."""
    one, two = counts(rows, {lm.TRAIN})
    n, v = sum(one.values()), len(one)
    hist = Counter()
    for i, t in rows:
        if role(i) == lm.FIT:
            w = tokens(t)
            for a, b in zip(["</s>"] + w, w):
                bucket = int(math.log2(one[a])) + 1 if one[a] else 0
                level = lambda x: round(math.log2(x) * 4) if x else lm.NONE
                hist[bucket, level(two[a, b] / max(1, one[a]) * (v + 1)), level(one[b] / max(1, n) * (v + 1))] += 1
    low, high = lm.fit_weights([(*k, c) for k, c in hist.items()])
    one, two = counts(rows, {lm.TRAIN, lm.FIT})
    n, v = sum(one.values()), len(one)
    low = low if n else 0.0
    out = []
    for i, t in rows:
        w = tokens(t)
        base = score = 0.0
        for a, b in zip(["</s>"] + w, w):
            base += math.log10((one[b] + 1) / (n + 1 * (v + 1)))
            p = low * one[b] / max(1, n) + (1 - low) / (v + 1)
            if one[a]:
                weight = high[int(math.log2(one[a])) + 1]
                p = weight * two[a, b] / one[a] + (1 - weight) * p
            score += math.log10(p)
        out.append((i, role(i) == lm.TEST, len(w), sum(one[x] > 0 for x in w), n, base, score))
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r", 2) for i, t in rows], SCHEMA).repartition(3)


def check(spark, rows):
    got = sorted(map(tuple, lm.score_documents(table(spark, rows)).collect()), key=str)
    want = sorted(brute(rows), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return got


@pytest.mark.parametrize("block,part", [(1_500_000, 2_000_000), (200, 300)])
def test_equals_plain_dictionaries(spark, monkeypatch, block, part):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "RANGE_TOKENS", part)
    rng = random.Random(1)
    vocab = [f"w{k}" for k in range(40)] + ["The", "É", "x,"]
    rows = []
    for i in range(200):
        w = [rng.choice(vocab)]
        for _ in range(rng.randrange(0, 60)):
            w.append(vocab[(vocab.index(w[-1]) * 7 + rng.randrange(3)) % len(vocab)] if rng.random() < 0.8 else rng.choice(vocab))
        rows.append((i, rng.choice([" ", "\n", "\x0b "]).join(w)))
    rows += [(200, None), (201, ""), (202, " \t"), (None, "the É new"), (5, rows[5][1]), (5, rows[5][1]), (203, "w1 " * 30_000), (204, "a\x1cb c")]
    got = check(spark, rows)
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)  # better than the baseline on unseen text


def test_without_training_rows_and_empty(spark):
    test_only = [(i, "a b") for i in range(50) if role(i) == lm.TEST]
    got = check(spark, test_only)
    assert all(g[5] == 0 and g[6] == 0 for g in got)
    assert lm.score_documents(table(spark, [(1, "a")]).limit(0)).count() == 0


def test_packing_round_trips():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    assert (packed.unpack_sorted(packed.pack_sorted(keys)) == keys).all()
    parts = packed.range_of(keys, 7)
    assert (np.diff(parts.astype(int)) >= 0).all() and parts.max() < 7


def test_em_finds_the_mixture():
    assert lm._em(np.array([1.0, 0.0]), np.array([0.0, 1.0]), np.array([30.0, 70.0])) == pytest.approx(0.3, abs=1e-6)
