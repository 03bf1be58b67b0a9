from __future__ import annotations

import itertools
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import catalog
from pulsegrid.llm import line_crf as crf

DOCS = "doc_id long, text string, score double, quality int, label int"


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    per_text = np.array([3, 1, 5, 2])
    u, moves = rng.standard_normal(11), rng.standard_normal((2, 2))
    good, expected, partition = crf.forward_backward(u, per_text, moves)
    at, all_moves = 0, np.zeros((2, 2))
    for k, n in enumerate(per_text):
        paths = list(itertools.product([0, 1], repeat=int(n)))
        s = np.array([sum(u[at + i] * y[i] for i in range(n)) + sum(moves[a, b] for a, b in zip(y, y[1:])) for y in paths])
        p = np.exp(s) / np.exp(s).sum()
        assert partition[k] == pytest.approx(np.log(np.exp(s).sum()))
        for i in range(n):
            assert good[at + i] == pytest.approx(sum(q for q, y in zip(p, paths) if y[i]))
        for q, y in zip(p, paths):
            for a, b in zip(y, y[1:]):
                all_moves[a, b] += q
        at += n
    assert expected == pytest.approx(all_moves)


def test_line_features_of_each_line():
    texts = [b"Ab ab AB.\n\nx x x\nAb ab AB.", b"", "é|!9 #".encode()]
    own, length, per_text = crf.line_features(texts)
    assert per_text.tolist() == [4, 1, 1] and length.tolist() == [9, 0, 5, 9, 0, 7]
    one = [crf.line_features([t]) for t in texts]
    assert own == pytest.approx(np.concatenate([o[0] for o in one]))
    assert own[2, 10] == pytest.approx(2 / 3) and own[2, 11] == pytest.approx(2 / 3)
    assert own[:, 12].tolist() == [1, 0, 0, 1, 0, 0] and own[:, 13].tolist() == [0, 1, 0, 0, 1, 0]
    x = crf.with_neighbours(own, per_text)
    assert (x[1, crf.OWN : 2 * crf.OWN] == own[0]).all() and (x[4, : ] [crf.OWN : 3 * crf.OWN] == 0).all()


def frames(spark, docs, labels):
    return (
        spark.createDataFrame([(i, t, 0.5, 0, 1) for i, t in docs], DOCS),
        spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int"),
    )


def test_odd_rows(spark):
    good, bad = "The plain line of words.\nAnother line, it is.", "ZZ!! QQ!! RR!!\nAA!! BB!! TT!! KK!!"
    docs = [(i, good + f" n{i}" if i % 2 else bad + f" Q{i}!!") for i in range(200)]
    labels = [(i, i % 2) for i in range(200)] + [(3, 1), (4, 1), (9999, 0), (5, None), (None, 0)]
    docs += [(200, None), (201, ""), (202, "\n" * 5_000), (None, good), (203, good), (203, good), (204, (bad + "\n") * 20_000)]
    d, lab = frames(spark, docs, labels)
    got = crf.score_documents(d, lab).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert all(by[i] == i % 2 for i in range(200)) and by[203] == 1 and by[204] == 0 and by[None] == 1
    kept = crf.keep_good(d, lab)
    assert kept.columns == d.columns and kept.count() == sum(r["predicted"] for r in got)
    none = crf.score_documents(d, lab.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert {r["score"] for r in crf.score_documents(d, lab.filter("quality = 1")).collect()} == {1.0}
    assert crf.score_documents(d.limit(0), lab).count() == 0


def test_a_long_document_uses_up_no_bound(spark):
    good, bad = "The plain line of words.\nAnother line, it is.", "ZZ!! QQ!! RR!!\nAA!! BB!! TT!! KK!!"
    ids = spark.range(200).filter("crc32(cast(id as string)) % 3 != 1").orderBy(F.xxhash64("id", F.lit(9))).collect()
    first = ids[0]["id"]  # of the sample's order
    docs = [(i, good + f" n{i}" if i % 2 else bad + f" Q{i}!!") for i in range(200)]
    docs[first] = (first, "\n".join([good if first % 2 else bad] * 110_000))
    assert docs[first][1].count("\n") > 200_000
    d, lab = frames(spark, docs, [(i, i % 2) for i in range(200)])
    sample = crf.training_sample(d, lab, "quality", "doc_id", "text").collect()
    sizes = sorted(len(r["length"]) // 8 for r in sample)
    assert len(sample) == len(ids) and sizes[-1] == crf.DOC_LINES and set(sizes[:-1]) == {2}
    got = crf.score_documents(d, lab).collect()
    assert len(got) == 200 and all(r["predicted"] == r["doc_id"] % 2 for r in got)
    assert {r["doc_id"] for r in crf.keep_good(d, lab).collect()} == set(range(1, 200, 2))


def test_line_limit(monkeypatch):
    lines = np.array([1, 5, 300_000, 7, 2])
    assert crf.line_limit(lines) == crf.DOC_LINES and crf.line_limit(np.zeros(0, np.int64)) == crf.DOC_LINES
    monkeypatch.setattr(crf, "SAMPLE_LINES", 20)
    assert crf.line_limit(lines) == 6  # 1 + 5 + 6 + 6 + 2
    monkeypatch.setattr(crf, "SAMPLE_LINES", 3)
    assert crf.line_limit(lines) == 1


def test_run_has_its_neighbours(spark, monkeypatch):
    monkeypatch.setattr(crf, "DOC_LINES", 4)
    texts = {i: "\n".join(f"{'x' * (k % 7)} {k}!" for k in range(9 + i)) for i in (2, 3, 5, 6, 8)}
    d, lab = frames(spark, list(texts.items()), [(i, i % 2) for i in texts])
    seen = 0
    for r in crf.training_sample(d, lab, "quality", "doc_id", "text").collect():
        own, length = np.frombuffer(r["own"]).reshape(-1, crf.OWN), np.frombuffer(r["length"])
        assert len(length) == 4
        x = crf.with_neighbours(own, np.array([len(own)]))[r["before"] :][:4]
        whole = [crf.with_neighbours(*(crf.line_features([t.encode()])[k] for k in (0, 2))) for t in texts.values()]
        assert any(np.array_equal(x, w[k : k + 4]) for w in whole for k in range(len(w) - 3))
        seen += 1
    assert seen > 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in catalog.op9_quality(spark, sf).collect() if r["held_out"] and r["doc_id"] in labels]
    bad = [r for r in got if labels[r["doc_id"]] == 0]
    good = [r for r in got if labels[r["doc_id"]] == 1]
    assert sum(r["predicted"] == 0 for r in bad) >= 0.8 * len(bad)
    assert sum(r["predicted"] for r in good) >= 0.95 * len(good)


def test_marginals_of_a_long_chain():
    rng = np.random.default_rng(2)
    moves = rng.normal(size=(2, 2))
    for n in (1, 2, 3, 4, 5, 16, 17, 50, 1001):
        unary = rng.normal(size=n) * 3
        good, _, _ = crf.forward_backward(unary, np.array([n]), moves)
        assert np.allclose(crf.chain_marginals(unary, moves), good, atol=1e-9), n


def odd_texts():
    rng = np.random.default_rng(8)
    lines = [" ".join("".join(chr(rng.integers(97, 123)) for _ in range(rng.integers(1, 7))) for _ in range(rng.integers(0, 9))) for _ in range(60)]
    text = lambda n: "\n".join(lines[k] for k in rng.integers(0, 60, n)).encode()
    return [text(300), b"\n" * 500, b"x" * 900, b"aa bb aa  aa \t" * 90, b"\n" + text(40) + b"\n\n", "é! É 12 |".encode() * 70 + b"\n", text(1) + b"\n" + b"ab " * 400 + b"\n" + text(30), b" ", b"z"]


@pytest.mark.parametrize("piece", [7, 40, 333])
def test_long_texts_score_as_short_ones(monkeypatch, piece):
    rng = np.random.default_rng(1)
    model = crf.Model(rng.normal(size=crf.WIDTH) * 0.3, rng.normal(size=(2, 2)), (0.1, 0.7))
    want = model.scores(odd_texts())
    whole = [crf.line_table([t]) for t in odd_texts()]
    monkeypatch.setattr(crf, "BLOCK_BYTES", piece)
    monkeypatch.setattr(crf, "LONG_BYTES", 0)
    for text, (own, length, _, key) in zip(odd_texts(), whole):
        pieces = [np.concatenate(c) for c in zip(*crf.line_pieces(text))]
        assert np.allclose(pieces[0], own) and (pieces[1] == length).all()
        # equal lines have equal hashes whatever piece they stand in
        assert (crf.repeated(np.zeros(len(key), int), pieces[2]) == crf.repeated(np.zeros(len(key), int), key)).all()
    assert np.allclose(model.scores(odd_texts()), want, atol=1e-9)


def test_memory_of_a_long_text():
    import subprocess
    import sys

    code = """
import resource, numpy as np
from pulsegrid.llm import line_crf as crf
rng = np.random.default_rng(1)
model = crf.Model(rng.normal(size=crf.WIDTH) * 0.3, rng.normal(size=(2, 2)), (0.1, 0.7))
line = b"some words stand in this line of the text, and it has an end.\\n"
text = b"".join(line[: 10 + k % 50] + b"\\n" for k in range(600_000))
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
model.scores([text, b"x y " * 5_000_000])
print(len(text), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=str(Path(crf.__file__).parents[2]), check=True)
    size, grown = map(int, out.stdout.split()[-2:])
    # 20 MB in short lines and 20 MB in one line: some 10 bytes a byte and a bounded piece
    assert size > 20_000_000 and grown < 450_000
