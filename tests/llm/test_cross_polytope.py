from __future__ import annotations

import numpy as np
import pytest

from pulsegrid.llm import catalog
from pulsegrid.llm import cross_polytope as cp

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, axis string"


def exact(rows, k=10, step=100):
    good = [(i, np.asarray(v, np.float64)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for i, v in good:
        if i % step == 0:
            near = sorted((float(np.linalg.norm(w - v)), j) for j, w in good if j != i and len(w) == len(v))
            out[i] = near[:k]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, "a") for i, v in rows], SCHEMA)


def f32(v):
    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("blocks", [(8192, 16384), (50, 2)])
def test_recall_and_exact_scores(spark, monkeypatch, blocks):
    monkeypatch.setattr(cp, "BLOCK_VECTORS", blocks[0])
    monkeypatch.setattr(cp, "BLOCK_QUERIES", blocks[1])
    rng = np.random.default_rng(5)
    rows = [(i, f32(rng.standard_normal(64))) for i in range(1500)]
    rows += [(1500 + i, rows[100][1]) for i in range(30)]  # a common vector
    want = exact(rows)
    got: dict = {}
    for r in cp.nearest_neighbours(frame(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    assert set(got) == set(want)
    vectors = {i: np.asarray(v, np.float64) for i, v in rows}
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [x[0] for x in found] == list(range(1, 11))
        assert [(s, i) for _, s, i in found] == sorted((s, i) for _, s, i in found)
        for _, s, i in found:
            assert s == pytest.approx(float(np.linalg.norm(vectors[i] - vectors[q])), rel=1e-12, abs=1e-15)
        hit += len({i for _, _, i in found} & {i for _, i in want[q]})
    assert hit >= 0.9 * sum(map(len, want.values()))
    assert [i for _, _, i in got[100]] == list(range(1500, 1510))  # ties to the smaller id


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0, 0.0]), (1, [0.0, 2.0, 0.0]), (2, [-1.0, 0.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]),
            (6, [1.0, None, 0.0]), (7, [nan, 0.0, 1.0]), (8, [inf, 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
            (100, [5.0]), (101, [-3.0]), (1, [0.0, 2.0, 0.0]), (200, None), (300, [1e-30, 1e-30, 0.0]), (400, [1.0, 2.0, 3.0, 4.0, 5.0])]
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in cp.nearest_neighbours(frame(spark, rows)).collect()}
    by: dict = {}
    for (q, _), (i, s) in sorted(got.items()):
        by.setdefault(q, []).append((pytest.approx(s), i))
    want = exact([(i, None if v is None else f32([x if x is not None else nan for x in v])) for i, v in dict(rows).items()])
    assert {q: v for q, v in by.items()} == {q: [(s, i) for s, i in v] for q, v in want.items() if v}


@pytest.mark.parametrize("own_vectors", [False, True])
def test_copies_and_shared_ids_crowd_out_none(spark, own_vectors):
    rng = np.random.default_rng(8)
    at = rng.standard_normal(16)
    rows = [(i, f32(at + 0.05 * rng.standard_normal(16))) for i in range(300)]
    rows[0] = (0, f32(at))
    rows[1] = (1, f32(at + 0.001))
    rows += [(1, f32(at + 0.001 + (1e-5 * n if own_vectors else 0))) for n in range(15)]
    x = {}
    for i, v in rows:
        x[i] = min(x.get(i, np.inf), float(np.linalg.norm(np.asarray(v) - np.asarray(rows[0][1]))))
    want = sorted((s, i) for i, s in x.items() if i)[:10]
    for axes in (cp.PROBES, 32):  # all 32 signed axes: exact
        found = cp.nearest_neighbours(frame(spark, rows), query_filter="vec_id = 0", probes=axes).orderBy("rank").collect()
        assert [r["vec_id"] for r in found] == [i for _, i in want]
        assert [r["score"] for r in found] == pytest.approx([s for s, _ in want])


def test_empty(spark):
    assert cp.nearest_neighbours(frame(spark, [(0, [1.0])]).limit(0)).count() == 0


def brute(x, asked, k=10):
    out = {}
    for q in asked:
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        out[q] = set(np.lexsort((np.arange(len(x)), d))[:k].tolist())
    return out


def measured(spark, monkeypatch, x, step):
    """Recall, and distances evaluated by rows times queries."""
    pairs = []
    real = cp._search_codes

    def search(rows, asked, k, plan, n, m):
        schema = "uid long, dim int, tab int, code long"
        codes = [
            df.select("uid", "vec").mapInArrow(lambda b, p=p: cp._code_rows(b, plan[2], plan[1], p), schema)
            for df, p in ((rows, 1), (asked, plan[3]))
        ]
        met = codes[1].withColumnRenamed("uid", "q").join(codes[0], ["dim", "tab", "code"]).select("q", "uid").distinct()
        pairs.append(met.count() / (n * m))
        return real(rows, asked, k, plan, n, m)

    monkeypatch.setattr(cp, "_search_codes", search)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in cp.nearest_neighbours(df, query_filter=f"vec_id % {step} = 0").collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(x, range(0, len(x), step))
    assert {q: len(v) for q, v in got.items()} == {q: 10 for q in want}
    return sum(len(got[q] & want[q]) for q in want) / (10 * len(want)), pairs


def test_buckets_grow_with_the_table(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((20_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    recall, (share,) = measured(spark, monkeypatch, x, 400)
    assert recall >= 0.9 and share < 0.11, (recall, share)


@pytest.mark.parametrize("n", [1_200, 3_000])
def test_small_tables_are_searched_by_the_same_codes(spark, monkeypatch, n):
    """No other method below some number of rows: every query starts with the first round and goes on while it has met too few."""
    rounds = []
    real = cp._search_codes

    def search(rows, asked, k, plan, n, m):
        rounds.append((plan, m))
        return real(rows, asked, k, plan, n, m)

    monkeypatch.setattr(cp, "_search_codes", search)
    monkeypatch.setattr(cp, "PLANS", tuple((500, *p[1:]) for p in cp.PLANS))
    rng = np.random.default_rng(6)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in cp.nearest_neighbours(df).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(x, range(0, n, 100))
    assert sum(len(got[q] & want[q]) for q in want) >= 9 * len(want)
    assert [p for p, _ in rounds] == list(cp.PLANS[: 3 if n == 1_200 else 2]) and rounds[0][1] == len(want)


def test_lengths_that_differ_are_not_searched_by_direction_alone(spark, monkeypatch):
    monkeypatch.setattr(cp, "PLANS", ((1_000, 2, 32, 40),))
    rng = np.random.default_rng(4)
    x = rng.standard_normal((3_000, 64)) * rng.uniform(1, 10, (3_000, 1))
    recall, pairs = measured(spark, monkeypatch, x, 100)
    assert recall >= 0.9 and not pairs


def test_codes_find_what_one_hash_finds(spark, monkeypatch):
    """Copies, shared ids, several dimensions, blocks of few rows: with all codes probed the search is exact."""
    monkeypatch.setattr(cp, "PLANS", ((1, 2, 3, 10_000),))
    monkeypatch.setattr(cp, "EVEN_LENGTHS", np.inf)
    monkeypatch.setattr(cp, "BLOCK_VECTORS", 40)
    monkeypatch.setattr(cp, "BLOCK_QUERIES", 2)
    rng = np.random.default_rng(7)
    rows = [(i, f32(rng.standard_normal(4))) for i in range(250)]
    rows += [(300 + i, rows[100][1]) for i in range(40)] + [(400 + i, f32(rng.standard_normal(3))) for i in range(30)] + [(5, rows[200][1]), (7, rows[100][1])]
    rows += [(100, None), (500, [0.0, 0.0, 0.0, 0.0])]
    got: dict = {}
    for r in cp.nearest_neighbours(frame(spark, rows)).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in (0, 100, 200, 300):
        own = next(np.asarray(v) for i, v in rows if i == q and v)
        near: dict = {}
        for i, v in rows:
            if i != q and v and any(v) and len(v) == len(own):
                near[i] = min(near.get(i, np.inf), float(np.linalg.norm(np.asarray(v) - own)))
        want = sorted((d, i) for i, d in near.items())[:10]
        assert [i for _, i, _ in sorted(got[q])] == [i for _, i in want]
        assert [d for *_, d in sorted(got[q])] == pytest.approx([d for d, _ in want], abs=1e-12)


def test_probed_codes_are_those_of_the_greatest_sums():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((5, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for hashes in (2, 3):
        signed = [np.stack([y, -y], axis=2).reshape(5, -1) for y in (cp.rotate(x, 4 * hashes + h) for h in range(hashes))]
        sums = signed[0]
        for s in signed[1:]:
            sums = (sums[:, :, None] + s[:, None]).reshape(5, -1)
        assert (cp.best_codes(x, 4, hashes, 6) == np.argsort(-sums, axis=1)[:, :6]).all()


def test_recall_on_the_tables(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows], np.float64)
    ids = np.array([i for i, _ in rows])
    got: dict = {}
    for r in catalog.op8_neighbours(spark, sf).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        d = np.linalg.norm(x - x[ids == q][0], axis=1)
        d[ids == q] = np.inf
        near = set(ids[np.lexsort((ids, d))[:10]].tolist())
        hit, total = hit + len(near & got[q]), total + 10
    assert hit >= 0.95 * total


def shuffled_rows(df):
    """Rows that the exchanges of a frame have written, and the rows it returns."""
    returned = df.collect()

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        own = node.metrics().get("shuffleRecordsWritten")
        below = node.children()
        return (own.get().value() if own.isDefined() else 0) + sum(walk(below.apply(i)) for i in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan()), returned


def test_pairs_are_never_rows(spark, monkeypatch):
    """What is dealt goes with vectors and queries, however many of them meet; before, each pair was a row of the task that ranks."""
    monkeypatch.setattr(cp, "BLOCK_VECTORS", 500)
    rng = np.random.default_rng(9)
    at = rng.standard_normal(16)
    x = at + 0.01 * rng.standard_normal((2_000, 16))  # nearly all have the same codes
    known = spark.createDataFrame([(i, i, v.tolist()) for i, v in enumerate(x)], "uid long, vec_id long, vec array<double>")
    known = known.repartition(3)
    asked = known.filter("vec_id % 40 = 0")
    written, found = shuffled_rows(cp._search_codes(known, asked, 10, (1, 2, 8, 40), 2_000, 50))
    met = sum(r["met"] for r in found)
    assert met > 0.9 * 50 * 2_000
    assert 2_000 <= written <= 2_000 + 2_000 + 50 * 5, written  # repartition, vectors, queries for each block
    want = brute(x, range(0, 2_000, 40))
    got: dict = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert sum(len({i for _, i in sorted(got[q])[:10]} & want[q]) for q in want) >= 0.95 * 500


@pytest.mark.parametrize("kind", ["float", "double"])
def test_small_blocks_give_what_large_ones_give(spark, monkeypatch, kind):
    """Blocks, marks, slices and parts of few rows, several dimensions, hot and repeated rows: exact where all codes are probed."""
    monkeypatch.setattr(cp, "PLANS", ((1, 2, 3, 10_000),))
    monkeypatch.setattr(cp, "EVEN_LENGTHS", np.inf)
    for name, value in (("BLOCK_VECTORS", 9), ("FEW_BLOCKS", 5), ("BLOCK_QUERIES", 3), ("BLOCK_VALUES", 100), ("MARKS", 60), ("SLICE", 16), ("PART", 4_096), ("FILE_ROWS", 50)):
        monkeypatch.setattr(cp, name, value)
    rng = np.random.default_rng(10)
    rows = [(i, f32(rng.standard_normal(5))) for i in range(400)] + [(2_000 + i, f32(rng.standard_normal(3))) for i in range(120)]
    rows += [(1_000 + i, rows[100][1]) for i in range(30)] + rows[:50] + [(3, rows[200][1]), (100, rows[7][1])]
    want = {}
    for q, at in {(i, tuple(v)) for i, v in rows if i % 100 == 0}:
        for i, v in rows:
            if i != q and len(v) == len(at):
                near = want.setdefault(q, {})
                near[i] = min(near.get(i, np.inf), float(np.linalg.norm(np.asarray(v) - np.asarray(at))))
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    for few in (0, 10_000):
        monkeypatch.setattr(cp, "FEW_SHARED", few)
        got: dict = {}
        for r in cp.nearest_neighbours(df).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((pytest.approx(r["score"], abs=1e-12), r["vec_id"]))
        assert {q: [(s, i) for s, i in v] for q, v in got.items()} == {q: sorted((s, i) for i, s in near.items())[:10] for q, near in want.items()}


@pytest.mark.parametrize("kind, size", [(np.float32, 1), (np.float32, 1e-30), (np.float32, 1e30), (np.float64, 1), (np.float64, 1e-170), (np.float64, 1e160)])
def test_nearest_of_marked_rows_are_exact(kind, size):
    rng = np.random.default_rng(11)
    v = (size * (1 + 1e-6 * rng.standard_normal((300, 24)))).astype(kind)  # lengths far greater than distances
    ids = np.sort(rng.integers(0, 200, 300))
    rows = np.flatnonzero(rng.random(300) < 0.8)
    squares = np.einsum("ij,ij->i", v, v, dtype=np.float64)
    with np.errstate(all="ignore"):
        got = cp._closest(v, squares, ids, rows, v[7], 10, np.empty((32, 24), kind))
        exact: dict = {}
        for r in rows:
            d = float(np.sqrt(((v[r].astype(np.float64) - v[7].astype(np.float64)) ** 2).sum()))
            exact[ids[r]] = min(exact.get(ids[r], np.inf), d)
    want = sorted((d, i) for i, d in exact.items())[:10]
    assert list(zip(got[1], got[0])) == want


def test_a_rotation_is_its_rounds():
    rng = np.random.default_rng(12)
    for dim in (1, 3, 64, 100, 130):
        x = rng.standard_normal((7, dim))
        y = np.zeros((7, cp.padded(dim)))
        y[:, :dim] = x
        assert np.allclose(cp.rotate(x, 5), cp._rounds(y, 5), atol=1e-12)


def test_rows_of_all_axes_come_in_parts():
    """2,000 queries of 256 values at all 512 axes were 2 GB at once."""
    pa = pytest.importorskip("pyarrow")
    rng = np.random.default_rng(13)
    vectors = pa.array([v.tolist() for v in rng.standard_normal((300, 256))], pa.list_(pa.float64()))
    batch = pa.record_batch({"vec_id": pa.array(range(300), pa.int64()), "vec": vectors})
    n = 0
    for part in cp._hash_rows([batch], range(1), None):
        assert part.nbytes <= 10 * cp.PART
        n += part.num_rows
    assert n == 300 * 512


def test_bytes_come_back():
    pa = pytest.importorskip("pyarrow")
    x = np.arange(60, dtype=np.uint16).reshape(12, 5)
    packed = pa.chunked_array([cp._bytes(x[:4]), cp._bytes(x[:0]), cp._bytes(x).slice(4, 3), cp._bytes(x[7:])])
    assert (cp._rows(packed, np.uint16) == x).all()
