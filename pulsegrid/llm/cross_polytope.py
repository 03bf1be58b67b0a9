"""Approximate nearest neighbours by cross-polytope hashing.

Every vector, scaled to length 1 and filled up with zeros to a power of two,
goes through a pseudo-rotation per table: three rounds of fixed random signs
and a fast Hadamard transform. Its bucket is the nearest signed axis, the one
with the largest absolute coordinate. A query looks into the ``PROBES``
nearest signed axes of each of ``TABLES`` tables (multiprobe) and all vectors
found there are ranked by exact distance of the original vectors.

A table of vectors of very different lengths is searched so with one hash a table:
Spark deals vectors and probes by (dimension, table, axis). A bucket with more than
``BLOCK_VECTORS`` vectors is cut into blocks by a hash of the id, and its
probes visit every block; the same holds for more than ``BLOCK_QUERIES``
probes of a bucket. A task so holds one block of vectors and one of probes,
and each block returns the nearest of every probe only: no pair leaves it.

Any other table, of whatever size, gets more buckets: the axes of several independent rotations
together are one code, and a query probes the codes of the greatest sums. Vectors are dealt in blocks,
each with its codes, and queries, with the codes that they probe, go to every block. A task finds the
rows of the probed codes in its block, some queries at a time, and ranks them at once: pairs are never
rows, and a task's memory is that of one block however many candidates there are. Of equal vectors no more than can be
returned are candidates. A query that has met too few candidates probes more codes, and at last all rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import lean, stored, trim

TABLES = 12
PROBES = 8
# rounds, the same for every table: a query that meets fewer candidates than the first number goes on to the
# next round (hashes in a code, tables, probes); after the last one it meets all rows. Measured on random unit
# vectors of 64 dimensions: 0.10, 0.28 and 0.61 of all rows are candidates; recall of the first round is 0.905 at
# 16,384 rows, where it is enough, of the second 0.995 at 8,000.
PLANS = ((1_500, 2, 32, 40), (1_500, 2, 32, 160), (1_500, 2, 32, 640))
EVEN_LENGTHS = 0.05  # deviation of the lengths by their mean up to which codes of directions are used
SEED = 20_240_601
BLOCK_VECTORS = 8_192
BLOCK_QUERIES = 16_384
# the code search makes no more than so many blocks of vectors while those hold up to eight times BLOCK_VECTORS; no
# task there gets more values of vectors, or probed codes of queries
FEW_BLOCKS = 12
BLOCK_VALUES = 1 << 22
BLOCK_CODES = 1 << 24
MATRIX_WIDTH = 128  # vectors filled up to so many values are turned by a matrix
PART = 1 << 22  # codes or values made at once
MARKS = 1 << 20  # vectors by queries marked at once
SLICE = 1 << 19  # values of vectors compared at once
FILE_ROWS = 1 << 16  # rows that one task hashes
FEW_SHARED = 10_000  # hashes of vectors sent to all tasks
KEY = ["dim", "tab", "axis", "block", "qblock"]
HASHED = "vec_id long, vec binary, dim int, tab int, axis int"
FOUND = "query_id long, query_tie long, vec_id long, score double"
RANKED = FOUND + ", met long"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows (length a power of two)."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, width)
        half *= 2
    return x / np.sqrt(width)


def rotate(x: np.ndarray, table: int) -> np.ndarray:
    """The pseudo-rotation of a table, applied to unit rows."""
    width = padded(x.shape[1])
    if width <= MATRIX_WIDTH:
        return x @ _rotation(width, table)[: x.shape[1]]
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    return _rounds(y, table)


def padded(dim: int) -> int:
    """The power of two up to which a vector is filled up."""
    return 1 << max(0, int(dim - 1).bit_length())


def _rounds(y: np.ndarray, table: int) -> np.ndarray:
    width = y.shape[1]
    rng = np.random.default_rng([SEED, table, width])
    for _ in range(3):
        y = hadamard(y * np.where(rng.random(width) < 0.5, -1.0, 1.0))
    return y


@lru_cache(maxsize=256)
def _rotation(width: int, table: int) -> np.ndarray:
    """The rounds of a table as a matrix: short vectors are turned faster by one product."""
    return _rounds(np.eye(width), table)


def nearest_axes(x: np.ndarray, table: int, n: int) -> np.ndarray:
    """The ``n`` nearest signed axes of each unit row, nearest first; axis
    2i is +e_i, 2i+1 is -e_i. All axes if there are fewer."""
    y = rotate(x, table)
    signed = np.stack([y, -y], axis=2).reshape(len(y), -1)
    n = min(n, signed.shape[1])
    if n == 1:
        return np.argmax(signed, axis=1)[:, None]
    return np.argsort(-signed, axis=1, kind="stable")[:, :n]


def _hash_rows(batches, tables: range, probes: int | None):
    """One row per table (and probe). ``probes`` None: every axis."""
    for batch in batches:
        ids = np.array(batch.column(0).to_pylist(), np.int64)
        values = batch.column(1)
        lengths = np.array([len(v) for v in values], np.int64) if batch.num_rows else np.zeros(0, np.int64)
        flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        for dim in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dim)
            most = max(1, min(2_000, PART // (dim * min(probes or 4 * dim, 2 * padded(dim)))))
            for part in np.array_split(rows, max(1, -(-len(rows) // most))):
                x = flat[starts[part][:, None] + np.arange(dim)]
                raw = [r.tobytes() for r in x]
                unit = x / np.abs(x).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                for t in tables:
                    axes = nearest_axes(unit, t, probes or 4 * dim)
                    n = axes.shape[1]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "vec_id": pa.array(np.repeat(ids[part], n), pa.int64()),
                            "vec": pa.array([r for r in raw for _ in range(n)], pa.binary()),
                            "dim": pa.array(np.full(len(part) * n, dim), pa.int32()),
                            "tab": pa.array(np.full(len(part) * n, t), pa.int32()),
                            "axis": pa.array(axes.reshape(-1).astype(np.int32), pa.int32()),
                        }
                    )


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Rows with an id and a vector of finite components, not all zero."""
    kind = "array<float>" if vectors.select(vec_col).dtypes[0][1] == "array<float>" else "array<double>"  # half the disk, equal values
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast(kind).alias("vec"))
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & fine
        & F.exists("vec", lambda x: x != 0)
    )


def _nearest(key, vectors: pd.DataFrame, probes: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest ids of a block for every probe of it, each by its nearest vector."""
    out = {"query_id": [], "query_tie": [], "vec_id": [], "score": []}
    if len(vectors) and len(probes):
        vectors = vectors.sort_values("vec_id")
        v = np.frombuffer(b"".join(vectors["vec"]), np.float64).reshape(len(vectors), -1)
        ids = vectors["vec_id"].to_numpy()
        first = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))  # first row of each id
        squares = (v * v).sum(axis=1)
        q = np.frombuffer(b"".join(probes["vec"]), np.float64).reshape(len(probes), -1)
        for a in range(0, len(q), 256):
            near = squares[None, :] - 2 * (q[a : a + 256] @ v.T)
            own = probes["vec_id"].to_numpy()[a : a + 256, None] == ids[None, :]
            near[own] = np.inf
            for i in range(len(near)):
                row, one = near[i], q[a + i]
                # rounding of this form is bounded; what is as near as the k-th within it stays in
                slack = 1e-9 * (float(one @ one) + float(squares.max()))
                if len(first) > k:
                    bound = np.partition(np.minimum.reduceat(row, first), k - 1)[k - 1]
                    chosen = np.flatnonzero((row <= bound + slack) & np.isfinite(row))
                else:
                    chosen = np.flatnonzero(np.isfinite(row))
                score = np.sqrt(((v[chosen] - one) ** 2).sum(axis=1))
                order = np.lexsort((ids[chosen], score))
                order = order[np.sort(np.unique(ids[chosen][order], return_index=True)[1])][:k]
                out["query_id"] += [int(probes["vec_id"].iloc[a + i])] * len(order)
                out["query_tie"] += [int(probes["tie"].iloc[a + i])] * len(order)
                out["vec_id"] += ids[chosen][order].tolist()
                out["score"] += score[order].tolist()
    return pd.DataFrame(out).astype({"query_id": "int64", "query_tie": "int64", "vec_id": "int64", "score": "float64"})


def _search(rows: DataFrame, asked: DataFrame, k: int, tables: range, probes: int | None) -> DataFrame:
    """Nearest found of each query and block."""
    bucket = ["dim", "tab", "axis"]
    hashed = rows.mapInArrow(lambda b: _hash_rows(b, tables, 1), HASHED)
    probed = asked.mapInArrow(lambda b: _hash_rows(b, tables, probes), HASHED)
    blocks = lambda n, size: F.ceil(F.col(n) / size).cast("int")
    # one row per bucket: tables x signed axes x dimensions
    counts = (
        hashed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n"))
        .join(probed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")), bucket)
        .select(*bucket, blocks("n", BLOCK_VECTORS).alias("blocks"), blocks("m", BLOCK_QUERIES).alias("qblocks"))
    )
    counts = stored(counts, "ann-buckets")
    part = lambda n: F.pmod(F.xxhash64("vec_id", "vec"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = hashed.join(counts, bucket).withColumn("block", part("blocks")).withColumn("qblock", every("qblocks"))
    right = probed.join(counts, bucket).withColumn("qblock", part("qblocks")).withColumn("block", every("blocks"))
    left = left.select("vec_id", "vec", *KEY)
    right = right.select("vec_id", "vec", F.xxhash64("vec").alias("tie"), *KEY)

    def near(key, vectors: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        return _nearest(key, vectors, found, k)

    return left.groupBy(*KEY).cogroup(right.groupBy(*KEY)).applyInPandas(near, FOUND)


def best_codes(unit: np.ndarray, table: int, hashes: int, probes: int) -> np.ndarray:
    """The ``probes`` codes of greatest sums of coordinates for each unit row, best first."""
    score = code = None
    for h in range(hashes):
        y = rotate(unit, table * hashes + h)
        n = min(probes, 2 * y.shape[1])
        if n == 1:
            axes = np.argmax(np.abs(y), axis=1)[:, None]
            own = np.take_along_axis(y, axes, 1)
            axes, own = 2 * axes + (own < 0), np.abs(own)
        else:
            signed = np.stack([y, -y], axis=2).reshape(len(y), -1)
            axes = np.argsort(-signed, axis=1, kind="stable")[:, :n]
            own = np.take_along_axis(signed, axes, 1)
        if score is None:
            score, code = own, axes.astype(np.int64)
            continue
        # the i-th best of the left and the j-th best of the right: i x j pairs are as good at least
        i, j = np.divmod(np.arange(score.shape[1] * n), n)
        pairs = np.flatnonzero((i + 1) * (j + 1) <= probes)
        i, j = i[pairs], j[pairs]
        sums = score[:, i] + own[:, j]
        top = np.argsort(-sums, axis=1, kind="stable")[:, :probes]
        score = np.take_along_axis(sums, top, 1)
        code = np.take_along_axis(code, i[top], 1) * (2 * y.shape[1]) + np.take_along_axis(axes, j[top], 1)
    return code


def _coded(batches, tables: int, hashes: int, probes: int):
    """Parts of the batches (columns uid, others, vector): the batch, the rows of one dimension, their vectors as they
    came, and their codes by row, table and probe."""
    for batch in batches:
        values = batch.column(batch.num_columns - 1)
        lengths = pc.list_value_length(values).to_numpy(zero_copy_only=False)
        flat = values.flatten().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        for dim in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == dim)
            most = max(1, min(2_000, PART // (tables * probes), PART // (8 * dim)))
            for part in np.array_split(rows, max(1, -(-len(rows) // most))):
                vectors = flat[starts[part][:, None] + np.arange(dim)]
                x = vectors.astype(np.float64)
                unit = x / np.abs(x).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                codes = np.stack([best_codes(unit, t, hashes, probes) for t in range(tables)], axis=1)
                yield batch, part, vectors, codes


def _code_rows(batches, tables: int, hashes: int, probes: int):
    """One row per table (and probe): row number, dimension, table, code."""
    for batch, part, vectors, codes in _coded(batches, tables, hashes, probes):
        (n, _, m), dim = codes.shape, vectors.shape[1]
        uids = batch.column(0).to_numpy(zero_copy_only=False)[part]
        yield pa.RecordBatch.from_pydict(
            {
                "uid": pa.array(np.repeat(uids, tables * m), pa.int64()),
                "dim": pa.array(np.full(codes.size, dim), pa.int32()),
                "tab": pa.array(np.tile(np.repeat(np.arange(tables), m), n), pa.int32()),
                "code": pa.array(codes.reshape(-1), pa.int64()),
            }
        )


def code_type(dim: int, hashes: int) -> np.dtype:
    """The smallest type that holds a code."""
    return np.min_scalar_type((2 * padded(dim)) ** hashes - 1)


def _bytes(rows: np.ndarray) -> pa.Array:
    """The bytes of each row."""
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.shape[1] * rows.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _rows(column: pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    """The rows that ``_bytes`` was given."""
    parts = []
    for c in column.cast(pa.large_binary()).chunks:
        if len(c):
            ends = np.frombuffer(c.buffers()[1], np.int64)[c.offset : c.offset + len(c) + 1]
            parts.append(np.frombuffer(c.buffers()[2], np.uint8)[ends[0] : ends[-1]])
    return np.concatenate(parts).view(kind).reshape(len(column), -1)


def _packed_rows(batches, tables: int, hashes: int, probes: int):
    """One row per vector: row number, id, dimension, the vector's bytes and those of its codes by table and probe."""
    for batch, part, vectors, codes in _coded(batches, tables, hashes, probes):
        dim = vectors.shape[1]
        yield pa.RecordBatch.from_pydict(
            {
                "uid": batch.column(0).take(pa.array(part)),
                "vec_id": batch.column(1).take(pa.array(part)),
                "dim": pa.array(np.full(len(part), dim), pa.int32()),
                "vec": _bytes(vectors),
                "codes": _bytes(codes.reshape(len(part), -1).astype(code_type(dim, hashes))),
            }
        )


def _closest(v: np.ndarray, squares: np.ndarray, ids: np.ndarray, rows: np.ndarray, one: np.ndarray, k: int, room: np.ndarray):
    """The ``k`` nearest ids to ``one`` among ``rows`` (ascending; ``ids`` too), each by its nearest vector; their distances.
    ``room``: space for some rows of ``v``."""
    near, size = squares[rows], len(room)
    for a in range(0, len(rows), size):
        some = rows[a : a + size]
        near[a : a + size] -= 2 * (np.take(v, some, axis=0, out=room[: len(some)], mode="clip") @ one).astype(np.float64)
    exact = one.astype(np.float64)
    # rounding of this form is bounded; what is as near as the k-th within it stays in, and all if it could overflow
    limits, top = np.finfo(v.dtype), float(exact @ exact) + float(squares.max())
    slack = max(1e-9, 4 * (len(one) + 4) * limits.eps) * top + 4 * len(one) * limits.tiny if top < limits.max / 4 else np.inf
    first = np.flatnonzero(np.concatenate([[True], np.diff(ids[rows]) != 0]))  # first row of each id
    if len(first) > k:
        bound = np.partition(np.minimum.reduceat(near, first) if len(first) < len(rows) else near, k - 1)[k - 1]
        rows = rows[~(near > bound + slack)]
    score = [np.sqrt(((v[rows[a : a + size]].astype(np.float64) - exact) ** 2).sum(axis=1)) for a in range(0, len(rows), size)]
    score = np.concatenate(score)
    order = np.lexsort((ids[rows], score))
    order = order[np.sort(np.unique(ids[rows][order], return_index=True)[1])][:k]
    return ids[rows][order], score[order]


def _rank_block(vectors: pa.Table, asked: pa.Table, dim: int, hashes: int, tables: int, k: int) -> pa.Table:
    """The ``k`` nearest ids of a block for every query of it, among the vectors that have a code which the query
    probes in the same table. ``met``: how many of another id there were, in the query's first row (0 in the others).
    Memory goes with the block and not with the number of pairs."""
    out = {name: [] for name in ("query_id", "query_tie", "vec_id", "score", "met")}
    if len(vectors) and len(asked):
        kind = code_type(dim, hashes)
        ids = vectors["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        floats = np.dtype(np.float32 if len(vectors["vec"][0].as_py()) == 4 * dim else np.float64)
        v = _rows(vectors["vec"], floats)[order]
        squares = np.einsum("ij,ij->i", v, v, dtype=np.float64)
        room = np.empty((min(len(v), max(1, SLICE // dim)), dim), floats)
        codes = _rows(vectors["codes"], kind)[order]
        buckets = []  # of each table: the codes in order, where their rows begin, how many there are, the rows
        for t in range(tables):
            rows = np.argsort(codes[:, t], kind="stable").astype(np.int32)
            buckets.append((*np.unique(codes[rows, t], return_index=True, return_counts=True), rows))
        q = _rows(asked["vec"], floats)
        probed = _rows(asked["codes"], kind).reshape(len(q), tables, -1)
        own, tie = asked["vec_id"].to_numpy(), asked["uid"].to_numpy()
        own_from, own_to = np.searchsorted(ids, own, "left"), np.searchsorted(ids, own, "right")
        step = max(1, MARKS // len(v))
        marks = np.zeros((step, len(v)), bool)
        for a in range(0, len(q), step):
            marks[:] = False
            for t, (known, begins, counts, rows) in enumerate(buckets):
                probes = probed[a : a + step, t]
                at = np.minimum(np.searchsorted(known, probes), len(known) - 1)
                there = np.flatnonzero(known[at] == probes)
                n, begin = counts[at.ravel()[there]], begins[at.ravel()[there]]
                if len(there):
                    ends = np.cumsum(n)
                    places = np.arange(ends[-1]) + np.repeat(begin - (ends - n), n)
                    marks.ravel()[np.repeat(there // probes.shape[1] * len(v), n) + rows[places]] = True
            for i in range(a, min(a + step, len(q))):
                marks[i - a, own_from[i] : own_to[i]] = False
                met = np.flatnonzero(marks[i - a])
                if len(met):
                    near, score = _closest(v, squares, ids, met, q[i], k, room)
                    out["query_id"].append(np.full(len(near), own[i]))
                    out["query_tie"].append(np.full(len(near), tie[i]))
                    out["vec_id"].append(near)
                    out["score"].append(score)
                    out["met"].append(np.where(np.arange(len(near)) == 0, len(met), 0))
    return pa.table(
        {
            name: pa.array(np.concatenate(x) if x else [], pa.float64() if name == "score" else pa.int64())
            for name, x in out.items()
        }
    )


def _search_codes(candidates: DataFrame, asked: DataFrame, k: int, plan: tuple, n: int, n_asked: int) -> DataFrame:
    """Nearest found of each query and block, by codes. ``candidates``, ``asked``: with a row number ``uid``."""
    _, hashes, tables, probes = plan
    schema = "uid long, vec_id long, dim int, vec binary, codes binary"
    hashed = candidates.select("uid", "vec_id", "vec").mapInArrow(lean(lambda b: _packed_rows(b, tables, hashes, 1)), schema)
    probed = asked.select("uid", "vec_id", "vec").mapInArrow(lean(lambda b: _packed_rows(b, tables, hashes, probes)), schema)
    # a block of vectors costs a copy of each query, one of queries a copy of each vector
    vectors = min(max(BLOCK_VECTORS, -(-n // FEW_BLOCKS)), 8 * BLOCK_VECTORS)
    queries = max(1, min(BLOCK_QUERIES, BLOCK_CODES // (tables * probes)))
    count = lambda rows, size: F.ceil(F.lit(rows) / F.least(F.lit(size), F.greatest(F.lit(1), F.floor(F.lit(BLOCK_VALUES) / F.col("dim"))))).cast("int")  # noqa: E731, E501
    part = lambda blocks: F.pmod(F.xxhash64("uid"), blocks).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), blocks - 1))
    blocks, qblocks = count(n, vectors), count(n_asked, queries)
    left = hashed.withColumn("block", part(blocks)).withColumn("qblock", every(qblocks))
    right = probed.withColumn("qblock", part(qblocks)).withColumn("block", every(blocks))
    key = ["dim", "block", "qblock"]

    def rank(at: tuple, found: pa.Table, probing: pa.Table) -> pa.Table:
        try:
            return _rank_block(found, probing, at[0].as_py(), hashes, tables, k)
        finally:
            trim()

    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(rank, RANKED)


def shared_hashes(rows: DataFrame, columns: list[str], most: int) -> DataFrame:
    """Hashes of ``columns`` that more than ``most`` rows have: no other rows can be equal in them more often."""
    hashes = rows.groupBy(F.xxhash64(*columns).alias("hash")).count()
    return stored(hashes.filter(F.col("count") > most).select("hash"), "ann-shared")


def _candidates(known: DataFrame, k: int) -> DataFrame:
    """Of equal vectors, which are equally near, the smallest ids, a query's own aside: all that can be returned."""
    shared = shared_hashes(known, ["vec"], k + 1)
    n = shared.count()
    if not n:
        return known
    rows = known.withColumn("hash", F.xxhash64("vec"))
    often, rest = rows, None
    if n <= FEW_SHARED:
        often, rest = (rows.join(F.broadcast(shared), "hash", how) for how in ("left_semi", "left_anti"))
    same = Window.partitionBy("hash", "vec").orderBy("vec_id")
    kept = often.withColumn("nth", F.row_number().over(same)).filter(F.col("nth") <= k + 1).drop("nth")
    kept = kept if rest is None else kept.unionByName(rest)
    return stored(kept.select("uid", "vec_id", "vec"), "ann-candidates", FILE_ROWS)


def _search_rounds(known: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Nearest found of each query, by codes of more and more probes for those queries that have met few candidates."""
    candidates = _candidates(known, k)
    n, found = max(1, candidates.count()), None
    for plan in PLANS:
        n_asked = asked.count()
        if not n_asked:
            break
        ranked = stored(_search_codes(candidates, asked, k, plan, n, n_asked), "ann-ranked")
        found = ranked.drop("met") if found is None else found.unionByName(ranked.drop("met"))
        enough = ranked.groupBy("query_tie").agg(F.sum("met").alias("met")).filter(F.col("met") >= plan[0])
        asked = stored(asked.join(enough, asked["uid"] == enough["query_tie"], "left_anti"), "ann-asked")
    if found is not None and asked.isEmpty():
        return found
    rest = _search(candidates.select("vec_id", "vec"), asked.select("vec_id", "vec"), k, range(1), None)
    return rest if found is None else found.unionByName(rest)


def even_lengths(rows: DataFrame) -> bool:
    """Whether the lengths of the vectors differ so little that directions tell which are near."""
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    lengths = rows.agg(F.avg(norm).alias("mean"), F.stddev_pop(norm).alias("spread")).first()
    return lengths["mean"] is not None and lengths["spread"] <= EVEN_LENGTHS * lengths["mean"]


def nearest_neighbours(
    vectors: DataFrame, k: int = 10, query_filter: str = "vec_id % 100 = 0", id_col: str = "vec_id",
    vec_col: str = "embedding", tables: int = TABLES, probes: int = PROBES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest vectors found for
    each query row, by exact Euclidean distance in double precision, ties to
    the smaller id. A query's own id is no candidate.

    Rows with a null id, or a vector that is null, empty, zero, or holds a null
    or non-finite component, take no part. Only vectors of one dimension are
    compared. Rows that repeat id and vector count once; rows that share an
    id but not the vector are candidates each, and a query each under one
    ``query_id`` whose ranks run over the nearest of them. A query for which fewer than ``k`` are found
    is searched again over all buckets of one table, which are all rows: with
    fewer candidates than ``k``, all are returned. Empty in, empty out.
    """
    numbered = lambda rows: stored(rows.withColumn("uid", F.monotonically_increasing_id()), "ann-rows", FILE_ROWS)
    known = numbered(usable(vectors, id_col, vec_col))
    if not shared_hashes(known, ["vec_id", "vec"], 1).isEmpty():
        known = numbered(known.select("vec_id", "vec").distinct())
    rows = known.select("vec_id", "vec")
    asked = rows.filter(query_filter)
    if even_lengths(known):
        found = _search_rounds(known, known.filter(query_filter), k)
    else:
        found = _search(rows, asked, k, range(tables), probes)
    found = stored(found.distinct(), "ann-found")
    full = found.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).filter(F.col("n") >= k)
    short = stored(asked.join(full, asked["vec_id"] == full["query_id"], "left_anti"), "ann-short")
    if not short.isEmpty():
        found = found.unionByName(_search(rows, short, k, range(1), None)).distinct()
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int"), "vec_id", "score"
    )
