"""Trie of conversation prefixes, screened by a count-min sketch.

Every distinct sequence of a conversation's first ``d`` turns is a node.

1. Each turn becomes 128 bits that depend on its depth, role and text; a
   prefix's digest is their running XOR, so it is summed like any aggregate. Conversations are
   cut by ranges of (conversation, depth): a conversation of any length spreads over
   tasks, and only values carried over the cuts (one row per cut) are broadcast.
2. A count-min sketch counts all prefix digests (counters saturate at two, so
   a row of it is two bitmaps). Its estimate is never too low: an estimate of
   one proves that a prefix, and with it everything below, belongs to one conversation.
   Such tails are turned into nodes where they stand.
3. Only possibly shared prefixes are grouped by digest, exactly. A collision in the sketch costs a row
   there, never a result.
4. Sums over subtrees need no walk: a node's value is handed to the least conversation of the node,
   summed there from its end upwards, and then summed over the members of each node.

The width of the sketch grows with the number of prefixes up to ``MOST_CELLS`` (16 MB for
both rows), beyond which it screens less, and more prefixes are grouped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import lean, mix64, stored
from pulsegrid.llm.packed import pack, unpack

SKETCH_ROWS = 2
LEAST_CELLS, MOST_CELLS = 1 << 16, 1 << 26
CHUNK = 1 << 16  # cells of the sketch that travel together
HOT_PARENTS = 1_000  # a parent of more than this share of all children is joined by broadcast

KEY = ["depth", "d1", "d2"]
SKETCH = "chunk int, once binary, twice binary"
NODE_COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
]


# --- running values along conversations -------------------------------------------


def running(df: DataFrame, key: str, order: list[str], values: dict[str, str], label: str) -> DataFrame:
    """``df`` plus, per name of ``values``, the running sum or XOR of the
    column of that name up to and with a row, within equal ``key``, in the
    order of the columns ``order``. ``values``: name to ``sum`` or ``xor``.

    Rows are range-partitioned by key and order and stored with their partition's number, so a
    key of any size is cut. Only the greatest key of a partition goes on in the
    next one: what earlier partitions hold of such keys is carried, at most
    two rows per partition, by a broadcast.
    """
    fold = {"sum": F.sum, "xor": F.bit_xor}
    ranged = stored(df.repartitionByRange(key, *order).withColumn("_part", F.spark_partition_id()), label)
    cut = ranged.groupBy("_part").agg(F.max(key).alias(key)).select(key).distinct()
    pieces = ranged.join(F.broadcast(cut), key).groupBy("_part", key).agg(
        *(fold[how](name).alias(f"_{name}") for name, how in values.items())
    )
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select("_part", key, *(fold[how](f"_{name}").over(before).alias(f"_{name}") for name, how in values.items()))
    inside = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    kept = [c for c in ranged.columns if c not in values and c != "_part"]
    local = ranged.select("_part", *kept, *(fold[how](name).over(inside).alias(name) for name, how in values.items()))

    def total(name: str, how: str) -> Column:
        rest = F.coalesce(F.col(f"_{name}"), F.lit(0))
        return (F.col(name) + rest if how == "sum" else F.col(name).bitwiseXOR(rest)).alias(name)

    return local.join(F.broadcast(carried), ["_part", key], "left").select(
        *kept, *(total(name, how) for name, how in values.items())
    )


# --- turns ----------------------------------------------------------------------------


def numbered_turns(conversations: DataFrame, label: str = "trie-turns") -> DataFrame:
    """``conv_id, nth, turn_digest, n_bytes``: turns numbered from 1 within
    their conversation, by ``turn`` (null first), ties by digest. Null role or
    text is empty. Rows without a conversation id belong to none and are left out. The texts go no further than this map."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn_digest"),
        F.octet_length(text).cast("long").alias("n_bytes"), F.lit(1).cast("long").alias("nth"),
    )
    return running(turns, "conv_id", ["turn", "turn_digest"], {"nth": "sum"}, label)


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (``conv_id, depth, turn_digest, n_bytes``) and conversations
    (``conv_id, n_turns``), every conversation ``c`` rebuilt: the first ``h``
    turns of conversation ``c - c % 5`` (all if it has fewer, none if it does
    not exist), then its own after its first ``h``; ``h`` is the crc32 of the id as text modulo 9."""
    turns = stored(numbered_turns(conversations), "trie-numbered")
    ids = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    h = F.crc32(F.col("conv_id").cast("string")) % 9
    ids = ids.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    bases = ids.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    ids = ids.join(bases, "base", "left").withColumn("head", F.least("h", F.coalesce("base_turns", F.lit(0))))
    ids = ids.withColumn("n_turns", F.col("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    ids = stored(ids.select("conv_id", "base", "h", "head", "n_turns"), "trie-conversations")
    heads = turns.filter("nth <= 8").withColumnRenamed("conv_id", "base").join(ids, "base").filter("nth <= h")
    tails = turns.join(ids, "conv_id").filter("nth > h")
    out = [
        rows.select("conv_id", depth.cast("long").alias("depth"), "turn_digest", "n_bytes")
        for rows, depth in ((heads, F.col("nth")), (tails, F.expr("head + nth - h")))
    ]
    return out[0].unionByName(out[1]), ids.select("conv_id", "n_turns")


def prefixes_of(turns: DataFrame, members: DataFrame) -> DataFrame:
    """One row per conversation and depth from 1: digest of the prefix (``d1,
    d2``), of its parent (``p1, p2``), bytes of its last text, ``n_turns`` of its conversation."""
    rows = turns.join(members, "conv_id").select(
        "conv_id", "depth", "n_turns", "n_bytes",
        F.xxhash64("depth", "turn_digest").alias("d1"), F.xxhash64(F.lit("second"), "turn_digest", "depth").alias("d2"),
    ).withColumns({"t1": F.col("d1"), "t2": F.col("d2")})
    out = running(rows, "conv_id", ["depth"], {"d1": "xor", "d2": "xor"}, "trie-rebuilt")
    return out.select(
        "conv_id", *KEY, F.col("d1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("d2").bitwiseXOR(F.col("t2")).alias("p2"),
        "n_bytes", "n_turns",
    )


# --- the sketch --------------------------------------------------------------------------


def cells_of(d1: np.ndarray, d2: np.ndarray, cells: int) -> list[np.ndarray]:
    """The cell of each digest in every row of the sketch (rows one after another)."""
    a, b = d1.astype(np.int64).view(np.uint64), d2.astype(np.int64).view(np.uint64)
    mask = np.uint64(cells - 1)
    return [(mix64(a + np.uint64(r) * b + np.uint64(r)) & mask).astype(np.int64) + r * cells for r in range(SKETCH_ROWS)]


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


def _count_cells(batches, cells: int) -> Iterator[pa.RecordBatch]:
    """A task's counts, saturated at two, as two bitmaps per chunk of cells."""
    counts = np.zeros(SKETCH_ROWS * cells, np.uint8)
    for batch in batches:
        for place in cells_of(_numbers(batch.column(0)), _numbers(batch.column(1)), cells):
            at, n = np.unique(place, return_counts=True)
            counts[at] = np.minimum(counts[at] + np.minimum(n, 2), 2)
    chunks = counts.reshape(-1, CHUNK)
    for chunk in np.flatnonzero(chunks.any(axis=1)).tolist():
        once, twice = (pack(np.packbits(chunks[chunk] >= k)) for k in (1, 2))
        yield pa.RecordBatch.from_pydict(
            {"chunk": pa.array([chunk], pa.int32()), "once": pa.array([once], pa.binary()), "twice": pa.array([twice], pa.binary())}
        )


def _merge_chunks(batches) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by number; the counts of all tasks added, one chunk in memory at a time."""
    chunk, once, twice = None, None, None

    def close():
        return pa.RecordBatch.from_pydict(
            {
                "chunk": pa.array([chunk], pa.int32()), "once": pa.array([pack(once)], pa.binary()),
                "twice": pa.array([pack(twice)], pa.binary()),
            }
        )

    for batch in batches:
        for row in batch.to_pylist():
            a, b = unpack(row["once"], np.uint8), unpack(row["twice"], np.uint8)
            if row["chunk"] == chunk:
                once, twice = once | a, twice | b | (once & a)
            else:
                if chunk is not None:
                    yield close()
                chunk, once, twice = row["chunk"], a, b
    if chunk is not None:
        yield close()


def count_min(prefixes: DataFrame, cells: int) -> np.ndarray:
    """Bitmaps of the cells that count two or more: ``SKETCH_ROWS * cells`` bits."""
    counted = prefixes.select("d1", "d2").mapInArrow(lean(lambda b: _count_cells(b, cells)), SKETCH)
    merged = counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(lean(_merge_chunks), SKETCH)
    bits = np.zeros(SKETCH_ROWS * cells // 8, np.uint8)
    for row in merged.select("chunk", "twice").toLocalIterator():  # as many rows as the sketch has chunks
        bits[row["chunk"] * CHUNK // 8 : (row["chunk"] + 1) * CHUNK // 8] = unpack(row["twice"], np.uint8)
    return bits


def _screen(batches, sketch, cells: int) -> Iterator[pa.RecordBatch]:
    """Adds ``tail`` (proven to belong to one conversation) and ``top`` (the
    first such prefix of it seen here). Rows of a conversation stand together, in
    order; where a cut between tasks hides the start of a tail, its rows count as
    possibly shared unless proven again."""
    bits = sketch.value
    conv, depth, was = None, 0, False
    for batch in batches:
        if not batch.num_rows:
            continue
        single = np.zeros(batch.num_rows, bool)
        for place in cells_of(_numbers(batch.column("d1")), _numbers(batch.column("d2")), cells):
            single |= ((bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1) == 0
        convs, depths = _numbers(batch.column("conv_id")), _numbers(batch.column("depth"))
        new = np.ones(len(convs), bool)
        new[1:] = (convs[1:] != convs[:-1]) | (depths[1:] != depths[:-1] + 1)
        new[0] = not (convs[0] == conv and depths[0] == depth + 1)
        if not new[0] and was:
            single[0] = True  # goes on with a tail
        first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        seen = np.cumsum(single)
        tail = seen - seen[first] + single[first] > 0
        top = tail.copy()
        top[1:] &= new[1:] | ~tail[:-1]
        top[0] &= bool(new[0]) or not was
        conv, depth, was = convs[-1], depths[-1], bool(tail[-1])
        out = batch.append_column("tail", pa.array(tail)).append_column("top", pa.array(top))
        yield out


# --- conversations that end at a node ---------------------------------------------------------


def _pieces(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node and conversation: the ids of a node in a batch as one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [_numbers(batch.column(c)) for c in range(3)]
        new = np.ones(batch.num_rows, bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        at = np.flatnonzero(new)
        ids = batch.column(3).to_pylist()
        ends = np.append(at[1:], batch.num_rows).tolist()
        yield pa.RecordBatch.from_pydict(
            {
                **{name: pa.array(c[at]) for name, c in zip(KEY, columns)},
                "first": pa.array([ids[a] for a in at.tolist()], pa.int64()),
                "ids": pa.array([",".join(map(str, ids[a:b])).encode() for a, b in zip(at.tolist(), ends)], pa.binary()),
            }
        )


def _hash_ends(batches) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by node and first id: the hash of each node's ids, fed piece by piece."""
    node, state = None, None

    def row():
        return {**dict(zip(KEY, node)), "ends_sha256": state.hexdigest()}

    for batch in batches:
        out = []
        for piece in batch.to_pylist():
            own = tuple(piece[c] for c in KEY)
            if own != node:
                if node is not None:
                    out.append(row())
                node, state = own, hashlib.sha256(piece["ids"])
            else:
                state.update(b"," + piece["ids"])
        if out:
            yield pa.RecordBatch.from_pylist(out, END_SCHEMA)
    if node is not None:
        yield pa.RecordBatch.from_pylist([row()], END_SCHEMA)


END_SCHEMA = pa.schema([("depth", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("ends_sha256", pa.string())])


def ends_of(rows: DataFrame) -> DataFrame:
    """``depth, d1, d2, ends_sha256`` of all nodes in ``rows`` (with ``conv_id``).

    Ranges of (node, id) are turned into texts by many tasks; what meets in
    one task per node are a few long pieces, fed to one hash one by one. A hash
    of ordered ids can't be made in parts, but nothing is gathered in memory.
    """
    ranged = rows.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = ranged.mapInArrow(lean(_pieces), "depth long, d1 long, d2 long, first long, ids binary")
    dealt = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return dealt.mapInArrow(lean(_hash_ends), "depth long, d1 long, d2 long, ends_sha256 string")


# --- operator ----------------------------------------------------------------------------------


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _parents(asks: DataFrame, nodes: DataFrame, n_asks: int) -> DataFrame:
    """``asks`` plus ``parent_conv_id``: the least conversation of the node
    (depth - 1, p1, p2), or the own one where that node is part of a tail. Parents of
    more than a ``HOT_PARENTS``-th of all children, at most so many, are joined by broadcast, so no task gets their children."""
    known = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"), "n_children",
    )
    hot = F.broadcast(known.filter(F.col("n_children") * HOT_PARENTS > n_asks).drop("n_children"))
    cold = known.filter(F.col("n_children") * HOT_PARENTS <= n_asks).drop("n_children")
    on = ["depth", "p1", "p2"]
    rest = asks.join(hot, on, "left_anti").join(cold, on, "left")
    rest = rest.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "conv_id"))
    return asks.join(hot, on).unionByName(rest)


def prefix_trie(turns: DataFrame, members: DataFrame) -> DataFrame:
    """All nodes of the trie of conversations: ``conv_id`` (the node's smallest
    member), ``depth, parent_conv_id`` (null at the root), ``n_convs`` (members), ``n_children,
    n_leaves`` (childless nodes of the subtree, itself included), ``saved_tokens`` (over the subtree, members
    but one times the bytes of the node's last text), ``ends_sha256`` (of the ids, ascending and
    comma-joined, of members that end here).

    ``turns``: ``conv_id, depth`` (1, 2, ... without gaps within a conversation), ``turn_digest, n_bytes``;
    ``members``: every ``conv_id`` once, with its ``n_turns`` (0: a member
    of the root only). Without members there is no node, not even a root.
    """
    spark = turns.sparkSession
    members = members.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"))
    prefixes = stored(prefixes_of(turns, members), "trie-prefixes")
    cells = LEAST_CELLS
    n = prefixes.count()
    while cells < min(8 * n, MOST_CELLS):
        cells *= 2
    sketch = spark.sparkContext.broadcast(count_min(prefixes, cells))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in prefixes.schema) + ", tail boolean, top boolean"
    placed = stored(prefixes.mapInArrow(lean(lambda b: _screen(b, sketch, cells)), schema), "trie-screened")
    zero = F.lit(0).cast("long")
    root = members.select("conv_id", *(zero.alias(c) for c in (*KEY, "p1", "p2", "n_bytes")), "n_turns")
    shared = placed.filter("not tail").drop("tail", "top").unionByName(root)
    tails = placed.filter("tail")

    ends = F.col("n_turns") == F.col("depth")
    nodes = stored(
        shared.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.count_if(ends).alias("n_ends"),
            F.max("n_bytes").alias("n_bytes"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        ),
        "trie-groups",
    )
    asks = stored(
        nodes.filter("depth > 0").select("conv_id", *KEY, "p1", "p2", F.lit(False).alias("top")).unionByName(
            tails.filter("top").select("conv_id", *KEY, "p1", "p2", "top")
        ),
        "trie-children",
    )
    children = asks.groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))

    # what a node hands to its least conversation: its own savings, and one leaf where it has no children
    given = nodes.filter("n_convs > 1 or n_ends = n_convs").select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
        (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"),
    )
    own = shared.select("conv_id", *KEY).join(given, ["conv_id", "depth"], "left")
    single = tails.filter(ends).select(
        "conv_id", *KEY, zero.alias("saved"), F.lit(1).cast("long").alias("leaves"), F.lit(True).alias("tail")
    )
    upwards = own.withColumn("tail", F.lit(False)).unionByName(single).select(
        "conv_id", *KEY, "tail", F.coalesce("saved", F.lit(0)).alias("saved"), F.coalesce("leaves", F.lit(0)).alias("leaves"),
        (-F.col("depth")).alias("upwards"),
    )
    upwards = running(upwards, "conv_id", ["upwards"], {"saved": "sum", "leaves": "sum"}, "trie-upwards")
    sums = upwards.filter("not tail").groupBy(*KEY).agg(
        F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves")
    )
    ended = ends_of(shared.filter(ends))
    nodes = stored(nodes.join(sums, KEY).join(ended, KEY, "left"), "trie-nodes")

    linked = _parents(asks, nodes.select(*KEY, "conv_id", "n_children"), asks.count())
    parents = linked.filter("not top").select(*KEY, "parent_conv_id")
    grouped = nodes.join(parents, KEY, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", _sha(F.lit(""))))
    local = tails.filter("not top").select("conv_id", *KEY, F.col("conv_id").alias("parent_conv_id"), "n_turns")
    tops = tails.filter("top").select("conv_id", "depth", "n_turns").join(
        linked.filter("top").select("conv_id", *KEY, "parent_conv_id"), ["conv_id", "depth"]
    )
    one = F.lit(1).cast("long")
    local = local.unionByName(tops).select(
        "conv_id", "depth", "parent_conv_id", one.alias("n_convs"), F.when(ends, 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(ends, _sha(F.col("conv_id").cast("string"))).otherwise(_sha(F.lit(""))).alias("ends_sha256"),
    )
    return grouped.select(*NODE_COLUMNS).unionByName(local.select(*NODE_COLUMNS))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all rebuilt conversations (:func:`rebuilt_turns`).

    Turns stand by ``turn``, null first; turns of equal number by a digest of
    role and text, so that reruns agree; a repeated row is a turn of its own. Null role
    or text is empty; rows without a conversation id are left out. Texts of any
    length are hashed where they are read. An empty table gives no node.
    """
    return prefix_trie(*rebuilt_turns(conversations))
