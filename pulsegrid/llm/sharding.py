"""Shards of nearly equal bytes: minimax contiguous partition.

Equal texts form one atomic group. The groups stand in the order of their
first ``doc_id``; the shards are contiguous runs of groups. The smallest
capacity for which a greedy fill needs no more than ``shards`` shards is
found by binary search, and the cuts are the greedy ones at that capacity.

A greedy fill at capacity C jumps from an offset s to the last group end not
beyond s + C, so only the sorted group ends matter. They stay in a table.
The driver holds a bounded summary: the byte axis cut into at most
``MAX_CELLS`` cells, with the least and the largest group end of each. It
bounds every jump from below and above, so one binary search on the lower
and one on the upper bound enclose the smallest capacity. Cells through which a cut can
still pass are cut finer by one aggregate over the table, until both searches agree on all
cuts: the result is exact, whatever the number of groups.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import stored, with_positions

MAX_CELLS = 16_384
SLOT_ROWS = 50_000


class Cells:
    """Sorted cells of the byte axis: least and largest group end of each."""

    def __init__(self, cells: list[tuple[int, int]]):
        self.cells = sorted(cells)
        self.least = [a for a, _ in self.cells]
        self.total = self.cells[-1][1]

    def jump(self, limit: int, start: int) -> tuple[int, int]:
        """Lower and upper bound of the last group end <= ``limit``."""
        i = bisect.bisect_right(self.least, limit) - 1
        if i < 0:
            return start, start
        a, b = self.cells[i]
        return (b, b) if limit >= b else (a, limit)

    def path(self, capacity: int, shards: int, upper: bool) -> list[int]:
        """Ends of the shards of a greedy fill (by lower or upper bounds)."""
        at, out = 0, []
        for _ in range(shards):
            at = max(at, self.jump(at + capacity, at)[upper])
            out.append(at)
            if at >= self.total:
                break
        return out

    def least_capacity(self, shards: int, upper: bool) -> int:
        lo, hi = -(-self.total // shards), self.total
        while lo < hi:
            mid = (lo + hi) // 2
            if self.path(mid, shards, upper)[-1] >= self.total:
                hi = mid
            else:
                lo = mid + 1
        return lo


def _cell_rows(ends: DataFrame, spans: list[tuple[int, int]], cells: int) -> list[tuple[int, int]]:
    """Cut each span (first, last] of the byte axis evenly, ``cells`` in all;
    least and largest group end of every cell that holds one."""
    length = sum(b - a for a, b in spans)
    number, base = None, 0
    for a, b in spans:
        n = max(2, cells * (b - a) // length)
        width = max(1, -(-(b - a) // n))
        inside = (F.col("end") > a) & (F.col("end") <= b)
        cell = F.lit(base) + F.floor((F.col("end") - F.lit(a + 1)) / F.lit(width))
        number = F.when(inside, cell) if number is None else number.when(inside, cell)
        base += n + 1
    rows = (
        ends.select(number.alias("cell"), "end")
        .filter("cell is not null")
        .groupBy("cell")
        .agg(F.min("end").alias("a"), F.max("end").alias("b"))
        .collect()  # at most `cells` rows and a few per span
    )
    return [(r["a"], r["b"]) for r in rows]


def minimax_cuts(ends: DataFrame, shards: int, max_cells: int = MAX_CELLS) -> tuple[int, list[int]]:
    """Smallest capacity and the ends of its greedy shards, for a table of
    group ends (column ``end``: sizes summed up to and with the group)."""
    total = ends.agg(F.max("end")).first()[0]
    if total is None:
        return 0, []
    cells = Cells(_cell_rows(ends, [(0, total)], max_cells))
    while True:
        low, high = cells.least_capacity(shards, True), cells.least_capacity(shards, False)
        first, last = cells.path(low, shards, False), cells.path(high, shards, True)
        if low == high and first == last:
            return low, first
        open_cells = []
        a, b = 0, 0
        for k in range(max(len(first), len(last))):
            lo, hi = a + low, b + high
            i = max(0, bisect.bisect_right(cells.least, lo) - 1)
            while i < len(cells.cells) and cells.least[i] <= hi:
                if cells.cells[i][0] < cells.cells[i][1]:
                    open_cells.append(i)
                i += 1
            a = first[min(k, len(first) - 1)]
            b = last[min(k, len(last) - 1)]
        open_cells = sorted(set(open_cells))
        spans: list[list[int]] = []
        for i in open_cells:
            least, largest = cells.cells[i]
            if spans and spans[-1][2] == i - 1:
                spans[-1][1:] = [largest, i]
            else:
                spans.append([least - 1, largest, i])
        finer = _cell_rows(ends, [(a, b) for a, b, _ in spans], max(max_cells, 4 * len(open_cells)))
        closed = set(open_cells)
        cells = Cells([c for i, c in enumerate(cells.cells) if i not in closed] + finer)


def shard_by_bytes(
    docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Put all rows of ``docs`` into shards of nearly equal bytes.

    Rows out: the id, ``size`` (UTF-8 bytes of the text plus 8), ``text_crc32``,
    ``law`` (``bytes``), ``shard`` (from 0), ``slot`` (gapless from 0 in each
    shard), ``grown_shard`` (null: this law moves rows when shards are added), ``group_first``
    (least id of the equal texts).

    A null text has no bytes and crc32 0; null texts form a group of their
    own, apart from empty ones. Rows that repeat share their group and get a
    slot each. Null ids come first. An empty table gives an empty result.
    With fewer groups than shards the last shards stay empty. Other columns
    are not read.
    """
    text = F.col(text_col).cast("string")
    rows = stored(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
            F.unhex(F.coalesce(F.sha2(text, 256), F.lit(""))).alias("key"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("key").agg(F.min("doc_id").alias("group_first"), F.sum("size").alias("group_size"))
    placed = with_positions(groups, ["group_first", "key"], "group_size", "end", "shard-groups")
    placed = stored(placed.select("key", "group_first", "end"), "shard-ends")
    _, cuts = minimax_cuts(placed.select("end"), shards)
    shard = sum([(F.col("end") > c).cast("int") for c in cuts[:-1]], F.lit(0))
    # the slot needs only a fixed order: buckets by a hash of the id keep every window small
    buckets = max(64, rows.count() // SLOT_ROWS)
    dealt = stored(
        rows.join(placed.select("key", "group_first", shard.alias("shard")), "key").select(
            "doc_id", "size", "text_crc32", "group_first", "shard",
            F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(buckets)).cast("int").alias("bucket"),
        ),
        "shard-dealt",
    )
    counts = dealt.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32")
    return dealt.withColumn("nth", F.row_number().over(inside)).join(offsets, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("offset") + F.col("nth") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "group_first",
    )
