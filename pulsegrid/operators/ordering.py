"""Order of each event within its device (row number by event time).

``row_number()`` over ``Window.partitionBy(device)`` would put a device in
one task. Here, as for sessions, events are range-partitioned on
``(device, time, seq)``; each sorted partition is numbered locally per run (a
device's stretch of rows in one partition) and stored. Only the first device
of a partition can have rows in earlier ones, so at most one offset per
partition is left to add: a small broadcast left join, which drops no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.config import drop_folder, write_scratch
from pulsegrid.operators.sessions import LONG_MIN

_KEY = ["_cnull", "_conn", "deviceid"]
_ORDER = ["_t", "_s"]


def _number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    carry = None  # (key, rows so far)
    for pdf in batches:
        if pdf.empty:
            continue
        cnull = pdf["_cnull"].to_numpy(dtype=bool)
        conn = pdf["_conn"].to_numpy(dtype=np.int64)
        dev = pdf["deviceid"].to_numpy(dtype=np.int64)
        n = len(dev)
        change = np.empty(n, dtype=bool)
        change[0] = True
        change[1:] = (cnull[1:] != cnull[:-1]) | (conn[1:] != conn[:-1]) | (dev[1:] != dev[:-1])
        gid = np.cumsum(change) - 1
        starts = np.flatnonzero(change)
        idx = np.arange(n, dtype=np.int64) - starts[gid] + 1
        if carry is not None and carry[0] == (bool(cnull[0]), int(conn[0]), int(dev[0])):
            idx[gid == 0] += carry[1]
        last = starts[-1]
        carry = ((bool(cnull[last]), int(conn[last]), int(dev[last])), int(idx[-1]))
        yield pdf.assign(_part=np.int32(part), _idx=idx)


def event_order(
    events: DataFrame,
    num_partitions: int | None = None,
    seq_col: str = "seq",
    materialize_input: bool = True,
) -> DataFrame:
    """``events`` plus ``event_order`` (1-based) per ``(connectorid,
    deviceid)`` by ``(eventtime, seq)``; rows without a device or time get
    none and are left out. ``materialize_input``: store the input before the
    range exchange, so that the upstream plan runs once. Runs its scan when called."""
    seq = F.col(seq_col) if seq_col in events.columns else F.lit(None)
    keyed = events.filter(F.col("deviceid").isNotNull() & F.col("eventtime").isNotNull()).select(
        *events.columns,
        F.col("connectorid").isNull().alias("_cnull"),
        F.coalesce("connectorid", F.lit(0)).alias("_conn"),
        F.unix_micros(F.col("eventtime").cast("timestamp")).alias("_t"),
        F.coalesce(seq.cast("bigint"), F.lit(LONG_MIN)).alias("_s"),
    )
    spark = events.sparkSession
    folder = None
    if materialize_input:
        keyed, folder = write_scratch(keyed, "order-events")
    order = _KEY + _ORDER
    ranged = keyed.repartitionByRange(num_partitions, *order) if num_partitions else keyed.repartitionByRange(*order)
    out_schema = T.StructType(
        keyed.schema.fields + [T.StructField("_part", T.IntegerType()), T.StructField("_idx", T.LongType())]
    )
    numbered, _ = write_scratch(ranged.sortWithinPartitions(*order).mapInPandas(_number, out_schema), "order-scan")
    if folder:
        drop_folder(spark, folder)
    # one row per partition: its first and last device, and the number of its last row in the last device
    key, at = F.struct(*_KEY), F.struct(*_KEY, "_idx")
    edges = numbered.groupBy("_part").agg(F.min(key).alias("first"), F.max(at).alias("last")).orderBy("_part").collect()
    offsets = spark.createDataFrame(_offsets(edges), "_part int, _cnull boolean, _conn int, deviceid int, _offset long")
    joined = numbered.join(F.broadcast(offsets), ["_part", *_KEY], "left")
    return joined.select(*events.columns, (F.coalesce("_offset", F.lit(0)) + F.col("_idx")).alias("event_order"))


def _offsets(edges: list) -> list[tuple]:
    """Rows of a partition's first device in earlier partitions, where there are any."""
    out, before, device = [], 0, None
    for e in edges:
        first, last = tuple(e["first"]), tuple(e["last"])
        if first == device:
            out.append((e["_part"], *first, before))
        if last[:3] == device:
            before += last[3]  # the whole partition is this device
        else:
            device, before = last[:3], last[3]
    return out
