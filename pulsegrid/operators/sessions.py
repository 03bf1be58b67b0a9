"""Device sessions on a finished table (batch form of the state machine).

A plain ``Window.partitionBy(device).orderBy(time)`` would put every event of
a device into one task; one device may hold a large share of all events. So:

1. keep ALIVE/DEAD events and range-partition them on
   ``(connectorid, deviceid, time, seq)``: Spark samples the key range, so a
   hot device is cut into several partitions;
2. scan each sorted partition once (``mapInPandas``, vectorised numpy) and
   store what the scan returns: all sessions of devices that lie within the
   partition, and a summary (:mod:`pulsegrid.operators.session_core`) of its first and its last
   run (a device's stretch of rows in one partition), the only ones
   that a neighbouring partition can continue;
3. stitch these runs with window functions: at most two rows per partition.

Result rows: ``connectorid, deviceid, activeStartTime, activeEndTime,
deviceactive`` (``DEAD``, or ``TIMEOUT`` where a session timeout is given and
the device was silent: only closed sessions are emitted).

With a timeout each silence longer than it becomes one more closing event, ``timeout`` after
the last event before it. Times are doubled then, and closings by silence odd, so the same scan
tells them apart and sorts them behind real events of that time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.config import STATUS_ALIVE, STATUS_DEAD, STATUS_TIMEOUT, drop_folder, micros, write_scratch
from pulsegrid.functions.routing import normalized_status
from pulsegrid.operators.session_core import ALIVE, DEAD, NULL, Piece, combine, summarize

LONG_MIN = int(NULL)

SCAN_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),  # S: closed session, R: run summary
        T.StructField("cnull", T.BooleanType()),  # connector id is null
        T.StructField("conn", T.IntegerType()),
        T.StructField("deviceid", T.IntegerType()),
        T.StructField("a", T.LongType()),  # S: start; R: run's first time
        T.StructField("b", T.LongType()),  # S: end;   R: run's first seq
        T.StructField("has_dead", T.BooleanType()),
        T.StructField("head", T.LongType()),
        T.StructField("first_dead", T.LongType()),
        T.StructField("tail", T.LongType()),
    ]
)


def coded_events(events: DataFrame, seq_col: str = "seq") -> DataFrame:
    """ALIVE/DEAD events only, with ``_code`` (1/2), ``_t`` (epoch micros) and
    ``_s`` (tie-break; nulls first)."""
    st = normalized_status("status")
    code = F.when(st == STATUS_ALIVE, F.lit(ALIVE)).when(st == STATUS_DEAD, F.lit(DEAD))
    seq = F.col(seq_col) if seq_col in events.columns else F.lit(None)
    return events.filter(F.col("deviceid").isNotNull() & F.col("eventtime").isNotNull()).select(
        "connectorid",
        "deviceid",
        F.unix_micros(F.col("eventtime").cast("timestamp")).alias("_t"),
        F.coalesce(seq.cast("bigint"), F.lit(LONG_MIN)).alias("_s"),
        code.cast("int").alias("_code"),
    ).filter(F.col("_code").isNotNull())


def _frame(kind, cnull, conn, dev, a, b, has_dead, head, first_dead, tail) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "kind": kind,
            "cnull": cnull,
            "conn": np.asarray(conn, dtype=np.int32),
            "deviceid": np.asarray(dev, dtype=np.int32),
            "a": np.asarray(a, dtype=np.int64),
            "b": np.asarray(b, dtype=np.int64),
            "has_dead": has_dead,
            "head": np.asarray(head, dtype=np.int64),
            "first_dead": np.asarray(first_dead, dtype=np.int64),
            "tail": np.asarray(tail, dtype=np.int64),
        }
    )


def _run_frame(key: tuple, run_t: int, run_s: int, p: Piece) -> pd.DataFrame:
    cnull, conn, dev = key
    return _frame(["R"], [cnull], [conn], [dev], [run_t], [run_s], [p.has_dead], [p.head], [p.first_dead], [p.tail])


def _session_frame(key: tuple, start: int, end: int) -> pd.DataFrame:
    cnull, conn, dev = key
    return _frame(["S"], [cnull], [conn], [dev], [start], [end], [False], [LONG_MIN], [LONG_MIN], [LONG_MIN])


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One range-sorted partition in, sessions and two run summaries out.

    Columns in: ``cnull, conn, deviceid, _t, _s, _code``. ``carry`` is the run
    open at the end of the previous Arrow batch: the same device may continue
    in the next batch of the same partition. The first and the last run of
    the partition leave as summaries; every other run is complete, so its
    seam (first start to first end) is final.
    """
    carry = None  # (key, run_t, run_s, Piece)
    first_run = True

    def close(run) -> list[pd.DataFrame]:
        nonlocal first_run
        if first_run:
            first_run = False
            return [_run_frame(*run)]
        piece = run[3]
        return [_session_frame(run[0], piece.head, piece.first_dead)] if piece.has_dead and piece.head != LONG_MIN else []

    for pdf in batches:
        if pdf.empty:
            continue
        cnull = pdf["cnull"].to_numpy(dtype=bool)
        conn = pdf["conn"].to_numpy(dtype=np.int64)
        dev = pdf["deviceid"].to_numpy(dtype=np.int64)
        t = pdf["_t"].to_numpy(dtype=np.int64)
        s = pdf["_s"].to_numpy(dtype=np.int64)
        code = pdf["_code"].to_numpy(dtype=np.int64)
        change = np.empty(len(dev), dtype=bool)
        change[0] = True
        change[1:] = (cnull[1:] != cnull[:-1]) | (conn[1:] != conn[:-1]) | (dev[1:] != dev[:-1])
        gid = np.cumsum(change) - 1
        starts = np.flatnonzero(change)
        last_g = len(starts) - 1
        summ = summarize(gid, t, code)

        def key(row: int) -> tuple:
            return (bool(cnull[row]), int(conn[row]), int(dev[row]))

        def run(g: int) -> tuple:
            r = starts[g]
            piece = Piece(bool(summ.has_dead[g]), int(summ.head[g]), int(summ.first_dead[g]), int(summ.tail[g]))
            return (key(r), int(t[r]), int(s[r]), piece)

        def sessions(r: np.ndarray, start: np.ndarray, end: np.ndarray) -> pd.DataFrame:
            n = r.size
            none = np.full(n, LONG_MIN)
            return _frame(np.full(n, "S"), cnull[r], conn[r], dev[r], start, end, np.zeros(n, dtype=bool), none, none, none)

        out = []
        if summ.session_group.size:  # sessions closed inside a group are final
            out.append(sessions(starts[summ.session_group], summ.session_start, summ.session_end))
        head = run(0)
        if carry is not None and carry[0] == head[0]:
            merged, seam = combine(carry[3], head[3])
            if seam is not None:
                out.append(_session_frame(carry[0], seam[0], seam[1]))
            head = (carry[0], carry[1], carry[2], merged)
        elif carry is not None:
            out += close(carry)
        carry = head
        if last_g:
            out += close(head)
            mid = np.arange(1, last_g)
            mid = mid[summ.has_dead[mid] & (summ.head[mid] != LONG_MIN)]
            if mid.size:
                out.append(sessions(starts[mid], summ.head[mid], summ.first_dead[mid]))
            carry = run(last_g)
        if out:
            yield pd.concat(out, ignore_index=True)
    if carry is not None:
        yield _run_frame(*carry)


def _long(col: str):
    return F.when(F.col(col) != F.lit(LONG_MIN), F.col(col))


_DEVICE = ["cnull", "conn", "deviceid"]
_ORDER = [*_DEVICE, "_t", "_s"]


def _with_silences(ranged: DataFrame, timeout: int, until: int | None) -> DataFrame:
    """``ranged`` (sorted ranges of coded events, with their partition's number
    ``_part``) in doubled times, plus a closing event per silence longer
    than ``timeout``: between two events of a device, or from its last one on (before ``until``, if given).

    The event before the first one of a device in a partition stands in an earlier partition;
    only the greatest device of a partition goes on in later ones, so at most two rows per partition are carried.
    """
    cut = ranged.groupBy("_part").agg(F.max(F.struct(*_DEVICE)).alias("d")).select("d.*").distinct()
    pieces = ranged.join(F.broadcast(cut), _DEVICE).groupBy("_part", *_DEVICE).agg(F.max("_t").alias("_most"))
    earlier = Window.partitionBy(*_DEVICE).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.select("_part", *_DEVICE, F.max("_most").over(earlier).alias("_carried"))
    inside = Window.partitionBy("_part", *_DEVICE).orderBy("_t", "_s")
    before = ranged.withColumn("_before", F.lag("_t").over(inside)).join(F.broadcast(carried), ["_part", *_DEVICE], "left")
    before = before.withColumn("_before", F.coalesce("_before", "_carried"))
    silent = before.filter(F.col("_t") - F.col("_before") > timeout).select(*_DEVICE, "_before")
    last = ranged.groupBy(*_DEVICE).agg(F.max("_t").alias("_before"))
    if until is not None:
        last = last.filter(F.expr(f"(_before + {timeout}) div 1000") < until // 1000)
    closing = silent.unionByName(last).select(
        *_DEVICE, (2 * (F.col("_before") + timeout) + 1).alias("_t"), F.lit(LONG_MIN).alias("_s"), F.lit(DEAD).alias("_code")
    )
    return ranged.select(*_DEVICE, (2 * F.col("_t")).alias("_t"), "_s", "_code").unionByName(closing)


def _as_sessions(df: DataFrame) -> DataFrame:
    return df.select(
        "connectorid",
        "deviceid",
        F.col("start").alias("activeStartTime"),
        F.col("end").alias("activeEndTime"),
        F.lit(STATUS_DEAD).alias("deviceactive"),
    )


def device_sessions(
    events: DataFrame,
    num_partitions: int | None = None,
    seq_col: str = "seq",
    materialize_input: bool = True,
    timeout: str | None = None,
    until: int | None = None,
) -> DataFrame:
    """Closed alive-to-dead sessions of a finished event table.

    ``events``: ``connectorid, deviceid, eventtime, status[, seq]``.
    ``num_partitions``: range partitions for the scan (default: Spark's
    shuffle partition count, which adaptive execution may coalesce).
    ``materialize_input``: store the coded ALIVE/DEAD events (six narrow
    columns) before the range exchange, so that the upstream plan runs once
    rather than once for the range sample and once for the shuffle.
    ``timeout``: a device without ALIVE or DEAD for longer than this is taken as gone, its
    session ends that long after its last such event (``deviceactive = TIMEOUT``). ``until``: epoch
    microseconds up to which silence at the end of the table is known (default: without end).

    Runs its scan when called: what the scan returns is stored in the shared
    folder and read from there.
    """
    coded = coded_events(events, seq_col).select(
        F.col("connectorid").isNull().alias("cnull"),
        F.coalesce("connectorid", F.lit(0)).alias("conn"),
        "deviceid",
        "_t",
        "_s",
        "_code",
    )
    spark = events.sparkSession
    folder = None
    if timeout is not None:
        ranged = coded.repartitionByRange(*_ORDER).withColumn("_part", F.spark_partition_id())
        coded, folder = write_scratch(ranged, "session-events")
        coded = _with_silences(coded, micros(timeout), until)
    if materialize_input:
        wide = folder
        coded, folder = write_scratch(coded, "session-events")
        if wide:
            drop_folder(spark, wide)
    ranged = coded.repartitionByRange(num_partitions, *_ORDER) if num_partitions else coded.repartitionByRange(*_ORDER)
    scanned, _ = write_scratch(ranged.sortWithinPartitions(*_ORDER).mapInPandas(_scan, SCAN_SCHEMA), "session-scan")
    if folder:
        drop_folder(spark, folder)
    scanned = scanned.withColumn("connectorid", F.when(~F.col("cnull"), F.col("conn")))

    inner = scanned.filter(F.col("kind") == "S").select("connectorid", "deviceid", F.col("a").alias("start"), F.col("b").alias("end"))

    runs = scanned.filter(F.col("kind") == "R").select(
        "connectorid",
        "deviceid",
        "a",
        "b",
        "has_dead",
        _long("head").alias("head"),
        _long("first_dead").alias("first_dead"),
        _long("tail").alias("tail"),
    )
    by_device = Window.partitionBy("connectorid", "deviceid").orderBy("a", "b")
    upto = by_device.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = runs.withColumn("_blk", F.sum(F.col("has_dead").cast("int")).over(upto))
    in_block = (
        Window.partitionBy("connectorid", "deviceid", "_blk")
        .orderBy("a", "b")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    runs = runs.withColumn("_open", F.first("tail", ignorenulls=True).over(in_block))
    runs = runs.withColumn("_carry", F.lag("_open").over(by_device))
    seams = runs.filter("has_dead").select(
        "connectorid",
        "deviceid",
        F.coalesce("_carry", "head").alias("start"),
        F.col("first_dead").alias("end"),
    ).filter(F.col("start").isNotNull())
    found = inner.unionByName(seams)
    silent = F.lit(False)
    if timeout is not None:
        silent = F.pmod("end", F.lit(2)) == 1
        found = found.withColumn("start", F.shiftright("start", 1))
    end = F.shiftright("end", 1) if timeout is not None else F.col("end")
    return found.select(
        "connectorid",
        "deviceid",
        F.timestamp_micros("start").alias("activeStartTime"),
        F.timestamp_micros(end).alias("activeEndTime"),
        F.when(silent, F.lit(STATUS_TIMEOUT)).otherwise(F.lit(STATUS_DEAD)).alias("deviceactive"),
    )
