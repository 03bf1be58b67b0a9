"""Two-level state on a stream: time slices first, devices second.

A state function gets all rows that a device has in a trigger in one group, so one busy
device is one task. Here a device's events of a trigger are dealt to tasks by (device,
time slice) first. Each slice becomes one summary row; only summaries meet in the
state function of their device, in the order of their slices. The state function takes a slot of
devices at a time (:mod:`pulsegrid.streaming.state`). What a slice settles
by itself (sessions that open and close within it) passes the state operator in ``LANES`` other
groups, which keep no state.

* :func:`device_sessions_sliced_stream`: the sessions of :mod:`pulsegrid.streaming.state`,
  and optionally a session timeout by event time.
* :func:`activity_stream`: when each device was last active, and since when it has been.

A slice must be narrow against a trigger for a busy device to spread: with one-second slices and
a trigger of a minute, over sixty tasks. Rows of a slice in different triggers are summaries
of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsegrid.config import DEDUP_WATERMARK, STATUS_DEAD, STATUS_TIMEOUT, micros
from pulsegrid.operators.session_core import NULL, summarize
from pulsegrid.operators.sessions import coded_events
from pulsegrid.streaming.state import DEVICES, SLOTS, device_keys, key_columns, read_state, slot_of, write_state

LANES = 64
SLICE = "1 second"

_KEY = [T.StructField("connectorid", T.IntegerType()), T.StructField("deviceid", T.IntegerType())]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


PIECES = T.StructType(
    [*_KEY, T.StructField("lane", T.IntegerType()), T.StructField("has_dead", T.BooleanType())]
    + _longs("first", "last", "head", "first_dead", "tail")
)
SESSIONS = T.StructType([*_KEY, *_longs("start", "end"), T.StructField("silent", T.BooleanType())])
SESSION_STATE = T.StructType([*DEVICES, *(T.StructField(n, T.ArrayType(T.LongType())) for n in ("open_since", "last_seen"))])
ACTIVITY = T.StructType([*_KEY, *_longs("last_active", "active_since")])
ACTIVITY_STATE = T.StructType([*DEVICES, *(T.StructField(n, T.ArrayType(T.LongType())) for n in ("last_active", "active_since"))])


# --- level 1: slices ---------------------------------------------------------------


def _grouped(batches: Iterator[pd.DataFrame], width: int) -> tuple[pd.DataFrame, np.ndarray] | None:
    """A task's events sorted by device and time, and the number of the slice group of each."""
    frames = [p for p in batches if len(p)]
    if not frames:
        return None
    rows = pd.concat(frames, ignore_index=True)
    conn = rows["connectorid"]
    rows["cnull"], rows["conn"] = conn.isna().to_numpy(bool), conn.fillna(0).to_numpy(np.int64)
    rows["slice"] = rows["_t"].to_numpy(np.int64) // width
    columns = [rows[c].to_numpy() for c in ("cnull", "conn", "deviceid", "slice")]
    order = np.lexsort((rows["_s"].to_numpy(), rows["_t"].to_numpy(), *columns[::-1]))
    rows = rows.iloc[order].reset_index(drop=True)
    new = np.zeros(len(rows), bool)
    new[0] = True
    for c in columns:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return rows, np.cumsum(new) - 1


def _key_frame(rows: pd.DataFrame, at: np.ndarray) -> dict:
    conn = pd.array(rows["conn"].to_numpy()[at].astype(np.int32), dtype="Int32")
    conn[rows["cnull"].to_numpy()[at]] = pd.NA
    return {"connectorid": conn, "deviceid": rows["deviceid"].to_numpy()[at].astype(np.int32)}


def _summarize(batches: Iterator[pd.DataFrame], width: int, lanes: int) -> Iterator[pd.DataFrame]:
    """Lane 0: a summary per device and slice. Other lanes: sessions within a slice, as head and first dead."""
    found = _grouped(batches, width)
    if found is None:
        return
    rows, gid = found
    t = rows["_t"].to_numpy(np.int64)
    s = summarize(gid, t, rows["_code"].to_numpy(np.int64))
    starts = np.flatnonzero(np.diff(gid, prepend=-1))
    ends = np.append(starts[1:], len(t)) - 1
    yield pd.DataFrame(
        {
            **_key_frame(rows, starts), "lane": np.zeros(len(starts), np.int32), "has_dead": s.has_dead,
            "first": t[starts], "last": t[ends], "head": s.head, "first_dead": s.first_dead, "tail": s.tail,
        }
    )
    if len(s.session_group):
        at = starts[s.session_group]
        yield pd.DataFrame(
            {
                **_key_frame(rows, at), "lane": (1 + rows["slice"].to_numpy()[at] % lanes).astype(np.int32),
                "has_dead": np.ones(len(at), bool), "first": t[at], "last": t[ends[s.session_group]],
                "head": s.session_start, "first_dead": s.session_end, "tail": np.full(len(at), NULL),
            }
        )


def _spans(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """First and last time per device and slice."""
    found = _grouped(batches, width)
    if found is None:
        return
    rows, gid = found
    t = rows["_t"].to_numpy(np.int64)
    starts = np.flatnonzero(np.diff(gid, prepend=-1))
    ends = np.append(starts[1:], len(t)) - 1
    none = np.full(len(starts), NULL)
    yield pd.DataFrame(
        {
            **_key_frame(rows, starts), "lane": np.zeros(len(starts), np.int32), "has_dead": np.zeros(len(starts), bool),
            "first": t[starts], "last": t[ends], "head": none, "first_dead": none, "tail": none,
        }
    )


def sliced(coded: DataFrame, width: int, make: Callable) -> DataFrame:
    """``coded`` events dealt by device and slice of ``width`` microseconds, turned into rows of ``PIECES`` by ``make``."""
    begin = F.col("_t") - F.pmod("_t", F.lit(width))
    return coded.repartition("connectorid", "deviceid", begin).mapInPandas(make, PIECES)


def slice_summaries(coded: DataFrame, slice_width: str = SLICE, lanes: int = LANES) -> DataFrame:
    width = micros(slice_width)
    return sliced(coded, width, lambda batches: _summarize(batches, width, lanes))


# --- level 2: devices ----------------------------------------------------------------


def fold_pieces(
    open_since: int, last_seen: int, pieces: list[tuple], timeout: int | None
) -> tuple[list[tuple[int, int, bool]], int, int]:
    """Summaries ``(first, last, has_dead, head, first_dead, tail)`` in order, after a device's state:
    the sessions that end (start, end, by silence?) and the new state."""
    sessions, start, seen = [], open_since, last_seen
    for first, last, has_dead, head, first_dead, tail in pieces:
        if timeout is not None and start != NULL and first - seen > timeout:
            sessions.append((start, seen + timeout, True))
            start = NULL
        if start == NULL:
            start = head
        if has_dead:
            if start != NULL:
                sessions.append((start, first_dead, False))
            start = tail
        seen = max(seen, last)
    return sessions, start, seen


def _by_device(frames: Iterator[pd.DataFrame], columns: list[str]) -> dict[tuple, list[tuple]]:
    """A slot's rows, sorted, by device."""
    found: dict[tuple, list[tuple]] = {}
    for p in frames:
        for device, row in zip(device_keys(p), zip(*(p[c].tolist() for c in columns))):
            found.setdefault(device, []).append(row)
    return {device: sorted(rows) for device, rows in found.items()}


def _session_frame(owners: list[tuple], sessions: list[tuple[int, int, bool]]) -> pd.DataFrame:
    return pd.DataFrame(
        {
            **key_columns(owners),
            "start": np.array([s[0] for s in sessions], np.int64), "end": np.array([s[1] for s in sessions], np.int64),
            "silent": np.array([s[2] for s in sessions], bool),
        }
    )


def _session_update(timeout: int | None) -> Callable:
    columns = ["first", "last", "has_dead", "head", "first_dead", "tail"]

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if key[0] >= SLOTS:  # a lane of settled sessions
            for p in frames:
                yield _session_frame(device_keys(p), [(a, b, False) for a, b in zip(p["head"].tolist(), p["first_dead"].tolist())])
            return
        pieces = _by_device(frames, columns)
        if not pieces and not state.hasTimedOut:
            return
        kept, owners, sessions = read_state(state), [], []
        for device, own in pieces.items():
            closed, opened, seen = fold_pieces(*kept.pop(device, (int(NULL), int(NULL))), own, timeout)
            owners += [device] * len(closed)
            sessions += closed
            if opened != NULL:
                kept[device] = (int(opened), int(seen))
        if timeout is not None:
            passed = state.getCurrentWatermarkMs()
            for device, (opened, seen) in list(kept.items()):
                if (seen + timeout) // 1000 < passed:
                    owners.append(device)
                    sessions.append((opened, seen + timeout, True))
                    del kept[device]
        write_state(state, kept)
        if kept and timeout is not None:
            state.setTimeoutTimestamp((min(seen for _, seen in kept.values()) + timeout) // 1000)
        if sessions:
            yield _session_frame(owners, sessions)

    return update


def device_sessions_sliced_stream(
    events: DataFrame,
    seq_col: str = "seq",
    slice_width: str = SLICE,
    timeout: str | None = None,
    watermark: str = DEDUP_WATERMARK,
    lanes: int = LANES,
) -> DataFrame:
    """Streaming sessions (update mode), rows as of
    :func:`pulsegrid.streaming.state.device_sessions_stream`, whatever share of a trigger one device has.

    Without ``timeout`` an open session stays in state until a DEAD. With it, a device that sends
    neither ALIVE nor DEAD for longer is taken as gone: its session ends ``timeout``
    after its last such event with ``deviceactive = TIMEOUT``, and its state goes, when a later event of the
    device or the watermark (``watermark`` behind the latest event of any device) shows it. Which
    of the two shows it changes no result. Events later than the watermark are then dropped.
    ``timeout`` must be no shorter than a slice.
    """
    pieces = slice_summaries(coded_events(events, seq_col), slice_width, lanes)
    limit = None if timeout is None else micros(timeout)
    if limit is not None:
        if limit < micros(slice_width):
            raise ValueError("a session timeout must be no shorter than a slice")
        pieces = pieces.withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", watermark)
    slot = F.when(F.col("lane") == 0, slot_of("connectorid", "deviceid")).otherwise(F.lit(SLOTS - 1) + F.col("lane"))
    out = pieces.withColumn("slot", slot.cast("int")).groupBy("slot").applyInPandasWithState(
        _session_update(limit), SESSIONS, SESSION_STATE, "Update",
        GroupStateTimeout.NoTimeout if limit is None else GroupStateTimeout.EventTimeTimeout,
    )
    return out.select(
        "connectorid",
        "deviceid",
        F.timestamp_micros("start").alias("activeStartTime"),
        F.timestamp_micros("end").alias("activeEndTime"),
        F.when(F.col("silent"), F.lit(STATUS_TIMEOUT)).otherwise(F.lit(STATUS_DEAD)).alias("deviceactive"),
    )


def fold_activity(last: int, since: int, spans: list[tuple[int, int]], idle: int) -> tuple[int, int]:
    """State ``(last active, active since)`` after sorted spans: a span begins
    anew where the device has been silent for more than ``idle``. A span that comes late counts
    if it touches the present stretch."""
    for first, upto in spans:
        if last == NULL or first - last > idle:
            last, since = upto, first
        elif since - upto <= idle:
            last, since = max(last, upto), min(since, first)
    return last, since


def _activity_update(idle: int) -> Callable:
    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        spans = _by_device(frames, ["first", "last"])
        if not spans and not state.hasTimedOut:
            return
        kept, changed = read_state(state), {}
        for device, own in spans.items():
            before = kept.get(device, (int(NULL), int(NULL)))
            last, since = fold_activity(*before, own, idle)
            kept[device] = (int(last), int(since))
            if kept[device] != before:
                changed[device] = kept[device]
        passed = state.getCurrentWatermarkMs()
        kept = {device: times for device, times in kept.items() if (times[0] + idle) // 1000 >= passed}
        write_state(state, kept)
        if kept:
            state.setTimeoutTimestamp((min(last for last, _ in kept.values()) + idle) // 1000)
        if changed:
            yield pd.DataFrame(
                {
                    **key_columns(list(changed)),
                    "last_active": np.array([last for last, _ in changed.values()], np.int64),
                    "active_since": np.array([since for _, since in changed.values()], np.int64),
                }
            )

    return update


def activity_stream(
    events: DataFrame, idle: str = "1 day", slice_width: str = "1 minute", watermark: str = DEDUP_WATERMARK
) -> DataFrame:
    """Per device, whenever it changes (update mode): ``connectorid, deviceid, lastactivetime, activetime``, the
    time of its latest event of any status, and the first event since it was last silent for more than
    ``idle``. State of a device that the watermark shows to be idle is evicted; its last row stands.
    Rows without device or time are left out. ``idle`` must be no shorter than a slice."""
    width, limit = micros(slice_width), micros(idle)
    if limit < width:
        raise ValueError("idle must be no shorter than a slice")
    rows = events.filter(F.col("deviceid").isNotNull() & F.col("eventtime").isNotNull()).select(
        "connectorid", "deviceid", F.unix_micros(F.col("eventtime").cast("timestamp")).alias("_t"), F.lit(0).cast("long").alias("_s")
    )
    spans = sliced(rows, width, lambda batches: _spans(batches, width))
    spans = spans.withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", watermark)
    out = spans.withColumn("slot", slot_of("connectorid", "deviceid")).groupBy("slot").applyInPandasWithState(
        _activity_update(limit), ACTIVITY, ACTIVITY_STATE, "Update", GroupStateTimeout.EventTimeTimeout
    )
    return out.select(
        "connectorid", "deviceid", F.timestamp_micros("last_active").alias("lastactivetime"),
        F.timestamp_micros("active_since").alias("activetime"),
    )
