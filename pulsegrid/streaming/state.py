"""Device sessions on a stream: per-device state across micro-batches.

``groupBy(slot).applyInPandasWithState`` in update mode, no timeout. A slot is
one of ``SLOTS`` parts of all devices, by a hash: a group costs Python far more
than a device in it, so a trigger's cost grows with its events and not with its
devices. Per device and micro-batch the events are sorted by
``(eventtime, seq)`` and folded with the summary rule of
:mod:`pulsegrid.operators.session_core`; a device's state is the start of the
open session (the summary's ``tail``), removed after a DEAD; a slot keeps those
of its devices that are open. A device's work per
trigger is bounded by the trigger size (``maxOffsetsPerTrigger`` /
``maxFilesPerTrigger``), not by its history.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pulsegrid.config import STATUS_DEAD
from pulsegrid.operators.session_core import ALIVE, NULL, summarize
from pulsegrid.operators.sessions import coded_events

OUT_SCHEMA = T.StructType(
    [
        T.StructField("connectorid", T.IntegerType()),
        T.StructField("deviceid", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
# a slot's devices, one at a place
DEVICES = [T.StructField("connectorid", T.ArrayType(T.IntegerType())), T.StructField("deviceid", T.ArrayType(T.IntegerType()))]
STATE_SCHEMA = T.StructType([*DEVICES, T.StructField("open_since", T.ArrayType(T.LongType()))])
SLOTS = 1024  # fixed by a query's checkpoint


SMALL = 64  # up to so many events a plain loop beats array calls


def fold_small(open_since: int, rows: list[tuple[int, int, int]]) -> tuple[list[tuple[int, int]], int]:
    """:func:`fold_batch` for a few (time, seq, code) rows."""
    sessions, start = [], open_since
    for t, _, code in sorted(rows):
        if code == ALIVE:
            if start == NULL:
                start = t
        elif start != NULL:
            sessions.append((int(start), t))
            start = NULL
    return sessions, int(start)


def fold_batch(open_since: int, t: np.ndarray, s: np.ndarray, code: np.ndarray) -> tuple[list[tuple[int, int]], int]:
    """One device's events of one micro-batch: returns closed sessions and the
    new open start (``NULL`` when none)."""
    order = np.lexsort((s, t))
    t, code = t[order], code[order]
    summ = summarize(np.zeros(len(t), dtype=np.int64), t, code)
    sessions = []
    if summ.has_dead[0]:
        start = open_since if open_since != NULL else int(summ.head[0])
        if start != NULL:
            sessions.append((start, int(summ.first_dead[0])))
        new_open = int(summ.tail[0])
    else:
        new_open = open_since if open_since != NULL else int(summ.head[0])
    sessions.extend(zip(summ.session_start.tolist(), summ.session_end.tolist()))
    return sessions, new_open


def slot_of(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SLOTS)).cast("int")


def device_keys(rows: pd.DataFrame) -> list[tuple[int | None, int]]:
    """(connector or None, device) of each row."""
    conn = [None if c is None or c is pd.NA or c != c else int(c) for c in rows["connectorid"].tolist()]
    return list(zip(conn, rows["deviceid"].tolist()))


def read_state(state: GroupState) -> dict[tuple, tuple]:
    """A slot's state: values by device."""
    return {key[:2]: key[2:] for key in zip(*state.get)} if state.exists else {}


def write_state(state: GroupState, kept: dict[tuple, tuple]) -> None:
    if kept:
        state.update(tuple(list(column) for column in zip(*(key + values for key, values in kept.items()))))
    elif state.exists:
        state.remove()


def key_columns(keys: list[tuple]) -> dict:
    return {
        "connectorid": pd.array([k[0] for k in keys], dtype="Int32"), "deviceid": pd.array([k[1] for k in keys], dtype="Int32")
    }


def _update(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return
    rows = pd.concat(frames, ignore_index=True)
    t, s, code = (rows[c].to_numpy(dtype=np.int64) for c in ("_t", "_s", "_code"))
    keys = device_keys(rows)
    numbers: dict[tuple, int] = {}
    own = np.array([numbers.setdefault(k, len(numbers)) for k in keys])
    order = np.argsort(own, kind="stable")
    ends = np.cumsum(np.bincount(own))
    kept, owners, sessions = read_state(state), [], []
    for device, begin, end in zip(numbers, [0, *ends[:-1]], ends):
        at = order[begin:end]
        before = kept.pop(device, (int(NULL),))[0]
        if len(at) <= SMALL:
            closed, new_open = fold_small(before, list(zip(t[at].tolist(), s[at].tolist(), code[at].tolist())))
        else:
            closed, new_open = fold_batch(before, t[at], s[at], code[at])
        if new_open != NULL:
            kept[device] = (int(new_open),)
        owners += [device] * len(closed)
        sessions += closed
    write_state(state, kept)
    if sessions:
        yield pd.DataFrame(
            {
                **key_columns(owners),
                "start": np.array([a for a, _ in sessions], dtype=np.int64),
                "end": np.array([b for _, b in sessions], dtype=np.int64),
            }
        )


def device_sessions_stream(events: DataFrame, seq_col: str = "seq") -> DataFrame:
    """Streaming sessions (update mode): ``connectorid, deviceid,
    activeStartTime, activeEndTime, deviceactive``. A device that never sends
    DEAD keeps its open session in state for good (as in the reference)."""
    coded = coded_events(events, seq_col)
    out = coded.withColumn("slot", slot_of("connectorid", "deviceid")).groupBy("slot").applyInPandasWithState(
        _update, OUT_SCHEMA, STATE_SCHEMA, "Update", GroupStateTimeout.NoTimeout
    )
    return out.select(
        "connectorid",
        "deviceid",
        F.timestamp_micros("start").alias("activeStartTime"),
        F.timestamp_micros("end").alias("activeEndTime"),
        F.lit(STATUS_DEAD).alias("deviceactive"),
    )
