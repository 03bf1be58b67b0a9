import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.operators.session_core import ALIVE, DEAD, NULL, Piece, combine, summarize
from pulsegrid.operators.sessions import device_sessions
from tests.helpers import device_sessions_by_window
from pulsegrid.schemas import EVENT
from pulsegrid.streaming.state import fold_batch

BASE = dt.datetime(2018, 7, 20, 13, 0)
CODE = {"A": ALIVE, "D": DEAD}


def reference_fold(seq):
    """Plain per-event state machine (codes 0 = other status)."""
    out, open_since = [], None
    for t, code in seq:
        if code == ALIVE and open_since is None:
            open_since = t
        elif code == DEAD and open_since is not None:
            out.append((open_since, t))
            open_since = None
    return out


def pieces_fold(seq, cuts):
    """Summaries of consecutive pieces, combined left to right."""
    bounds = [0, *sorted(set(cuts)), len(seq)]
    sessions = []
    total = Piece(False, int(NULL), int(NULL), int(NULL))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if lo == hi:
            continue
        part = [x for x in seq[lo:hi] if x[1] in (ALIVE, DEAD)]
        if not part:
            continue
        t = np.array([x[0] for x in part], dtype=np.int64)
        c = np.array([x[1] for x in part], dtype=np.int64)
        s = summarize(np.zeros(len(t), dtype=np.int64), t, c)
        sessions += list(zip(s.session_start.tolist(), s.session_end.tolist()))
        p = Piece(bool(s.has_dead[0]), int(s.head[0]), int(s.first_dead[0]), int(s.tail[0]))
        total, seam = combine(total, p)
        if seam:
            sessions.append(seam)
    if total.has_dead and total.head != NULL:
        sessions.append((total.head, total.first_dead))
    return sorted(sessions)


def stream_fold(seq, cuts):
    bounds = [0, *sorted(set(cuts)), len(seq)]
    open_since, out = int(NULL), []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = [x for x in seq[lo:hi] if x[1] in (ALIVE, DEAD)]
        if not part:
            continue
        t = np.array([x[0] for x in part], dtype=np.int64)
        c = np.array([x[1] for x in part], dtype=np.int64)
        sessions, open_since = fold_batch(open_since, t, np.arange(len(t), dtype=np.int64), c)
        out += sessions
    return sorted(out)


codes = st.lists(st.sampled_from([ALIVE, DEAD, 0]), min_size=0, max_size=60)


@settings(max_examples=300, deadline=None)
@given(codes, st.lists(st.integers(0, 60), max_size=6))
def test_cuts_do_not_change_sessions(cs, cuts):
    seq = [(i + 1, c) for i, c in enumerate(cs)]
    cuts = [c for c in cuts if c <= len(seq)]
    want = sorted(reference_fold(seq))
    assert pieces_fold(seq, cuts) == want
    assert stream_fold(seq, cuts) == want


def _events(spark, spec, device=1, connector=1, seq0=0):
    """spec like 'A1 D2 X3': status letter + minute."""
    rows = []
    for i, tok in enumerate(spec.split()):
        status = {"A": "ALIVE", "D": "DEAD", "X": "ACTIVE"}[tok[0]]
        rows.append((connector, device, BASE + dt.timedelta(minutes=int(tok[1:])), status, seq0 + i))
    return rows


CASES = [
    ("A1 D2", [(1, 2)]),
    ("D1", []),
    ("D1 A2 D3", [(2, 3)]),
    ("A1 A2 D3", [(1, 3)]),
    ("A1 D2 D3", [(1, 2)]),
    ("A1 D2 A3 D4", [(1, 2), (3, 4)]),
    ("X1 A2 X3 D4", [(2, 4)]),
    ("A1", []),
    ("D2 A1", [(1, 2)]),
]


def _minutes(rows):
    return sorted(
        (int((r.activeStartTime - BASE).total_seconds() // 60), int((r.activeEndTime - BASE).total_seconds() // 60))
        for r in rows
    )


@pytest.mark.parametrize("spec,want", CASES)
def test_session_hand_cases_batch(spark, spec, want):
    df = spark.createDataFrame(_events(spark, spec), EVENT)
    assert _minutes(device_sessions(df, num_partitions=3).collect()) == want
    assert _minutes(device_sessions_by_window(df).collect()) == want


def test_status_is_trimmed_and_case_folded(spark):
    rows = [(1, 1, BASE, " alive ", 0), (1, 1, BASE + dt.timedelta(minutes=5), "dead", 1)]
    df = spark.createDataFrame(rows, EVENT)
    assert _minutes(device_sessions(df).collect()) == [(0, 5)]


def test_equal_times_ordered_by_seq(spark):
    rows = [(1, 1, BASE, "DEAD", 2), (1, 1, BASE, "ALIVE", 1)]
    df = spark.createDataFrame(rows, EVENT)
    assert _minutes(device_sessions(df).collect()) == [(0, 0)]


def test_hot_device_split_across_partitions(spark):
    """One device holds most events; the range scan cuts it into several runs
    and the stitched result equals the per-device window form."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(6000):
        dev = 1 if i % 10 else int(rng.integers(2, 40))
        status = ["ALIVE", "DEAD", "OTHER"][int(rng.integers(0, 3))]
        rows.append((dev % 5, dev, BASE + dt.timedelta(seconds=i), status, i))
    df = spark.createDataFrame(rows, EVENT)
    got = sorted(tuple(r) for r in device_sessions(df, num_partitions=16).collect())
    want = sorted(tuple(r) for r in device_sessions_by_window(df).collect())
    assert got == want and len(got) > 100
    # the hot device really spans several range partitions
    from pulsegrid.operators.sessions import coded_events
    from pyspark.sql import functions as F

    spread = (
        coded_events(df)
        .repartitionByRange(16, "connectorid", "deviceid", "_t", "_s")
        .filter("deviceid = 1")
        .select(F.spark_partition_id().alias("p"))
        .distinct()
        .count()
    )
    assert spread > 4


def test_null_connector_is_its_own_device(spark):
    rows = [(None, 1, BASE, "ALIVE", 0), (1, 1, BASE + dt.timedelta(minutes=1), "DEAD", 1),
            (None, 1, BASE + dt.timedelta(minutes=2), "DEAD", 2)]
    df = spark.createDataFrame(rows, EVENT)
    got = [(r.connectorid, r.deviceid) for r in device_sessions(df).collect()]
    assert got == [(None, 1)]


def test_sessions_small_arrow_batches(spark):
    """Runs continue across Arrow batches of one partition (the carry)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        rng = np.random.default_rng(11)
        rows = [
            (1, int(rng.integers(1, 4)), BASE + dt.timedelta(seconds=i), ["ALIVE", "DEAD", "X"][int(rng.integers(0, 3))], i)
            for i in range(400)
        ]
        df = spark.createDataFrame(rows, EVENT)
        got = sorted(tuple(r) for r in device_sessions(df, num_partitions=3).collect())
        want = sorted(tuple(r) for r in device_sessions_by_window(df).collect())
        assert got == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_result_does_not_depend_on_exchange_reuse(spark):
    """Range bounds may differ between evaluations: the scan is evaluated once."""
    from pulsegrid.operators.ordering import event_order
    from pulsegrid.plans import catalog
    from tests.conftest import SF_CHECK

    confs = {"spark.sql.exchange.reuse": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        events = catalog._events(spark, SF_CHECK)
        got = device_sessions(events)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, device_sessions_by_window(events).collect()))
        ordered = event_order(events).collect()
        by: dict = {}
        for r in ordered:
            by.setdefault((r.connectorid, r.deviceid), []).append((r.eventtime, r.seq, r.event_order))
        assert len(ordered) == 10_000
        for rows in by.values():
            assert [n for *_, n in sorted(rows)] == list(range(1, len(rows) + 1))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
