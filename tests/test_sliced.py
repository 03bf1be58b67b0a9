"""Two-level state on a stream, session timeouts, last activity."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulsegrid.config import micros
from pulsegrid.operators.session_core import ALIVE, DEAD, NULL, summarize
from pulsegrid.operators.sessions import coded_events, device_sessions
from pulsegrid.sources.files import message_file_stream
from pulsegrid.streaming import sliced
from pulsegrid.streaming.queries import start_activity, start_sessions
from pulsegrid.streaming.sliced import fold_activity, fold_pieces, slice_summaries
from pulsegrid.sinks.tables import latest_by_key, read_batch_table
from tests.helpers import event, write_files

T0 = dt.datetime(2018, 7, 20, 12)
NOW = {"availableNow": True}


def _machine(events, timeout, opened=NULL, seen=NULL):
    """The rule, event by event."""
    out = []
    for t, _, code in sorted(events):
        if timeout is not None and opened != NULL and t - seen > timeout:
            out.append((opened, seen + timeout, True))
            opened = NULL
        if code == ALIVE and opened == NULL:
            opened = t
        elif code == DEAD and opened != NULL:
            out.append((opened, t, False))
            opened = NULL
        seen = max(seen, t)
    return out, opened, seen


def _pieces(events, width):
    rows = sorted(events)
    t = np.array([r[0] for r in rows])
    gid = np.cumsum(np.diff(t // width, prepend=t[0] // width) != 0)
    s = summarize(gid, t, np.array([r[2] for r in rows]))
    first = [int(t[gid == g][0]) for g in range(gid[-1] + 1)]
    last = [int(t[gid == g][-1]) for g in range(gid[-1] + 1)]
    inner = list(zip(s.session_start.tolist(), s.session_end.tolist(), [False] * len(s.session_start)))
    return list(zip(first, last, s.has_dead.tolist(), s.head.tolist(), s.first_dead.tolist(), s.tail.tolist())), inner


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 300), st.integers(0, 10**6), st.sampled_from([ALIVE, DEAD])), min_size=1, max_size=40),
    st.integers(1, 40), st.sampled_from([None, 40, 60, 200]),
)
def test_summaries_of_slices_give_the_rule(events, width, timeout):
    pieces, inner = _pieces(events, width)
    closed, opened, seen = fold_pieces(int(NULL), int(NULL), pieces, timeout)
    want, want_open, want_seen = _machine(events, timeout)
    assert sorted(closed + inner) == sorted(want)
    assert (opened, seen) == (want_open, want_seen)


def _events(spark, rows):
    full = [(c, d, T0 + dt.timedelta(seconds=s), status, i) for i, (c, d, s, status) in enumerate(rows)]
    return spark.createDataFrame(full, "connectorid int, deviceid int, eventtime timestamp, status string, seq long")


def test_a_hot_device_is_spread_over_tasks(spark):
    rows = [(1, 7, s, "ALIVE" if s % 2 else "DEAD") for s in range(2000)] + [(1, d, 5, "ALIVE") for d in range(100, 300)]
    pieces = slice_summaries(coded_events(_events(spark, rows)), "10 seconds")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as in a stateful stream: no coalescing
    hot = pieces.filter("deviceid = 7").withColumn("task", F.spark_partition_id()).cache()
    hot.count()
    spark.conf.unset("spark.sql.adaptive.enabled")
    # events never meet: 200 slices of ten events, in all tasks
    assert hot.filter("lane = 0").count() == 200
    assert hot.select("task").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in hot.groupBy("task").count().collect()) < 0.4 * hot.count()
    # what a slice settles goes to the state operator in other groups
    lanes = {r["lane"] for r in hot.filter("lane > 0").select("lane").distinct().collect()}
    assert len(lanes) > 20 and max(lanes) <= sliced.LANES


def _run(spark, workdir, batches, **opts):
    write_files(spark, f"{workdir}/in", batches)
    q = start_sessions(
        message_file_stream(spark, f"{workdir}/in/slice=*"), f"{workdir}/out", f"{workdir}/chk", trigger=NOW, sliced=True, **opts
    )
    q.awaitTermination()
    rows = read_batch_table(spark, f"{workdir}/out").collect()
    minute = lambda t: (t - T0).total_seconds() / 60
    states = sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"])
    return sorted((r.deviceid, minute(r.activeStartTime), minute(r.activeEndTime), r.deviceactive) for r in rows), states


def _ev(device, minute, status, seq, connector=1):
    t = T0 + dt.timedelta(minutes=minute)
    return (f"{device},0", event(device, connector, t.strftime("%Y-%m-%d %H:%M:%S.000"), status), seq)


def test_sessions_across_batches_and_null_connector(spark, workdir):
    batches = [
        [_ev(7, 1, "ALIVE", 1), _ev(8, 1, "ALIVE", 2, connector=None)],
        [_ev(7, 2, "DEAD", 3), _ev(7, 3, "ALIVE", 4), _ev(7, 4, "DEAD", 5), _ev(7, 5, "ALIVE", 6)],
        [_ev(8, 6, "DEAD", 7, connector=None), _ev(7, 6, "OTHER", 8)],
    ]
    got, states = _run(spark, workdir, batches, slice_width="10 minutes")
    assert got == [(7, 1, 2, "DEAD"), (7, 3, 4, "DEAD"), (8, 1, 6, "DEAD")]
    assert states == 1  # device 7 is open


def test_silence_ends_a_session_and_its_state(spark, workdir):
    batches = [
        [_ev(7, 0, "ALIVE", 1), _ev(9, 0, "ALIVE", 2)],
        [_ev(9, 20, "ALIVE", 3)],
        [_ev(8, 100, "ALIVE", 4)],
        [_ev(8, 200, "DEAD", 5)],
    ]
    got, states = _run(spark, workdir, batches, timeout="30 minutes")
    # device 8's DEAD comes after its silence
    assert got == [(7, 0, 30, "TIMEOUT"), (8, 100, 130, "TIMEOUT"), (9, 0, 50, "TIMEOUT")]
    assert states == 0


def test_without_timeout_silence_changes_nothing(spark, workdir):
    got, states = _run(spark, workdir, [[_ev(7, 0, "ALIVE", 1)], [_ev(8, 5000, "ALIVE", 2)], [_ev(7, 6000, "DEAD", 3)]])
    assert got == [(7, 0, 6000, "DEAD")] and states == 1


@pytest.mark.parametrize("cuts", [1, 3])
def test_timeout_results_do_not_depend_on_batches(spark, workdir, cuts):
    rng = np.random.default_rng(3)
    rows = sorted((int(m), int(d), "ALIVE" if a else "DEAD") for m, d, a in zip(rng.integers(0, 900, 120), rng.integers(1, 9, 120), rng.random(120) < 0.6))
    evs = [_ev(d, m, s, i) for i, (m, d, s) in enumerate(rows)]
    size = -(-len(evs) // cuts)
    got, _ = _run(spark, workdir, [evs[k : k + size] for k in range(0, len(evs), size)], timeout="45 minutes")
    events = _events(spark, [(1, d, m * 60, s) for m, d, s in rows])
    until = events.agg(F.max(F.unix_micros("eventtime"))).first()[0] - micros("10 minutes")
    batch = device_sessions(events, num_partitions=5, timeout="45 minutes", until=until).collect()
    want = sorted((r.deviceid, (r.activeStartTime - T0).total_seconds() / 60, (r.activeEndTime - T0).total_seconds() / 60, r.deviceactive) for r in batch)
    assert got == want and {r[3] for r in want} == {"DEAD", "TIMEOUT"}


def test_batch_timeouts_equal_the_rule_over_many_partitions(spark):
    rng = np.random.default_rng(5)
    rows = [(1, 7 if k % 4 else int(rng.integers(8, 12)), int(rng.integers(0, 20_000)), rng.choice(["ALIVE", "DEAD", "x"])) for k in range(800)]
    events = _events(spark, rows)
    got = sorted((r.deviceid, (r.activeStartTime - T0).total_seconds(), (r.activeEndTime - T0).total_seconds(), r.deviceactive) for r in device_sessions(events, num_partitions=9, timeout="1 minute").collect())
    want = []
    for d in {r[1] for r in rows}:
        own = [(s, i, ALIVE if st_ == "ALIVE" else DEAD) for i, (_, e, s, st_) in enumerate(rows) if e == d and st_ != "x"]
        out, opened, seen = _machine(own, 60)
        out += [(opened, seen + 60, True)] if opened != NULL else []
        want += [(d, a, b, "TIMEOUT" if silent else "DEAD") for a, b, silent in out]
    assert got == sorted(want)


def test_timeout_shorter_than_a_slice_is_refused(spark):
    with pytest.raises(ValueError):
        sliced.device_sessions_sliced_stream(_events(spark, [(1, 1, 1, "ALIVE")]), timeout="1 second", slice_width="1 minute")
    with pytest.raises(ValueError):
        micros("soon")


def test_activity_of_devices(spark, workdir):
    batches = [
        [_ev(7, 0, "VIEW", 1), _ev(7, 10, "CLICK", 2), _ev(8, 0, "DEAD", 3)],
        [_ev(7, 30, "ALIVE", 4)],
        [_ev(9, 200, "VIEW", 5)],
        [_ev(8, 300, "VIEW", 6), _ev(8, 310, "VIEW", 7)],
    ]
    write_files(spark, f"{workdir}/in", batches)
    q = start_activity(message_file_stream(spark, f"{workdir}/in/slice=*"), f"{workdir}/out", f"{workdir}/chk", trigger=NOW, idle="40 minutes")
    q.awaitTermination()
    latest = latest_by_key(read_batch_table(spark, f"{workdir}/out"), ["connectorid", "deviceid"], ["batch_id"])
    got = {r.deviceid: ((r.activetime - T0).seconds // 60, (r.lastactivetime - T0).seconds // 60) for r in latest.collect()}
    assert got == {7: (0, 30), 8: (300, 310), 9: (200, 200)}
    assert sum(op["numRowsTotal"] for op in q.lastProgress["stateOperators"]) == 1  # only device 8 is not idle


def test_late_spans_join_the_present_stretch_only():
    assert fold_activity(100, 90, [(80, 85)], 10) == (100, 80)
    assert fold_activity(100, 90, [(70, 75)], 10) == (100, 90)
    assert fold_activity(100, 90, [(111, 120)], 10) == (120, 111)
    assert fold_activity(int(NULL), int(NULL), [(5, 6), (16, 18)], 10) == (18, 5)
