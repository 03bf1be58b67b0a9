import numpy as np
import pytest

from pulsegrid.operators.decode import decode_readings
from pulsegrid.operators.dedup import drop_duplicate_events, drop_duplicate_readings
from pulsegrid.operators.session_core import NULL
from pulsegrid.schemas import METADATA
from pulsegrid.sinks.tables import latest_by_key, read_batch_table, write_batch
from pulsegrid.sources.files import message_file_stream
from pulsegrid.streaming.queries import start_ingest, start_sessions
from pulsegrid.streaming.state import fold_batch, fold_small
from tests.helpers import event, messages, reading, write_files

AVAILABLE_NOW = {"availableNow": True}


def _ts(minute, second=0, hour=12):
    return f"2018-07-20 {hour:02d}:{minute:02d}:{second:02d}.000"


def _sessions(spark, workdir, batches):
    write_files(spark, f"{workdir}/in", batches)
    q = start_sessions(
        message_file_stream(spark, f"{workdir}/in/slice=*"), f"{workdir}/out", f"{workdir}/chk", trigger=AVAILABLE_NOW
    )
    q.awaitTermination()
    rows = read_batch_table(spark, f"{workdir}/out").collect()
    return sorted((r.activeStartTime.minute, r.activeEndTime.minute) for r in rows)


def _ev(status, minute, seq):
    return ("7,0", event(7, 1, _ts(minute), status), seq)


def test_stream_sessions_four_batches(spark, workdir):
    batches = [[_ev("ALIVE", 1, 1)], [_ev("DEAD", 2, 2)], [_ev("ALIVE", 3, 3)], [_ev("DEAD", 4, 4)]]
    assert _sessions(spark, workdir, batches) == [(1, 2), (3, 4)]


def test_stream_sessions_one_batch_two_sessions(spark, workdir):
    batches = [[_ev("ALIVE", 1, 1), _ev("DEAD", 2, 2), _ev("ALIVE", 3, 3), _ev("DEAD", 4, 4)]]
    assert _sessions(spark, workdir, batches) == [(1, 2), (3, 4)]


def test_stream_sessions_sorted_inside_batch(spark, workdir):
    assert _sessions(spark, workdir, [[_ev("DEAD", 2, 1), _ev("ALIVE", 1, 2)]]) == [(1, 2)]


def test_stream_sessions_cross_batch_disorder_kept(spark, workdir):
    assert _sessions(spark, workdir, [[_ev("ALIVE", 5, 1)], [_ev("DEAD", 3, 2)]]) == [(5, 3)]


def test_stream_sessions_open_state_kept(spark, workdir):
    assert _sessions(spark, workdir, [[_ev("ALIVE", 1, 1)], [_ev("OTHER", 2, 2)]]) == []


def _dedup_stream(spark, workdir, batches, watermark="10 minutes"):
    write_files(spark, f"{workdir}/in", batches)
    src = message_file_stream(spark, f"{workdir}/in/slice=*")
    deduped = drop_duplicate_readings(decode_readings(src), watermark=watermark)
    q = (
        deduped.writeStream.format("parquet")
        .option("path", f"{workdir}/out")
        .option("checkpointLocation", f"{workdir}/chk")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q, spark.read.parquet(f"{workdir}/out")


def test_stream_dedup_across_files(spark, workdir):
    same = ("1,1", reading(1, 1, _ts(0), [("v", 1.0)]))
    other_value = ("1,1", reading(1, 1, _ts(0), [("v", 2.0)]))
    _, out = _dedup_stream(spark, workdir, [[same, same], [same, other_value]])
    assert sorted(r.value for r in out.collect()) == [1.0, 2.0]


def test_late_rows_dropped_by_watermark(spark, workdir):
    def r(h, m, s, v):
        return ("1,1", reading(1, 1, _ts(m, s, hour=h), [("v", v)]))

    batches = [[r(12, 0, 0, 1.0)], [r(12, 0, 1, 2.0)], [r(11, 0, 0, 3.0), r(11, 55, 0, 4.0)]]
    q, out = _dedup_stream(spark, workdir, batches)
    assert sorted(x.value for x in out.collect()) == [1.0, 2.0, 4.0]
    dropped = sum(
        op.get("numRowsDroppedByWatermark", 0) for p in q.recentProgress for op in p.get("stateOperators", [])
    )
    assert dropped == 1


def test_late_rows_in_second_file_not_dropped(spark, workdir):
    def r(h, m, s, v):
        return ("1,1", reading(1, 1, _ts(m, s, hour=h), [("v", v)]))

    batches = [[r(12, 0, 0, 1.0)], [r(11, 0, 0, 3.0), r(11, 55, 0, 4.0)]]
    _, out = _dedup_stream(spark, workdir, batches)
    assert out.count() == 3


def _meta(spark):
    return spark.createDataFrame([("g", 1, "c", 1, "v", 1, "DOUBLE", 1)], METADATA)


def test_ingest_stream_routes_tables_and_restarts(spark, workdir):
    good = ("1,1", reading(1, 1, _ts(0), [("v", 1.0)]))
    bad = ("2,1", reading(2, 1, _ts(0), [("v", 1.0)]))
    write_files(spark, f"{workdir}/in", [[good, bad]])
    args = (f"{workdir}/good", f"{workdir}/error", f"{workdir}/chk")
    start_ingest(message_file_stream(spark, f"{workdir}/in/slice=*"), _meta(spark), *args, trigger=AVAILABLE_NOW).awaitTermination()
    # more input, restart on the same checkpoint: earlier files are not re-read
    import time

    time.sleep(0.05)
    messages(spark, [("1,1", reading(1, 1, _ts(1), [("v", 5.0)]), 9)]).coalesce(1).write.parquet(f"{workdir}/in/slice=0001")
    start_ingest(message_file_stream(spark, f"{workdir}/in/slice=*"), _meta(spark), *args, trigger=AVAILABLE_NOW).awaitTermination()
    g = read_batch_table(spark, f"{workdir}/good")
    e = read_batch_table(spark, f"{workdir}/error")
    assert sorted(r.VALUE for r in g.collect()) == [1.0, 5.0]
    assert [r.RESULT for r in e.collect()] == ["deviceid not found in metadata"]
    assert {f.name for f in g.schema.fields} >= {"CONNECTORID", "DEVICEID", "EVENTTIME", "VARIABLEID", "VALUE", "row_key"}


def test_batch_retry_replaces_its_own_rows_only(spark, workdir):
    rows = spark.createDataFrame([(1.0,), (2.0,)], "v double")
    write_batch(rows, f"{workdir}/t", 3, "q1")
    write_batch(rows.filter("v > 1"), f"{workdir}/t", 3, "q1")  # the batch again, as after a failure
    write_batch(rows, f"{workdir}/t", 3, "q2")
    write_batch(rows.limit(0), f"{workdir}/t", 4, "q1")  # empty and never tried: nothing
    write_batch(rows.limit(0), f"{workdir}/t", 3, "q2")  # empty, but an earlier attempt wrote
    got = sorted(tuple(r) for r in read_batch_table(spark, f"{workdir}/t").select("query_id", "batch_id", "v").collect())
    assert got == [("q1", 3, 2.0)]
    with pytest.raises(ValueError):
        write_batch(rows, f"{workdir}/t", 5)


def test_two_checkpoints_on_one_table_keep_both_runs(spark, workdir):
    meta = spark.createDataFrame([("g", 1, "c", 1, "v", 1, "DOUBLE", 1)], METADATA)
    for run, value in enumerate([1.0, 2.0]):
        write_files(spark, f"{workdir}/in{run}", [[("1,1", reading(1, 1, _ts(0), [("v", value)]), 1)]])
        src = message_file_stream(spark, f"{workdir}/in{run}/slice=*")
        start_ingest(src, meta, f"{workdir}/good", f"{workdir}/error", f"{workdir}/chk{run}", trigger=AVAILABLE_NOW).awaitTermination()
    assert sorted(r.VALUE for r in read_batch_table(spark, f"{workdir}/good").collect()) == [1.0, 2.0]


def test_rows_without_a_key_are_not_merged(spark):
    rows = [(None, 1, "a", 1.0), (None, 2, "a", 2.0), (b"k", 1, "a", 3.0), (b"k", 2, "a", 4.0), (b"k", 2, "b", 5.0)]
    table = spark.createDataFrame(rows, "row_key binary, batch_id int, VARIABLEID string, VALUE double")
    assert sorted(r.VALUE for r in latest_by_key(table).collect()) == [1.0, 2.0, 5.0]


def test_compaction_keeps_rows(spark, workdir):
    from pulsegrid.sinks.tables import compact_table

    for b in range(5):
        write_batch(spark.createDataFrame([(float(b),)], "v double"), f"{workdir}/t", b, "q")
    compact_table(spark, f"{workdir}/t", f"{workdir}/small")
    small = spark.read.parquet(f"{workdir}/small")
    assert sorted((r.query_id, r.batch_id, r.v) for r in small.collect()) == [("q", b, float(b)) for b in range(5)]
    assert len(small.inputFiles()) == 1


def test_event_dedup_within_watermark_refuses_batch_tables(spark):
    from pulsegrid.schemas import EVENT

    with pytest.raises(ValueError):
        drop_duplicate_events(spark.createDataFrame([], EVENT))


def test_event_dedup_within_watermark_stream(spark, workdir):
    from pulsegrid.operators.decode import decode_events

    # other devices move the watermark on; state is evicted at the end of the
    # batch after the watermark passed the expiry
    other = [("8,0", event(8, 1, _ts(30), "ALIVE"), 3)], [("9,0", event(9, 1, _ts(31), "ALIVE"), 4)]
    batches = [[_ev("ALIVE", 1, 1), _ev("ALIVE", 1, 2)], *other, [_ev("ALIVE", 32, 5)]]
    write_files(spark, f"{workdir}/in", batches)
    deduped = drop_duplicate_events(decode_events(message_file_stream(spark, f"{workdir}/in/slice=*")))
    q = (
        deduped.writeStream.format("parquet")
        .option("path", f"{workdir}/out")
        .option("checkpointLocation", f"{workdir}/chk")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    # the copy goes; the same status again, once the watermark has passed the
    # first one's expiry (a batch later), stays
    out = spark.read.parquet(f"{workdir}/out").filter("deviceid = 7")
    assert sorted(r.eventtime.minute for r in out.collect()) == [1, 32]


def test_sessions_with_rocksdb_state(spark, workdir):
    from pulsegrid.config import use_rocksdb_state

    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    use_rocksdb_state(spark)
    try:
        batches = [[_ev("ALIVE", 1, 1)], [_ev("DEAD", 2, 2), _ev("ALIVE", 3, 3)], [_ev("DEAD", 4, 4)]]
        assert _sessions(spark, workdir, batches) == [(1, 2), (3, 4)]
    finally:
        spark.conf.set(key, old)


def _staged_sessions(spark, workdir, n_slices, phases):
    from pulsegrid.operators.decode import decode_events as dec
    from pulsegrid.sources import testbed
    from pulsegrid.streaming.staging import write_time_slices

    from tests.conftest import SF_SMALL

    ev = testbed.device_events(spark, SF_SMALL)
    per = 1
    for only in phases:
        per = write_time_slices(ev, "eventtime", f"{workdir}/in", n_slices, testbed.messages_from_events, only=only)
        src = message_file_stream(spark, f"{workdir}/in/slice=*", max_files_per_trigger=per)
        start_sessions(src, f"{workdir}/out", f"{workdir}/chk", trigger=AVAILABLE_NOW).awaitTermination()
    got = sorted(tuple(r) for r in read_batch_table(spark, f"{workdir}/out").drop("query_id", "batch_id").collect())
    from pulsegrid.operators.sessions import device_sessions

    want = sorted(tuple(r) for r in device_sessions(dec(testbed.message_log(spark, SF_SMALL))).collect())
    return got, want


def test_sessions_equal_for_1_2_4_input_slices(spark):
    import tempfile

    for n in (1, 2, 4):
        got, want = _staged_sessions(spark, tempfile.mkdtemp(prefix="pg-cut-"), n, [None])
        assert got == want and len(want) > 50, n


def test_sessions_restart_on_same_checkpoint(spark, workdir):
    got, want = _staged_sessions(spark, workdir, 4, [[0, 1], [2, 3]])
    assert got == want


def test_stream_salted_join_equals_broadcast(spark, workdir):
    from pulsegrid.operators.validate import validate_readings

    meta = spark.createDataFrame([("g", d, "c", d % 3, "v", 1, "DOUBLE", 1) for d in range(1, 6)], METADATA)
    rows = [(f"{d},1", reading(d, c, _ts(m), [("v", float(m))]), m) for d in range(1, 8) for c in (d % 3, 2) for m in range(3)]
    write_files(spark, f"{workdir}/in", [rows])
    out = {}
    for strategy in ("broadcast", "salted"):
        src = message_file_stream(spark, f"{workdir}/in/slice=*")
        v = validate_readings(decode_readings(src), meta, strategy=strategy, salt_buckets=4)
        q = (
            v.writeStream.format("parquet")
            .option("path", f"{workdir}/out_{strategy}")
            .option("checkpointLocation", f"{workdir}/chk_{strategy}")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
        out[strategy] = sorted(tuple(r) for r in spark.read.parquet(f"{workdir}/out_{strategy}").collect())
    assert out["salted"] == out["broadcast"] and len(out["salted"]) == 42


def test_line_streams(spark, workdir):
    from pulsegrid.streaming.queries import average_line_stream, session_line_stream

    meta = spark.createDataFrame([("g", 1, "c", 1, "v", 1, "DOUBLE", 1)], METADATA)
    batches = [
        [("1,1", reading(1, 1, "2018-07-20 13:19:00.000", [("1", 20.0)]), 1), ("1,0", event(1, 1, "2018-07-20 13:20:00.000", "ALIVE"), 2)],
        [("1,0", event(1, 1, "2018-07-20 13:25:01.120", "DEAD"), 3), ("1,1", reading(1, 1, "2018-07-20 13:45:00.000", [("1", 1.0)]), 4)],
    ]
    write_files(spark, f"{workdir}/in", batches)
    src = message_file_stream(spark, f"{workdir}/in/slice=*")
    for name, lines in (("avg", average_line_stream(src, meta)), ("sess", session_line_stream(src))):
        mode = "append" if name == "avg" else "update"
        q = (
            lines.writeStream.outputMode(mode)
            .foreachBatch(lambda df, i, n=name: df.write.mode("append").text(f"{workdir}/{n}"))
            .option("checkpointLocation", f"{workdir}/chk_{name}")
            .trigger(availableNow=True)
            .start()
        )
        q.awaitTermination()
    assert [r.value for r in spark.read.text(f"{workdir}/avg").collect()] == [
        "[2018-07-20 13:18:00.0,2018-07-20 13:21:00.0],1,1,20.0"
    ]
    assert [r.value for r in spark.read.text(f"{workdir}/sess").collect()] == [
        "1,2018-07-20 13:20:00.0,2018-07-20 13:25:01.12,DEAD"
    ]


@pytest.mark.parametrize("seed", range(20))
def test_small_fold_equals_array_fold(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 40))
    rows = [(int(t), k, int(c)) for k, (t, c) in enumerate(zip(rng.integers(0, 25, n), rng.integers(1, 3, n)))]
    for start in (int(NULL), -5):
        t, s, c = (np.array(x, dtype=np.int64) for x in zip(*rows))
        sessions, left = fold_batch(start, t, s, c)
        small, small_left = fold_small(start, rows)
        assert (sorted(small), small_left) == (sorted(sessions), left)


def test_routing_uses_key_not_header_timeseries(spark):
    body = reading(1, 1, _ts(0), [("v", 1.0)]).replace('"timeseries": 1', '"timeseries": 0')
    msgs = messages(spark, [("1,1", body)])
    rows = decode_readings(msgs).collect()
    assert [(r.timeseries, r.value) for r in rows] == [(0, 1.0)]


def test_app_runs_three_queries_on_files(spark, workdir):
    from pulsegrid.streaming.app import parse_args, start_all

    meta = spark.createDataFrame([("g", 1, "c", 1, "v", 1, "DOUBLE", 1)], METADATA)
    meta.write.parquet(f"{workdir}/meta")
    batches = [
        [("1,1", reading(1, 1, _ts(0), [("v", 2.0)]), 1), ("1,0", event(1, 1, _ts(0), "ALIVE"), 2)],
        [("1,1", reading(1, 1, _ts(40), [("v", 4.0)]), 3), ("1,0", event(1, 1, _ts(41), "DEAD"), 4), ("1", "x", 5)],
    ]
    write_files(spark, f"{workdir}/in", batches)
    args = parse_args([
        "--files", f"{workdir}/in/slice=*", "--metadata", f"{workdir}/meta",
        "--tables", f"{workdir}/tables", "--checkpoints", f"{workdir}/chk", "--available-now",
    ])
    for q in start_all(spark, args):
        q.awaitTermination()
    assert read_batch_table(spark, f"{workdir}/tables/good").count() == 2
    assert read_batch_table(spark, f"{workdir}/tables/error").count() == 0
    assert read_batch_table(spark, f"{workdir}/tables/sessions").count() == 1
    assert [r.reason for r in read_batch_table(spark, f"{workdir}/tables/malformed").collect()] == ["key has no integer flag"]
    avg = read_batch_table(spark, f"{workdir}/tables/averages")
    assert [r.avg_value for r in avg.collect()] == [2.0]


@pytest.mark.parametrize("flags", [["--files", "x", "--window-topic", "t"], ["--files", "x", "--session-topic", "t"], ["--kafka", "b:1"]])
def test_app_refuses_flags_that_do_not_fit(flags):
    from pulsegrid.streaming.app import parse_args

    with pytest.raises(SystemExit):
        parse_args([*flags, "--metadata", "m", "--tables", "t", "--checkpoints", "c"])
