"""Work that is dealt to many tasks and few state groups, however the tables are stored."""

import datetime as dt

from pyspark.sql import functions as F

from pulsegrid.plans import stream_catalog as sc
from pulsegrid.sinks import tables
from pulsegrid.sinks.tables import read_batch_table, write_sized
from pulsegrid.sources import tables as sources
from pulsegrid.sources import testbed
from pulsegrid.sources.files import message_file_stream
from pulsegrid.streaming import staging
from pulsegrid.streaming.queries import start_activity, start_sessions
from pulsegrid.config import list_folder
from tests.helpers import event, write_files

NOW = {"availableNow": True}


def _event_rows(spark, n, seconds=60):
    t0 = dt.datetime(2024, 1, 1)
    kinds = ("signup", "error", "view")
    rows = [(i, t0 + dt.timedelta(seconds=seconds * i), i % 7, kinds[i % 3], float(i), f'{{"k": {i}}}') for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")


def _sf(spark, workdir, n=400):
    _event_rows(spark, n).coalesce(1).write.parquet(f"{workdir}/events.parquet")
    return workdir


def _files(spark, path):
    return {s: len([f for f in list_folder(spark, f"{path}/{s}") if f.startswith("part-")]) for s in list_folder(spark, path)}


def test_every_slice_has_the_same_number_of_files(spark, workdir, monkeypatch):
    monkeypatch.setattr(staging, "ROWS_PER_PART", 30)
    path, per_slice = sc.stage_messages(spark, _sf(spark, workdir), f"{workdir}/in")
    files = _files(spark, path)
    assert len(files) == 4 and set(files.values()) == {per_slice} and per_slice > 4
    got = spark.read.parquet(f"{path}/slice=*").select("key", "value", "seq")
    want = testbed.message_log(spark, workdir)
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    # a trigger takes one slice: no duplicate or late row of an earlier one comes behind the watermark
    stream = sc.run_window_count_device(spark, workdir, (path, per_slice))
    assert [p["numInputRows"] for p in stream.progress][:4] == [
        spark.read.parquet(f"{path}/slice={i:04d}").count() for i in range(4)
    ]


def test_devices_share_state_groups(spark, workdir):
    t = lambda m: (dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)).strftime("%Y-%m-%d %H:%M:%S.000")
    n = 1500
    batches = [
        [(f"{d},0", event(d, 1, t(0), "ALIVE"), d) for d in range(n)],
        [(f"{d},0", event(d, 1, t(5), "DEAD"), n + d) for d in range(0, n, 2)],
    ]
    write_files(spark, f"{workdir}/in", batches)
    stream = lambda: message_file_stream(spark, f"{workdir}/in/slice=*")
    for name, start in (
        ("plain", lambda out, chk: start_sessions(stream(), out, chk, trigger=NOW)),
        ("sliced", lambda out, chk: start_sessions(stream(), out, chk, trigger=NOW, sliced=True, timeout="1 day")),
        ("activity", lambda out, chk: start_activity(stream(), out, chk, trigger=NOW)),
    ):
        q = start(f"{workdir}/{name}", f"{workdir}/{name}-chk")
        q.awaitTermination()
        states = max(sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in q.recentProgress)
        assert 0 < states <= 1024, name
        rows = read_batch_table(spark, f"{workdir}/{name}")
        assert rows.select("deviceid").distinct().count() == (n if name == "activity" else n // 2)
        if name != "activity":
            assert rows.count() == n // 2 and {r[0] % 2 for r in rows.select("deviceid").collect()} == {0}


def test_slices_of_a_log_come_in_several_files(spark, workdir, monkeypatch):
    monkeypatch.setattr(sc, "ROWS_PER_PART", 20)
    log = testbed.multi_value_log(spark, _sf(spark, workdir)).withColumn("slice", F.pmod(F.col("seq"), F.lit(4))).repartition(8)
    files = sc.files_per_slice(log)
    staging.write_numbered_slices(log, "slice", f"{workdir}/in", range(4), files)
    assert files == 5 and _files(spark, f"{workdir}/in") == {f"slice={i}": 5 for i in range(4)}
    assert spark.read.parquet(f"{workdir}/in").select("key", "value", "seq").exceptAll(log.drop("slice")).isEmpty()


def test_rows_of_one_file_are_dealt(spark, workdir):
    one = spark.read.parquet(f"{_sf(spark, workdir)}/events.parquet")
    assert sources.dealt(one, 50).rdd.getNumPartitions() == 8 and sources.dealt(one).rdd.getNumPartitions() == one.rdd.getNumPartitions()


def test_words_are_counted_from_several_files_a_slice(spark, workdir, monkeypatch):
    rows = [(i, f"a b{i % 3} c") for i in range(200)] + [(None, "a"), (7000, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(6).write.parquet(f"{workdir}/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    seen = []
    real = sc.message_file_stream
    monkeypatch.setattr(sc, "message_file_stream", lambda s, path, **o: seen.append(_files(s, path[: -len("/slice=*")])) or real(s, path, **o))
    try:
        got = {r["value"]: r["count"] for r in sc.run_word_count(spark, workdir).table.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {"a": 201, "c": 200, "b0": 67, "b1": 67, "b2": 66}
    assert max(seen[0].values()) > 1


def test_a_large_batch_is_not_written_by_one_task(spark, workdir, monkeypatch):
    monkeypatch.setattr(tables, "ONE_FILE_ROWS", 10)
    df = spark.range(100)
    plans = []
    real = type(df).hint
    monkeypatch.setattr(type(df), "hint", lambda self, name, *a: plans.append(name) or real(self, name, *a))
    write_sized(df, f"{workdir}/out", 100)
    write_sized(df.limit(5), f"{workdir}/small", 5)
    assert plans == ["rebalance"] and spark.read.parquet(f"{workdir}/out").count() == 100
