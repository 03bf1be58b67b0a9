import datetime as dt

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from pulsegrid.operators.ordering import event_order
from pulsegrid.schemas import EVENT

BASE = dt.datetime(2018, 7, 20, 13, 0)


def test_event_order_hot_device_equals_window_row_number(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(5000):
        dev = 1 if i % 4 else int(rng.integers(2, 30))
        conn = None if dev == 7 else dev % 3
        rows.append((conn, dev, BASE + dt.timedelta(seconds=int(rng.integers(0, 100000))), "X", i))
    df = spark.createDataFrame(rows, EVENT)
    got = sorted(tuple(r) for r in event_order(df, num_partitions=12).select("seq", "event_order").collect())
    w = Window.partitionBy("connectorid", "deviceid").orderBy("eventtime", "seq")
    want = sorted(tuple(r) for r in df.select("seq", F.row_number().over(w).alias("event_order")).collect())
    assert got == want


def test_event_order_small_batches_carry_runs(spark):
    # Arrow batches of 7 rows force runs to continue across batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, 1, BASE + dt.timedelta(seconds=i), "X", i) for i in range(50)]
        df = spark.createDataFrame(rows, EVENT)
        got = sorted((r.seq, r.event_order) for r in event_order(df, num_partitions=2).collect())
        assert got == [(i, i + 1) for i in range(50)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
