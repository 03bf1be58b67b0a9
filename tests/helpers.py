from __future__ import annotations

import json
import time

from pulsegrid.schemas import MESSAGE


def reading(device, connector, eventtime, values, name="iottesttimeseries"):
    """Reading message body; ``values`` is a list of (variableid, value)."""
    return json.dumps(
        {
            "name": name,
            "header": {"timeseries": 1, "connectorid": connector, "deviceid": device, "eventtime": eventtime},
            "iotdata": {"values": [{"variableid": v, "value": x} for v, x in values]},
        }
    )


def event(device, connector, eventtime, status):
    return json.dumps(
        {
            "name": "iottestevent",
            "header": {"timeseries": 0, "connectorid": connector, "deviceid": device, "eventtime": eventtime},
            "values": {"status": status},
        }
    )


def messages(spark, rows):
    """rows: (key, value[, seq])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, MESSAGE)


def write_files(spark, path, batches):
    """Write each batch of (key, value, seq) rows as its own file, in order."""
    for i, rows in enumerate(batches):
        messages(spark, rows).coalesce(1).write.mode("overwrite").parquet(f"{path}/slice={i:04d}")
        time.sleep(0.05)


def device_sessions_by_window(events, seq_col="seq"):
    """The sessions with ``lag``/``lead`` over a per-device window, for cross-checks."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from pulsegrid.operators.session_core import ALIVE, DEAD
    from pulsegrid.operators.sessions import _as_sessions, coded_events

    coded = coded_events(events, seq_col)
    w = Window.partitionBy("connectorid", "deviceid").orderBy("_t", "_s")
    prev = F.lag("_code").over(w)
    kept = coded.withColumn("_prev", prev).filter(
        ((F.col("_code") == ALIVE) & (F.coalesce(F.col("_prev"), F.lit(DEAD)) == DEAD))
        | ((F.col("_code") == DEAD) & (F.col("_prev") == ALIVE))
    )
    paired = kept.select(
        "connectorid",
        "deviceid",
        "_code",
        F.timestamp_micros("_t").alias("start"),
        F.lead("_code").over(w).alias("_next"),
        F.timestamp_micros(F.lead("_t").over(w)).alias("end"),
    )
    return _as_sessions(paired.filter((F.col("_code") == ALIVE) & (F.col("_next") == DEAD)))
