"""Device view of the shared test tables.

The test tables are not device data, so this module derives device data from
them with Spark (the derivation grows with the tables):

* ``events`` becomes a keyed message log: one reading message and one status
  message per row, a second copy of some readings (to be removed by the
  de-duplication) and some malformed messages;
* ``customer`` becomes the device metadata table.

Mapping (fixed, shared with the SQL oracle): ``deviceid = user_id``,
``connectorid = user_id % 5``, ``eventtime = ts``, ``variableid = event_type``,
``value = value``, ``seq = event_id``; status ``signup`` gives ``' alive '``,
``error`` gives ``DEAD``, any other type its upper-case name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import EVENT_NAME, READING_NAME, TABLE_TIME_FORMAT, use_utc
from pulsegrid.sources.tables import dealt, read_table

# Every DUPLICATE_EVERY-th event is sent twice as a reading.
DUPLICATE_EVERY = 3
# Malformed messages: one extra message per event whose id modulo BAD_EVERY is
# one of the kinds below.
BAD_EVERY = 50
BAD_NO_FLAG = 1  # key without a second field
BAD_FLAG_TEXT = 2  # key whose second field is not an integer
BAD_NULL_KEY = 3  # no key at all
BAD_READING_JSON = 4  # reading key, body is not JSON
BAD_READING_VALUE = 5  # reading key, value is not a number
BAD_EVENT_JSON = 6  # event key, body is not JSON
OTHER_FLAG = 7  # key flag 2: neither reading nor event, ignored
BAD_TIME = 9  # reading whose time is before 1970
EMPTY_VALUES = 8  # reading with an empty value list: no reading, not malformed

_JSON_OPTS = {"timestampFormat": TABLE_TIME_FORMAT}


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` mapped to device columns (TIMESTAMP, not NTZ)."""
    use_utc(spark)
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("user_id"),
        F.col("user_id").cast("int").alias("deviceid"),
        (F.col("user_id") % 5).cast("int").alias("connectorid"),
        F.col("ts").cast("timestamp").alias("eventtime"),
        F.col("event_type").alias("variableid"),
        F.col("value").alias("value"),
        F.when(F.col("event_type") == "signup", F.lit(" alive "))
        .when(F.col("event_type") == "error", F.lit("DEAD"))
        .otherwise(F.upper("event_type"))
        .alias("status"),
    )


HOT_DEVICE = 1
COLD_EVERY = 10  # every so many events keep their device, all others come from the hot one


def skewed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`device_events` with nine tenths of the events sent by one device."""
    device = F.when(F.col("seq") % COLD_EVERY == 0, F.col("user_id")).otherwise(F.lit(HOT_DEVICE))
    ev = device_events(spark, sf_dir).withColumn("user_id", device)
    return ev.withColumn("deviceid", F.col("user_id").cast("int")).withColumn("connectorid", (F.col("user_id") % 5).cast("int"))


def _header(eventtime: Column | None = None) -> Column:
    return F.struct(
        F.lit(1).alias("timeseries"),
        F.col("connectorid"),
        F.col("deviceid"),
        (F.col("eventtime") if eventtime is None else eventtime).alias("eventtime"),
    )


def _reading_json(value: Column, values_override: Column | None = None, eventtime: Column | None = None) -> Column:
    values = (
        values_override
        if values_override is not None
        else F.array(F.struct(F.col("variableid").alias("variableid"), value.alias("value")))
    )
    body = F.struct(
        F.lit(READING_NAME).alias("name"),
        _header(eventtime).alias("header"),
        F.struct(values.alias("values")).alias("iotdata"),
    )
    return F.to_json(body, _JSON_OPTS)


def _event_json() -> Column:
    body = F.struct(
        F.lit(EVENT_NAME).alias("name"),
        _header().alias("header"),
        F.struct(F.col("status").alias("status")).alias("values"),
    )
    return F.to_json(body, _JSON_OPTS)


def _msg(key: Column, value: Column) -> Column:
    return F.struct(key.cast("string").alias("key"), value.alias("value"), F.col("seq").alias("seq"))


def messages_from_events(ev: DataFrame, with_duplicates: bool = True, with_bad: bool = True) -> DataFrame:
    """Keyed message log ``(key, value, seq)`` from :func:`device_events` rows,
    in one pass (each row fans out to its messages with ``inline``; no
    shuffle)."""
    uid = F.col("user_id").cast("string")
    reading_key = F.concat(uid, F.lit(",1"))
    event_key = F.concat(uid, F.lit(",0"))
    body = _reading_json(F.col("value"))  # one Column object, reused below
    reading = _msg(reading_key, body)
    kind = F.col("seq") % BAD_EVERY
    msgs = [reading, _msg(event_key, _event_json())]
    if with_duplicates:
        msgs.append(F.when(F.col("seq") % DUPLICATE_EVERY == 0, reading))
    if with_bad:
        old_time = F.lit("1969-12-31 23:59:59.999").cast("timestamp")
        empty_values = F.array().cast("array<struct<variableid:string,value:double>>")
        msgs += [
            F.when(kind == BAD_NO_FLAG, _msg(uid, body)),
            F.when(kind == BAD_FLAG_TEXT, _msg(F.concat(uid, F.lit(",x")), body)),
            F.when(kind == BAD_NULL_KEY, _msg(F.lit(None).cast("string"), body)),
            F.when(kind == BAD_READING_JSON, _msg(reading_key, F.lit("{bad"))),
            F.when(kind == BAD_READING_VALUE, _msg(reading_key, _reading_json(F.lit("abc")))),
            F.when(kind == BAD_EVENT_JSON, _msg(event_key, F.lit("{bad"))),
            F.when(kind == OTHER_FLAG, _msg(F.concat(uid, F.lit(",2")), body)),
            F.when(kind == BAD_TIME, _msg(reading_key, _reading_json(F.col("value"), eventtime=old_time))),
            F.when(kind == EMPTY_VALUES, _msg(reading_key, _reading_json(F.col("value"), empty_values))),
        ]
    return ev.select(F.inline(F.filter(F.array(*msgs), lambda m: m.isNotNull())))


def duplicates_from_events(ev: DataFrame) -> DataFrame:
    """The second copies of readings alone."""
    key = F.concat(F.col("user_id").cast("string"), F.lit(",1"))
    again = ev.filter(F.col("seq") % DUPLICATE_EVERY == 0)
    return again.select(_msg(key, _reading_json(F.col("value"))).alias("m")).select("m.*")


def message_log(spark: SparkSession, sf_dir: str, with_duplicates: bool = True, with_bad: bool = True) -> DataFrame:
    """The keyed message log of the whole ``events`` table."""
    return messages_from_events(device_events(spark, sf_dir), with_duplicates, with_bad)


def multi_value_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reading messages carrying two values each: the event's own value and the
    ``k`` number of its ``props`` (variable id ``k``)."""
    use_utc(spark)
    ev = dealt(read_table(spark, sf_dir, "events"))
    base = ev.select(
        F.col("event_id").alias("seq"),
        F.col("user_id"),
        F.col("user_id").cast("int").alias("deviceid"),
        (F.col("user_id") % 5).cast("int").alias("connectorid"),
        F.col("ts").cast("timestamp").alias("eventtime"),
        F.col("event_type").alias("variableid"),
        F.col("value"),
        F.get_json_object("props", "$.k").try_cast("double").alias("k"),
    )
    values = F.array(
        F.struct(F.col("variableid").alias("variableid"), F.col("value").alias("value")),
        F.struct(F.lit("k").alias("variableid"), F.col("k").alias("value")),
    )
    key = F.concat(F.col("user_id").cast("string"), F.lit(",1"))
    return base.select(_msg(key, _reading_json(F.col("value"), values)).alias("m")).select("m.*")


def device_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata derived from ``customer``: devices whose key is not a multiple
    of 7, one current row each, plus an older row with a wrong connector for
    every third device (lower ``row_order``; the last row wins)."""
    use_utc(spark)
    c = read_table(spark, sf_dir, "customer").filter(F.col("c_custkey") % 7 != 0)
    right = F.when(F.col("c_nationkey") % 2 == 0, F.col("c_custkey") % 5).otherwise((F.col("c_custkey") + 1) % 5)

    def row(conn: Column, order: Column) -> Column:
        return F.struct(
            F.concat(F.lit("dev-"), F.col("c_custkey").cast("string")).alias("deviceguid"),
            F.col("c_custkey").cast("int").alias("deviceid"),
            F.concat(F.lit("conn-"), conn.cast("string")).alias("connectorguid"),
            conn.cast("int").alias("connectorid"),
            F.lower("c_mktsegment").alias("variablename"),
            F.col("c_nationkey").cast("int").alias("variableid"),
            F.lit("DOUBLE").alias("variableDataType"),
            order.cast("bigint").alias("row_order"),
        )

    current = row(right, F.col("c_custkey") * 2 + 1)
    older = F.when(F.col("c_custkey") % 3 == 0, row((right + 1) % 5, F.col("c_custkey") * 2))
    return c.select(F.inline(F.filter(F.array(current, older), lambda m: m.isNotNull())))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents.text`` as a ``value`` line column (word-count input)."""
    return read_table(spark, sf_dir, "documents").select(F.col("text").alias("value"))


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``text,yyyy-MM-ddTHH:mm:ss.SSS`` lines derived from ``events``: the event
    type and its time; every 50th line has a broken time."""
    use_utc(spark)
    return csv_from_events(read_table(spark, sf_dir, "events"))


def csv_from_events(ev: DataFrame) -> DataFrame:
    t = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    t = F.when(F.col("event_id") % BAD_EVERY == BAD_NO_FLAG, F.lit("bad")).otherwise(t)
    return ev.select(F.concat_ws(",", F.col("event_type"), t).alias("value"))
