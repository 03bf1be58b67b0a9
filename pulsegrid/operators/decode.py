"""Message decoding: cast, route by key flag, parse JSON, flatten, explode.

All of it is column expressions and one generator, so a decode is a single
map-only stage (no shuffle) that Catalyst can prune and push filters through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import EVENT_FLAG, READING_FLAG
from pulsegrid.functions.routing import message_flag
from pulsegrid.schemas import EVENT, EVENT_MESSAGE, READING, READING_MESSAGE

# Fixed texts of the malformed output (our own).
REASON_BAD_KEY = "key has no integer flag"
REASON_BAD_READING = "reading is not parsable"
REASON_BAD_VALUE = "reading value is not a number"
REASON_BAD_TIME = "reading time is before 1970"
REASON_BAD_EVENT = "event is not parsable"


def _time_ok(eventtime: Column) -> Column:
    """A time before 1970 has no row key (its reverse time overflows)."""
    return F.unix_millis(eventtime) >= 0


def cast_messages(raw: DataFrame) -> DataFrame:
    """Binary ``key``/``value`` (as a broker delivers them) cast to text;
    other columns (e.g. ``seq``) pass through."""
    rest = [c for c in raw.columns if c not in ("key", "value")]
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        *rest,
    )


def route(messages: DataFrame, flag: int) -> DataFrame:
    """Messages whose key flag (second comma field) equals ``flag``."""
    return messages.filter(message_flag("key") == F.lit(flag))


def parse_once(df: DataFrame, parsed: Column, name: str, keep: list[str] | None = None) -> DataFrame:
    """Add ``parsed`` (e.g. a ``from_json``) as column ``name``, evaluated once
    per row.

    Catalyst substitutes a projected expression into every filter pushed below
    the projection, so ``select(from_json(..) as j).filter(j.a is not null and
    j.b is not null)`` parses each message once per condition. Producing the
    column from a one-element ``inline`` makes it generator output, which
    filters cannot be pushed beneath.
    """
    cols = keep if keep is not None else df.columns
    return df.select(*cols, F.inline(F.array(F.struct(parsed.alias(name)))))


def _reading_json() -> Column:
    return F.from_json(F.col("value"), READING_MESSAGE)


def _event_json() -> Column:
    return F.from_json(F.col("value"), EVENT_MESSAGE)


def _header_ok(j: Column) -> Column:
    h = j.getField("header")
    return j.isNotNull() & h.getField("deviceid").isNotNull() & h.getField("eventtime").isNotNull()


def decode_readings(messages: DataFrame) -> DataFrame:
    """Reading messages (flag 1) to one row per value:
    ``name, timeseries, connectorid, deviceid, eventtime, variableid, value``.

    Messages without a parsable header or with a time before 1970, and values
    that are not numbers, are left out here and reported by :func:`malformed_messages`. An absent or
    empty value list yields no row.
    """
    j = parse_once(route(messages, READING_FLAG), _reading_json(), "j", keep=[])
    return flatten_readings(j.select("j.*"))


def flatten_readings(parsed: DataFrame) -> DataFrame:
    """Parsed reading messages (``name, header, iotdata``) to one row per value."""
    j = parsed.filter(_header_ok(F.struct("header")) & _time_ok(F.col("header.eventtime")))
    exploded = j.select(
        "name",
        F.col("header.timeseries").cast("int").alias("timeseries"),
        F.col("header.connectorid").alias("connectorid"),
        F.col("header.deviceid").alias("deviceid"),
        F.col("header.eventtime").alias("eventtime"),
        F.explode("iotdata.values").alias("v"),
    )
    out = exploded.select(
        "name",
        "timeseries",
        "connectorid",
        "deviceid",
        "eventtime",
        F.col("v.variableid").alias("variableid"),
        F.col("v.value").try_cast("double").alias("value"),
    )
    # typed view: the declared reading schema, column order and types checked
    return out.filter(F.col("value").isNotNull()).to(READING)


def decode_events(messages: DataFrame, seq_col: str | None = "seq") -> DataFrame:
    """Status messages (flag 0) to ``connectorid, deviceid, eventtime, status, seq``.

    ``seq`` (the broker offset, or any arrival order) breaks ties in event time;
    without it the column is null.
    """
    seq = F.col(seq_col).cast("bigint") if seq_col and seq_col in messages.columns else F.lit(None).cast("bigint")
    routed = route(messages, EVENT_FLAG).select("value", seq.alias("seq"))
    j = parse_once(routed, _event_json(), "j", keep=["seq"])
    j = j.filter(_header_ok(F.col("j")) & F.col("j.values.status").isNotNull())
    return j.select(
        F.col("j.header.connectorid").alias("connectorid"),
        F.col("j.header.deviceid").alias("deviceid"),
        F.col("j.header.eventtime").alias("eventtime"),
        F.col("j.values.status").alias("status"),
        F.col("seq"),
    ).to(EVENT)


def malformed_messages(messages: DataFrame) -> DataFrame:
    """Messages the decoders leave out, one row per reason:
    ``key, value, [seq,] reason``.

    Reasons: key without an integer flag; reading or event without a parsable
    header (device id, event time; events also need a status); reading time
    before 1970; reading value that is not a number (one row per such value). Keys with another integer
    flag are ignored, as are readings with no values.
    """
    flag = message_flag("key")
    rj = F.when(F.col("_flag") == READING_FLAG, _reading_json())
    ej = F.when(F.col("_flag") == EVENT_FLAG, _event_json())
    passthrough = [c for c in messages.columns if c not in ("key", "value")]
    flagged = messages.select("key", "value", *passthrough, flag.alias("_flag"))
    parsed = parse_once(
        flagged,
        F.struct(rj.alias("r"), ej.alias("e")),
        "_p",
    ).select("key", "value", *passthrough, "_flag", F.col("_p.r").alias("_rj"), F.col("_p.e").alias("_ej"))
    bad_values = F.filter(
        F.coalesce(F.col("_rj.iotdata.values"), F.array().cast("array<struct<variableid:string,value:string>>")),
        lambda v: v.getField("value").try_cast("double").isNull(),
    )
    reasons = F.array(
        F.when(F.col("_flag").isNull(), F.lit(REASON_BAD_KEY)),
        F.when((F.col("_flag") == READING_FLAG) & ~_header_ok(F.col("_rj")), F.lit(REASON_BAD_READING)),
        F.when(
            (F.col("_flag") == READING_FLAG) & _header_ok(F.col("_rj")) & ~_time_ok(F.col("_rj.header.eventtime")),
            F.lit(REASON_BAD_TIME),
        ),
        F.when(
            (F.col("_flag") == EVENT_FLAG)
            & ~(_header_ok(F.col("_ej")) & F.col("_ej.values.status").isNotNull()),
            F.lit(REASON_BAD_EVENT),
        ),
    )
    value_reasons = F.when(
        (F.col("_flag") == READING_FLAG) & _header_ok(F.col("_rj")),
        F.transform(bad_values, lambda v: F.lit(REASON_BAD_VALUE)),
    )
    all_reasons = F.concat(
        F.filter(reasons, lambda r: r.isNotNull()),
        F.coalesce(value_reasons, F.array().cast("array<string>")),
    )
    return parsed.select("key", "value", *passthrough, F.explode(all_reasons).alias("reason"))
