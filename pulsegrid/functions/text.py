"""Text formatting and parsing: table time text, output lines, words, CSV lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrid.config import CSV_TIME_FORMAT, TABLE_TIME_FORMAT


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def table_time_text(eventtime: str | Column = "eventtime") -> Column:
    """``yyyy-MM-dd HH:mm:ss.SSS`` as stored in the time-series table."""
    return F.date_format(_col(eventtime), TABLE_TIME_FORMAT)


def java_time_text(ts: str | Column) -> Column:
    """A timestamp printed the way a JVM timestamp prints itself:
    ``2018-07-20 13:20:00.0``, ``2018-07-20 13:25:01.12`` (fraction without
    trailing zeros, at least one digit)."""
    full = F.date_format(_col(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, "0{1,5}$", "")


def null_text(c: Column) -> Column:
    """Null fields print as ``null`` in a concatenated line."""
    return F.coalesce(c, F.lit("null"))


def window_line(
    window: str | Column = "window",
    deviceid: str | Column = "deviceid",
    variableid: str | Column = "variableid",
    avg: str | Column = "avg_value",
) -> Column:
    """``[start,end],deviceid,variableid,avg`` for the windowed-average topic."""
    w = _col(window)
    bounds = F.concat(
        F.lit("["),
        null_text(java_time_text(w.getField("start"))),
        F.lit(","),
        null_text(java_time_text(w.getField("end"))),
        F.lit("]"),
    )
    return F.concat_ws(
        ",",
        bounds,
        null_text(_col(deviceid).cast("string")),
        null_text(_col(variableid).cast("string")),
        null_text(_col(avg).cast("string")),
    )


def session_line(
    deviceid: str | Column = "deviceid",
    start: str | Column = "activeStartTime",
    end: str | Column = "activeEndTime",
    state: str | Column = "deviceactive",
) -> Column:
    """``deviceid,start,end,state`` for the device-state topic."""
    return F.concat_ws(
        ",",
        null_text(_col(deviceid).cast("string")),
        null_text(java_time_text(start)),
        null_text(java_time_text(end)),
        null_text(_col(state)),
    )


def split_words(line: str | Column = "value") -> Column:
    """Split on single spaces the way a JVM ``String.split(" ")`` does: trailing
    empty strings are dropped, a line of only spaces gives no word, the empty
    line gives one empty word."""
    c = _col(line)
    trimmed = F.rtrim(c)
    return F.when(c.isNull(), F.array().cast("array<string>")).when(
        (trimmed == F.lit("")) & (c != F.lit("")), F.array().cast("array<string>")
    ).otherwise(F.split(trimmed, " "))


def csv_line_fields(line: str | Column = "value") -> tuple[Column, Column]:
    """``text,yyyy-MM-ddTHH:mm:ss.SSS`` to (text, timestamp); the time is null
    when it does not parse."""
    parts = F.split(_col(line), ",")
    text = F.get(parts, 0)
    ts = F.try_to_timestamp(F.get(parts, 1), F.lit(CSV_TIME_FORMAT))
    return text, ts
