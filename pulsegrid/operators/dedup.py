"""Exact duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pulsegrid.config import DEDUP_COLUMNS, EVENT_DEDUP_COLUMNS, EVENT_DEDUP_WATERMARK


def drop_duplicate_readings(
    readings: DataFrame,
    watermark: str | None = None,
    columns: Sequence[str] = DEDUP_COLUMNS,
    include_result: bool = False,
) -> DataFrame:
    """Drop readings equal on the seven key columns.

    On a stream pass ``watermark`` (the reference uses ``10 minutes``): state is
    kept per key until the watermark passes its event time. ``result`` depends
    only on device, connector and the metadata snapshot, so it never differs
    inside a duplicate group; ``include_result=True`` adds it to the key, which
    lets Catalyst push a later good/error filter below the de-duplication in
    batch plans.
    """
    cols = list(columns)
    if include_result and "result" in readings.columns:
        cols.append("result")
    df = readings.withWatermark("eventtime", watermark) if watermark else readings
    return df.dropDuplicates(cols)


def drop_duplicate_events(
    events: DataFrame,
    watermark: str = EVENT_DEDUP_WATERMARK,
    columns: Sequence[str] = EVENT_DEDUP_COLUMNS,
) -> DataFrame:
    """Status events de-duplicated on ``columns`` within the watermark delay
    (disabled in the reference as it merges later legitimate events that lack
    the event time in the key; offered as an option only). The watermark
    delay has a meaning on streams only, so a batch table is refused."""
    if not events.isStreaming:
        raise ValueError("event de-duplication within a watermark needs a stream")
    return events.withWatermark("eventtime", watermark).dropDuplicatesWithinWatermark(list(columns))
