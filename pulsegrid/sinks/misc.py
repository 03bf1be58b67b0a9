"""Console and CSV file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def console_writer(
    df: DataFrame, checkpoint: str, output_mode: str = "update", num_rows: int = 10, truncate: bool = False
) -> StreamingQuery:
    """Print each micro-batch (development aid)."""
    return (
        df.writeStream.format("console")
        .outputMode(output_mode)
        .option("truncate", str(truncate).lower())
        .option("numRows", str(num_rows))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def csv_file_writer(df: DataFrame, path: str, checkpoint: str, trigger_available_now: bool = False) -> StreamingQuery:
    """Append rows as CSV files (exactly once through the file sink's log)."""
    writer = (
        df.writeStream.format("csv")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
