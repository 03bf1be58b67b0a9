"""Line de-duplication by overlapping three-line windows.

Every run of three consecutive lines of a text is hashed (128 bits). A window that occurs
again, anywhere in the table, keeps its first occurrence, by id and line; the
lines that later occurrences cover are removed. Overlapping and adjacent
covered stretches are merged into intervals per document, and a document's
text is put together from the stretches between them. All steps are DataFrame functions.

Occurrences are counted and their first place is found by a partial
aggregate, so a window that stands in a third of all rows costs one row per
task. Later occurrences are found by a join with the repeated windows only, which are
stored first: both sides are then plain shuffles, of which adaptive execution splits a hot window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.common import stored

LINES = 3


def _windows(lines: Column) -> Column:
    """Structs (i, a, b): place and hash of every window with a line that is not
    blank. ``lines`` must be a stored column: lambdas would split a text anew
    for each element."""
    n = F.size(lines)
    runs = F.slice(F.arrays_zip(*[F.slice(lines, k + 1, n) for k in range(LINES)]), 1, F.greatest(n - LINES + 1, F.lit(0)))

    def window(run: Column, i: Column) -> Column:
        parts = [run[str(k)] for k in range(LINES)]
        blank = F.trim(F.concat(*parts), F.lit(" \t\r\x0b\x0c")) == ""
        return F.when(~blank, F.struct(i.alias("i"), F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(LINES), *parts).alias("b")))

    return F.filter(F.transform(runs, window), lambda w: w.isNotNull())


def repeated_stretches(docs: DataFrame) -> DataFrame:
    """``doc_id, tie, first, last``: merged stretches of lines (from 0) that
    later occurrences cover. ``docs``: ``doc_id, tie, lines``."""
    found = stored(
        docs.select("doc_id", "tie", F.explode(_windows(F.col("lines"))).alias("w")).select("doc_id", "tie", "w.i", "w.a", "w.b"),
        "line-windows",
    )
    place = F.struct("doc_id", "tie", "i")
    repeated = stored(
        found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
        .filter("n > 1").select("a", "b", "first"),
        "line-repeats",
    )
    later = found.join(repeated, ["a", "b"]).filter(~place.eqNullSafe(F.col("first"))).select("doc_id", "tie", "i")
    by_doc = Window.partitionBy("doc_id", "tie").orderBy("i")
    opens = F.coalesce((F.col("i") > F.lag("i").over(by_doc) + LINES).cast("int"), F.lit(1))
    upto = by_doc.rowsBetween(Window.unboundedPreceding, 0)
    stretch = later.withColumn("opens", opens).withColumn("stretch", F.sum("opens").over(upto))
    return stretch.groupBy("doc_id", "tie", "stretch").agg(
        F.min("i").alias("first"), (F.max("i") + LINES - 1).alias("last")
    ).drop("stretch")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` for every row of ``docs``.

    Lines end at a line feed; windows of blank lines only do not count; a
    text of fewer than three lines has no window and stays. A null text has no lines and stays
    null; a text whose lines all go becomes empty. The first occurrence is
    the one with the least id (null first), then the least hash of the text,
    then the first line. Rows that repeat id and text are one document given
    several times: they are treated alike and do not remove each other. An empty
    table gives an empty result. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tie"),
        F.split(F.col(text_col).cast("string"), "\n", -1).alias("lines"),
    )
    stretches = repeated_stretches(rows).groupBy(
        F.col("doc_id").alias("_id"), F.col("tie").alias("_tie")
    ).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("gone"))  # within one document
    joined = rows.join(stretches, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")), "left")
    lines, gone = F.col("lines"), F.col("gone")

    def kept(k: Column) -> Column:
        start = F.when(k > 0, F.element_at(gone, k)["last"] + 1).otherwise(F.lit(0))
        end = F.when(k < F.size(gone), F.element_at(gone, F.least(k + 1, F.size(gone)))["first"]).otherwise(F.size(lines))
        return F.slice(lines, start + 1, end - start)

    rest = F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), kept))
    removed = F.aggregate(gone, F.lit(0), lambda n, s: n + s["last"] - s["first"] + 1)
    return joined.select(
        "doc_id",
        F.when(lines.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.when(gone.isNotNull(), F.concat_ws("\n", rest)).when(lines.isNotNull(), F.concat_ws("\n", lines)).alias("text"),
    )
