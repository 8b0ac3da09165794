"""Text-line source (S1): one record per line, optionally redistributed or numbered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spreadkit.runtime import fits_broadcast, stored

# a path, a position and two numbers
SPLIT_ROW_BYTES = 256


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """``value string`` per line; blank lines are kept (unlike the CSV reader).

    ``partitions`` redistributes the lines round-robin into that many balanced
    partitions, as the reference does before its per-partition rounds.
    """
    lines = spark.read.text(path)
    return lines.repartition(partitions) if partitions else lines


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line_id, value``: lines with their number, from 0, in the order of the
    files' paths and of the lines in a file.

    A first scan (of no column) counts the lines of each split of a file; the
    splits' prefix sums, one row a split, give where each begins; a second scan
    adds a line's place within its split. Lines are not shuffled while one row a
    split can be broadcast. The files must not change in between.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("m"),
    )
    splits = stored(lines.groupBy("file", "at").agg(F.count(F.lit(1)).alias("n"), F.min("m").alias("first")), "splits")
    earlier = Window.orderBy("file", "at").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "at", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    if fits_broadcast(spark, splits.count(), SPLIT_ROW_BYTES):
        starts = F.broadcast(starts)
    return lines.join(starts, ["file", "at"]).select((F.col("m") + F.col("shift")).alias("line_id"), "value")
