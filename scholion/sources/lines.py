"""Text files as numbered lines.

Spark reads a file in byte ranges, and a task knows only its own. The rows of a range lie side by
side in its task, so a line's place in the range is its distance from the range's first row; the
numbers of lines in the ranges before it make up the rest. Only one row per range is ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Ranges whose sizes are sent to all tasks; with more of them lines and sizes meet in a shuffle.
SENT_RANGES = 1_000_000


def read_lines(spark: SparkSession, path: str | list[str], sent_ranges: int = SENT_RANGES) -> DataFrame:
    """(file, line, value) of all text files at a path; lines count from 1, blank ones too."""
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_row"), "value")
    ranges = rows.groupBy("file", "_range").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranges.select("file", "_range", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    few = ranges.limit(sent_ranges + 1).count() <= sent_ranges
    joined = rows.join(F.broadcast(placed) if few else placed, ["file", "_range"])
    return joined.select("file", (F.col("_before") + F.col("_row") - F.col("_first") + 1).alias("line"), "value")
