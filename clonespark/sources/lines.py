"""Lines of text files with their numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line (from 0 within its file) and value.

    Splits of a file are read in any order; the lines of each are counted first (a row for each split), so that numbers don't depend on
    how Spark deals splits to tasks.
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    splits = text.groupBy("file", "start").agg(F.min("n").alias("low"), F.count("*").alias("size"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # Joined by value, all lines of a file would be sorted in one task; there is one row for each split.
    offsets = splits.select("file", "start", (F.coalesce(F.sum("size").over(before), F.lit(0)) - F.col("low")).alias("shift"))
    return text.join(F.broadcast(offsets), ["file", "start"]).select("file", (F.col("n") + F.col("shift")).alias("line"), "value")
