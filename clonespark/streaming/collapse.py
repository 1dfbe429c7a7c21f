"""Read counts of sequences, kept up to date as files of reads arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

READS = "full_NT string, isotype string, readcount bigint"


def read_stream(spark: SparkSession, folder: str, schema: str = READS, files_per_batch: int = 16) -> DataFrame:
    """Delimited files that arrive in a folder."""
    return spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files_per_batch).csv(folder)


def running_counts(reads: DataFrame) -> DataFrame:
    """Read counts by sequence and isotype over all that has arrived."""
    return reads.groupBy("full_NT", "isotype").agg(F.sum("readcount").alias("readcount"))


def windowed_counts(reads: DataFrame, time_col: str, width: str, late: str) -> DataFrame:
    """Read counts by window of arrival; state older than the watermark is dropped."""
    return reads.withWatermark(time_col, late).groupBy(F.window(time_col, width), "full_NT", "isotype").agg(F.sum("readcount").alias("readcount"))


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The whole table after each batch, written over the one before."""
    return counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(path)).trigger(availableNow=True).start()
