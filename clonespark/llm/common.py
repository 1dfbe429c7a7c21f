"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clonespark.scratch import Scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the tables of a data folder; the path may be in any store Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes of Parquet files up to which a table is broadcast; it takes several times that in memory.
BROADCAST_BYTES = 8 << 20


def fits(saved: DataFrame, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table that Scratch.save wrote is small enough to be broadcast."""
    spark, path = saved.sparkSession, saved._scratch_path
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength() <= most_bytes


def sized(df: DataFrame, scratch: Scratch, most_rows: int = 500_000) -> DataFrame:
    """A narrow table for the other side of a join, written once and measured: broadcast up to most_rows and BROADCAST_BYTES, shuffled beyond."""
    out = df if hasattr(df, "_scratch_path") else scratch.save(df)
    return F.broadcast(out) if fits(out) and out.count() <= most_rows else out


#: Bytes of a batch that goes to Python, unless the session says otherwise. Spark's own 64 MB take several times that of an executor for each task.
BATCH_BYTES, BATCH_SETTING, BATCH_DEFAULT = 8 << 20, "spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "67108864")


def bound_batches(spark: SparkSession) -> None:
    """Sets the bytes of a batch for the session, if they are as Spark comes. Spark looks at the setting when a plan is run."""
    if spark.conf.get(BATCH_SETTING, BATCH_DEFAULT[0]) in BATCH_DEFAULT:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def release_memory() -> None:
    """Gives back to the system what a worker has freed: workers live on, idle or with other work, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc
        trim(0)


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str) -> DataFrame:
    """Run a function from an Arrow batch to columns over each batch of a DataFrame.

    Spark bounds a batch by rows and by bytes (see bound_batches), so memory doesn't grow with the partition.
    """
    from pyspark.sql.types import StructType, _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema

    bound_batches(df.sparkSession)
    kinds = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = pa.RecordBatch.from_arrays([_as(x, f.type) for x, f in zip(function(batch), arrow, strict=True)], schema=arrow)
                release_memory()
                yield out

    return df.mapInArrow(run, kinds)


def column_function(function: Callable[[pa.Array], pa.Array | list], kind: str) -> Callable[[str], Column]:
    """A column function from a function of an Arrow array of texts as UTF-8 bytes (null: empty) to values, or for a struct to one list of values for each field.

    The other columns of a row don't go through Python. Batches are bounded as in map_batches.
    """
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    bound_batches(SparkSession.active())
    arrow = to_arrow_type(_parse_datatype_string(kind))

    def run(texts: pa.Array) -> pa.Array:
        out = function(texts) if len(texts) else [[] for _ in arrow] if pa.types.is_struct(arrow) else []
        if pa.types.is_struct(arrow):
            out = pa.StructArray.from_arrays([_as(x, f.type) for x, f in zip(out, arrow, strict=True)], fields=list(arrow))
        release_memory()
        return _as(out, arrow)

    run.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    made = F.arrow_udf(run, kind)
    return lambda column: made(utf8(column))


def _as(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def utf8(column: str = "text") -> F.Column:
    """Whole text as UTF-8 bytes; null is the empty text."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary or string Arrow array end to end, and the n + 1 offsets of its values. No nulls."""
    width = np.int64 if array.type in (pa.large_binary(), pa.large_string()) else np.int32
    _, offsets, data = array.buffers()
    starts = np.frombuffer(offsets, width)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[starts[0] : starts[-1]], starts - starts[0]
