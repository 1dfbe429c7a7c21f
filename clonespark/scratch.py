"""Tables written to the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it.

    Only a local session without one (as in tests) gets a temporary folder: elsewhere executors wouldn't share it.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir")
    if not found:
        current = context._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="clonespark-")
        context.setCheckpointDir(found)
    return found


class Scratch:
    """Tables written to the shared folder, to cut lineage and to compute a costly step once.

    A written table survives the loss of any executor. What is left of a Scratch goes when the driver ends.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/clonespark-{uuid.uuid4().hex}"
        self.count = 0

    def path(self, name: str = "") -> str:
        """A path for a table or file of its own, which goes when the driver ends."""
        self.count += 1
        if self.count == 1:
            files = self._files(self.root)
            files.mkdirs(self._path(self.root))
            files.deleteOnExit(self._path(self.root))
        return f"{self.root}/{self.count}{name}"

    def put(self, path: str, content: bytes) -> None:
        """A small file, written by the driver."""
        out = self._files(path).create(self._path(path))
        out.write(content)
        out.close()

    def save(self, df: DataFrame) -> DataFrame:
        path = self.path()
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        self._files(df._scratch_path).delete(self._path(df._scratch_path), True)

    def clear(self) -> None:
        """Delete all tables, once nothing reads them any more."""
        self._files(self.root).delete(self._path(self.root), True)
