"""Written intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseq.llm.shipping import send_package

#: Rows of numbers that every task may hold: about 10 MB as a hash table.
FEW = 1 << 17


def met(side: DataFrame, rows: int | None = None) -> DataFrame:
    """A side of a join that is broadcast if ``rows``, its counted rows, are few, and else merged.

    Spark sizes a side by its compressed files and takes an array for one element, also after
    an explode; so it may broadcast a table that the driver cannot hold. Sides that grow with
    the input are given here. Counted rows must be of a few numbers, without texts.
    """
    return F.broadcast(side) if rows is not None and rows <= FEW else side.hint("merge")


class Scratch:
    """A folder below ``spark.checkpoint.dir`` for the written tables of one operator call.

    A written table cuts lineage and survives lost executors. The folder goes when the
    session's JVM ends; ``drop`` frees a table earlier. Where the setting is missing a
    local session (tests) gets a temporary folder and a cluster gets an error.
    """

    def __init__(self, spark: SparkSession, name: str):
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="prodseq-llm-")
        send_package(spark)
        self.spark = spark
        self.root = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self._count = 0
        path, system = self._file_system(self.root)
        system.deleteOnExit(path)

    def _file_system(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def write(self, frame: DataFrame, name: str) -> DataFrame:
        """Write a frame once and return it as read back."""
        self._count += 1
        path = f"{self.root}/{self._count:03d}-{name}"
        frame.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(frame.schema).parquet(path)
        back._scratch_path = path
        return back

    def drop(self, frame: DataFrame | None) -> None:
        """Delete a written table that nothing reads any more."""
        path = getattr(frame, "_scratch_path", None)
        if path:
            at, system = self._file_system(path)
            system.delete(at, True)
