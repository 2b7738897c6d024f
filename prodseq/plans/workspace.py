"""Written intermediate tables.

A frame that feeds several branches, or that must not change between two reads
(rank offsets), is written once as Parquet under the shared folder named by
``spark.checkpoint.dir``. Columnar files are pruned on re-read, survive the
loss of executors and give Catalyst true sizes, so it chooses broadcast or
sort-merge joins from what was written rather than from guesses.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Distinct scores of a date that one task puts in order, about; it takes a second or so.
SLICE_ROWS = 250_000

# Copies of a row are made in blocks of at most this many; blocks beyond a row's first
# are spread over tasks.
COPIES_PER_TASK = 100_000

SALT = "_salt"


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    master = spark.conf.get("spark.master", "")
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="prodseq-")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


@dataclass
class Workspace:
    """Folder of one run, and the sizes of the parts that work is cut into."""

    spark: SparkSession
    slice_rows: int = SLICE_ROWS
    copies_per_task: int = COPIES_PER_TASK
    root: str = field(default="")

    def __post_init__(self) -> None:
        if not self.root:
            self.root = f"{_shared_folder(self.spark).rstrip('/')}/prodseq-{uuid.uuid4().hex}"
        path, fs = self._file_system()
        fs.deleteOnExit(path)  # also where nothing calls release, as in queries

    def path(self, label: str) -> str:
        return f"{self.root}/{label}-{uuid.uuid4().hex[:8]}"

    def write(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and return a scan of it."""
        path = self.path(label)
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_measured(
        self, df: DataFrame, label: str, **measures: Column
    ) -> tuple[DataFrame, dict[str, Any]]:
        """As ``write``, with aggregates over the rows taken during the same pass.

        A task that runs twice may count twice, so sums are upper bounds.
        """
        seen = Observation()
        named = [c.alias(n) for n, c in measures.items()]
        return self.write(df.observe(seen, *named), label), seen.get

    @staticmethod
    def salted(scan: DataFrame) -> DataFrame:
        """Add a hash that differs per row and is the same on every read of the table."""
        row = F.xxhash64("_metadata.file_path", "_metadata.row_index")
        return scan.select("*", row.alias(SALT))

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.release()

    def release(self) -> None:
        """Delete this run's intermediate tables; results read from them end with it."""
        path, fs = self._file_system()
        fs.delete(path, True)

    def _file_system(self) -> tuple[Any, Any]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
