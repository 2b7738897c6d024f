"""Numbers of rows by file and place in the file."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILE, START, SLOT = "_file", "_start", "_slot"


def with_position(scan: DataFrame) -> DataFrame:
    """Add the file, the start of the file's split and a number that ascends within the split."""
    return scan.select(
        "*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(START), F.monotonically_increasing_id().alias(SLOT)
    )


def numbered(positioned: DataFrame, out: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Rows numbered 1, 2, 3 … by file path and place in the file, over all files or within ``by``.

    Rows per split are counted first; a row's number is its place in its split plus the rows
    of the splits before. Only the counts, one row per split, meet in one place, so they are
    broadcast. The files are read twice and must not change in between. ``by`` must be the
    same on all rows of a file, as a partition folder is.
    """
    keys = [*by, FILE, START]
    runs = positioned.groupBy(*keys).agg(F.min(SLOT).alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy(FILE, START).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1
    offsets = runs.select(FILE, START, shift.alias("_shift"))
    joined = positioned.join(F.broadcast(offsets), [FILE, START])
    return joined.withColumn(out, F.col(SLOT) + F.col("_shift")).drop(FILE, START, SLOT, "_shift")
