"""Report sinks: one folder per date, rows in report order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prodseq.operators.ranking import tie_break
from prodseq.plans.layouts import to_report
from prodseq.sources.places import FILE, SLOT, START, numbered, with_position


def write_report(
    rows: DataFrame, layout: dict[str, str], path: str, rank: str, fmt: str = "parquet"
) -> None:
    """Write ranked rows under the layout's names, in rank order within each date.

    Equal ranks follow the usual order of ties. Range partitioning keeps every file
    a contiguous slice of the sequence and lets a large date use many tasks; it samples
    its input, so ``rows`` should be a written table. Dates written before are replaced,
    other dates stay. CSV holds the priority tuple as text, and quotes doubled.
    """
    order = [F.col("report_date"), F.col(rank).asc_nulls_last(), *tie_break(rows)]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    report = to_report(ordered, layout)
    if fmt == "csv" and "priority" in report.columns:
        report = report.withColumn("priority", F.col("priority").cast("string"))
    writer = (
        report.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_date")
        .format(fmt)
    )
    if fmt == "csv":
        writer = writer.options(
            header="true", escape='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false"
        )
    writer.save(path)


def _scan(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """A written report with the file and split of each row; CSV cells are texts."""
    options = {"header": "true", "escape": '"'} if fmt == "csv" else {}
    scan = with_position(spark.read.format(fmt).options(**options).load(path))
    return scan.withColumn("report_date", F.col("report_date").cast("date"))


def read_report(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A written report, each row with its ``place`` in the files of its date."""
    return numbered(_scan(spark, path, fmt), "place", ("report_date",))


def order_faults(spark: SparkSession, path: str, rank: str, fmt: str = "parquet") -> DataFrame:
    """(report_date, rows, files_out_of_order, rows_out_of_order) of a written report.

    A file is out of order if it starts below the rank that an earlier one of its date
    ends with, a row if it stands below the row before it in its file. Missing ranks go
    last. Each file is looked at by itself; one row per file is compared over a date.
    """
    scan = _scan(spark, path, fmt)
    held = F.coalesce(F.col(f"`{rank}`").cast("long"), F.lit((1 << 63) - 1))
    ranked = scan.select("report_date", FILE, START, SLOT, held.alias("_rank"))
    in_file = Window.partitionBy("report_date", FILE).orderBy(START, SLOT)
    stepped = ranked.withColumn("_down", F.coalesce(F.lag("_rank").over(in_file) > F.col("_rank"), F.lit(False)))
    files = stepped.groupBy("report_date", FILE).agg(
        F.count("*").alias("_n"), F.count_if("_down").alias("_downs"), F.min("_rank").alias("_lowest"), F.max("_rank").alias("_highest")
    )
    earlier = Window.partitionBy("report_date").orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    late = files.withColumn("_late", F.coalesce(F.max("_highest").over(earlier) > F.col("_lowest"), F.lit(False)))
    return late.groupBy("report_date").agg(
        F.sum("_n").alias("rows"), F.count_if("_late").alias("files_out_of_order"), F.sum("_downs").alias("rows_out_of_order")
    )
