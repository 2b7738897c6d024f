"""Which dates can be run."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseq.sources.reports import DAILY, Report, matching_paths


def report_files(
    spark: SparkSession, base: str, reports: Iterable[Report] = tuple(DAILY)
) -> DataFrame:
    """Report date and kind of every landed file, from the listing alone."""
    listings = [_listing(spark, base, r) for r in reports]
    return reduce(DataFrame.unionByName, listings).distinct()


def _listing(spark: SparkSession, base: str, report: Report) -> DataFrame:
    path = f"{base}/{report.glob()}"
    if not matching_paths(spark, path):
        return spark.createDataFrame([], "report_date date, kind string")
    # Only the path column is asked for, so no file is opened.
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        report.date_in(F.col("path")).alias("report_date"), F.lit(report.kind).alias("kind")
    )


def complete_dates(files: DataFrame, kinds: int = len(DAILY)) -> DataFrame:
    """Dates for which every kind of daily report has landed."""
    return (
        files.filter(F.col("report_date").isNotNull())
        .groupBy("report_date")
        .agg(F.count_distinct("kind").alias("n"))
        .filter(F.col("n") == kinds)
        .select("report_date")
    )


def date_range(spark: SparkSession, start: date, end: date) -> DataFrame:
    """Every day from start to end, both included."""
    span = F.sequence(F.lit(start), F.lit(end))
    days = spark.range(1).select(F.explode(span).alias("report_date"))
    return days if start <= end else days.limit(0)


def runnable_dates(spark: SparkSession, base: str, start: date, end: date) -> list[date]:
    """Complete dates of a range, in order; at most one per calendar day."""
    complete = complete_dates(report_files(spark, base))
    days = date_range(spark, start, end).join(complete, "report_date", "left_semi")
    return [r["report_date"] for r in days.orderBy("report_date").collect()]
