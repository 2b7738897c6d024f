"""Figures of the executive summaries, one row per date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodseq.operators.override import AUTOMATED, BOOST_BASE, MANUAL
from prodseq.operators.ranking import tie_break


def _flag_counts() -> list[Column]:
    return [
        F.count_if("critical_gap").alias("critical_gaps"),
        F.count_if("excess_production").alias("excess_production"),
        F.count_if("mould_alert").alias("mould_alerts"),
    ]


def stage2_summary(gaps: DataFrame) -> DataFrame:
    machines = F.col("machine_count")
    return gaps.groupBy("report_date").agg(
        *_flag_counts(),
        F.count_if("is_ghost").alias("ghost_skus"),
        F.count_if(machines > 0).alias("in_production"),
        F.count_if(machines == 0).alias("not_in_production"),
        F.count("*").alias("rows_analyzed"),
    )


def stage3_summary(final: DataFrame) -> DataFrame:
    """Also counts automated rows whose score reaches the floor of manual rows."""
    manual, automated = F.col("source") == MANUAL, F.col("source") == AUTOMATED
    machines = F.col("machine_count")
    return final.groupBy("report_date").agg(
        F.count_if(manual).alias("manual_entries"),
        F.count_if(manual & (F.col("highest_priority") == 1)).alias("highest_priority"),
        F.count_if(automated & (machines > 0)).alias("in_production"),
        F.count_if(automated & (machines == 0)).alias("not_in_production"),
        *_flag_counts(),
        F.count_if("is_overstock").alias("overstock"),
        F.count_if(automated & (F.col("consolidated") >= BOOST_BASE)).alias(
            "automated_above_manual_floor"
        ),
        F.count("*").alias("rows_in_sequence"),
    )


def proxy_range(gaps: DataFrame) -> DataFrame:
    return gaps.groupBy("report_date").agg(
        F.min("proxy").alias("lowest"), F.max("proxy").alias("highest")
    )


def top_rows(gaps: DataFrame, n: int, where: Column | None = None) -> DataFrame:
    """The first n rows of each date by demand rank; tasks keep n rows of a date each."""
    rows = gaps if where is None else gaps.filter(where)
    order = Window.partitionBy("report_date").orderBy(F.col("demand_rank").asc_nulls_last(), *tie_break(rows))
    return rows.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n).drop("_place")

