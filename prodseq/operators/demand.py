"""Domestic and export demand rows with their urgency signals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.functions import case_of, clamp_at_zero, ratio, rim_size
from prodseq.plans.params import Params
from prodseq.plans.workspace import COPIES_PER_TASK

# Plant of the reports, market tokens, export market, top mark.
PLANT = "1300"
MARKET_OF_TOKEN = {"FG10": "RE", "OE10": "OE", "ST10": "ST"}
EXPORT_MARKET = "EXP"
TOP_MARK = "T"
REPLACEMENT_SHARE = 0.5


def domestic_signals(bor: DataFrame) -> DataFrame:
    """Market, target, requirement and penetration of the plant's SKU x location rows."""
    token = F.get(F.split("loc", "_"), F.lit(1))
    market = case_of(token, MARKET_OF_TOKEN).otherwise(token)
    norm, stock = F.col("virtual_norm"), F.col("stock")
    target = F.when(F.col("market") == "RE", norm * REPLACEMENT_SHARE).otherwise(norm)
    depletion = F.when(norm == 0, F.lit(0.0)).otherwise(ratio(norm - stock, norm) * 100)
    return (
        bor.filter(F.col("loc").startswith(PLANT) & F.col("sku").isNotNull())
        .withColumn("market", market)
        .withColumn("adjusted_target", target)
        .withColumns(
            {
                "requirement": clamp_at_zero(F.col("adjusted_target") - stock),
                "penetration": depletion,
            }
        )
    )


def marks_top_sku() -> Column:
    """Buffer rows of the plant that have a code."""
    return F.col("loc").startswith(PLANT) & F.col("sku").isNotNull()


def top_sku_marks(bpr: DataFrame) -> DataFrame:
    """Distinct top marks per SKU x location with the number of equal buffer rows.

    The buffer report is not unique on this key and each extra row repeats the
    demand row. Counting equal rows before the shuffle keeps the fan-out as a
    number, ``copies``, until ``expand_copies``.
    """
    return (
        bpr.filter(marks_top_sku())
        .groupBy("report_date", "sku", "loc", "top_sku")
        .agg(F.count("*").alias("copies"))
    )


def with_top_sku(domestic: DataFrame, bpr: DataFrame) -> DataFrame:
    """Left join of the top mark; fan-out is held in ``copies``."""
    joined = domestic.join(top_sku_marks(bpr), ["report_date", "sku", "loc"], "left")
    return joined.withColumn("copies", F.coalesce("copies", F.lit(1)))


def expand_copies(df: DataFrame, per_task: int = COPIES_PER_TASK) -> DataFrame:
    """Repeat each row ``copies`` times and drop the counter.

    Copies are made in blocks of at most ``per_task``. Rows with more are cut into
    blocks that are spread over the cluster, so no task emits more than one block
    of a row. ``_salt`` stays different for every row. The input is read twice, so it
    should be a written table.
    """
    big = F.col("copies") > per_task
    blocks = (
        df.filter(big)
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / per_task))))
        .withColumn("copies", F.least(F.lit(per_task), F.col("copies") - F.col("_block") * per_task))
    )
    salted = [F.col("_salt")] if "_salt" in df.columns else [F.col("sku")]
    spread = blocks.repartition(*salted, "_block")
    if "_salt" in df.columns:
        spread = spread.withColumn("_salt", F.xxhash64("_salt", "_block"))
    return _repeat(df.filter(~big)).unionByName(_repeat(spread.drop("_block")))


def _repeat(df: DataFrame) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies").cast("long")))
    repeated = df.withColumn("_copy", copy)
    if "_salt" in df.columns:
        repeated = repeated.withColumn("_salt", F.xxhash64("_salt", "_copy"))
    return repeated.drop("_copy", "copies")


def export_rows(bmr: DataFrame) -> DataFrame:
    """Export rows of the plant; requirement and penetration are taken as reported."""
    return bmr.filter((F.col("plant") == PLANT) & F.col("sku").isNotNull()).select(
        "report_date",
        "sku",
        F.lit(EXPORT_MARKET).alias("market"),
        F.lit(None).cast("double").alias("adjusted_target"),
        "requirement",
        "penetration",
        F.lit(TOP_MARK).alias("top_sku"),
        F.lit(1).cast("long").alias("copies"),
    )


def combined_demand(domestic: DataFrame, export: DataFrame) -> DataFrame:
    """Export rows and domestic rows with an open or unknown requirement."""
    both = export.unionByName(domestic, allowMissingColumns=True)
    return both.filter(~F.col("requirement").eqNullSafe(F.lit(0.0)))


def with_market_columns(df: DataFrame, params: Params) -> DataFrame:
    """Rim size, market weight (missing for an unknown market) and top flag."""
    return df.withColumns(
        {
            "size": rim_size(F.col("sku")),
            "market_weight": case_of(F.col("market"), params.market_weights),
            "top_flag": F.when(F.col("top_sku") == TOP_MARK, 1).otherwise(0),
        }
    )
