"""Stock-out severity per product from the buffer colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.functions import case_of
from prodseq.plans.params import LOCATION_TYPES, Params

# Colours that count as stock-out.
COLOURS = ["Black", "Red"]


def is_stock_out() -> Column:
    """Black and Red buffer rows with complete keys."""
    return F.col("colour").isin(COLOURS) & F.col("sku").isNotNull() & F.col("location_type").isNotNull()


def flagged_buffers(bpr: DataFrame) -> DataFrame:
    """Rows that count as stock-out, with one spelling of ``Depot``."""
    place = F.col("location_type")
    return bpr.filter(is_stock_out()).withColumn("location_type", F.when(place == "depot", "Depot").otherwise(place))


def colour_counts(bpr: DataFrame) -> DataFrame:
    """Rows per product, location type and colour."""
    keys = ["report_date", "sku", "location_type", "colour"]
    return flagged_buffers(bpr).groupBy(*keys).agg(F.count("*").alias("n"))


def colour_pivot(bpr: DataFrame) -> DataFrame:
    """One row per product, one 0-filled count column per colour and known location type."""
    cells = [f"{c} Count_{place}" for c in COLOURS for place in LOCATION_TYPES]
    cell = F.concat("colour", F.lit(" Count_"), "location_type")
    counted = (
        flagged_buffers(bpr)
        .withColumn("cell", cell)
        .groupBy("report_date", "sku")
        .pivot("cell", cells)
        .count()
    )
    return counted.na.fill(0, cells)


def inventory_score(bpr: DataFrame, params: Params) -> DataFrame:
    """Sum of location weight x colour factor per product.

    One partial aggregation per product; a location type without a weight adds 0.
    """
    factor = F.when(F.col("colour") == "Black", F.lit(float(params.black_factor))).otherwise(
        F.lit(float(params.red_factor))
    )
    weight = case_of(F.col("location_type"), params.location_weights)
    score = F.sum(F.coalesce(weight * factor, F.lit(0.0))).alias("inventory")
    return flagged_buffers(bpr).groupBy("report_date", "sku").agg(score)
