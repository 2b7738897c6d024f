"""Price and capacity of a product."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseq.functions import number, ratio, rounded
from prodseq.plans.params import Params

# Plant number in the dispatch list, minutes per day, handling minutes per cycle.
DISPATCH_PLANT = 1300
MINUTES_PER_DAY = 1440
HANDLING_MINUTES = 2.5


def asp_by_sku(dispatch: DataFrame, params: Params) -> DataFrame:
    """Mean of the line prices of the plant, per product.

    Thousands commas are removed from the amount only; a quantity with a comma
    is not a number and its line is left out, like a line with quantity 0.
    """
    amount = number(F.replace(F.col("amount"), F.lit(","), F.lit("")))
    price = ratio(amount, number(F.col("quantity")))
    return (
        dispatch.filter((F.col("plant") == DISPATCH_PLANT) & F.col("sku").isNotNull())
        .groupBy("sku")
        .agg(F.avg(price).alias("asp"))
        .withColumn("asp", rounded(F.col("asp"), params.asp_scale))
    )


def cure_time_by_sku(curing: DataFrame) -> DataFrame:
    """Longest cure time per product."""
    return (
        curing.filter(F.col("sku").isNotNull())
        .groupBy("sku")
        .agg(F.max("cure_time").alias("cure_time"))
    )


def with_revenue(df: DataFrame, params: Params) -> DataFrame:
    """Fill defaults, then capacity per day and revenue potential.

    ``cure_time`` leaves this step with the handling minutes included.
    """
    cure = F.coalesce("cure_time", F.lit(float(params.default_cure_time))) + HANDLING_MINUTES
    cycles = ratio(F.lit(float(MINUTES_PER_DAY)), F.col("cure_time"))
    return (
        df.withColumns(
            {
                "asp": F.coalesce("asp", F.lit(float(params.default_asp))),
                "cure_time": cure,
            }
        )
        .withColumn("daily_cure", F.ceil(cycles * float(params.efficiency_factor)).cast("long"))
        .withColumn("rev_pot", F.col("asp") * F.col("daily_cure"))
    )
