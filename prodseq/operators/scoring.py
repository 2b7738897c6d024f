"""Batch maxima and the consolidated priority score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseq.functions import ratio
from prodseq.operators.deployment import with_machines
from prodseq.operators.revenue import with_revenue
from prodseq.plans.params import Params

# Numeric columns that read 0 where the demand row has no value.
ZERO_FILLED = [
    "size", "norm", "virtual_norm", "adjusted_target", "stock", "requirement", "penetration",
    "norm_penetration", "norm_requirement", "top_flag", "market_weight", "demand_score",
    "inventory",
]


def sku_attributes(
    demand: DataFrame,
    inventory: DataFrame,
    asp: DataFrame,
    cure: DataFrame,
    params: Params,
    moulds: DataFrame | None = None,
) -> DataFrame:
    """One row per date and product: largest signals, stock-out score, price, capacity.

    Demand is reduced to its products before any lookup is joined, so a product
    with very many rows is one row here and the lookups join unique keys. With
    ``moulds`` given, machines and health ride along and the second stage needs
    no join of its own on the demand rows.
    """
    products = demand.groupBy("report_date", "sku").agg(
        F.max("penetration").alias("max_penetration"),
        F.max("requirement").alias("max_requirement"),
    )
    if moulds is not None:
        products = with_machines(products, moulds)
    joined = (
        products.join(inventory, ["report_date", "sku"], "left")
        .join(asp, "sku", "left")
        .join(cure, "sku", "left")
        .withColumn("inventory", F.coalesce("inventory", F.lit(0.0)))
    )
    return with_revenue(joined, params)


def batch_maxima(attributes: DataFrame) -> DataFrame:
    """Largest penetration, requirement, stock-out score and revenue of each date."""
    return attributes.groupBy("report_date").agg(
        F.max("max_penetration").alias("top_penetration"),
        F.max("max_requirement").alias("top_requirement"),
        F.max("inventory").alias("top_inventory"),
        F.max("rev_pot").alias("top_revenue"),
    )


def with_attributes(demand: DataFrame, attributes: DataFrame) -> DataFrame:
    """Bring the product's attributes and its date's maxima onto demand rows.

    The maxima have one row per calendar day, so they are broadcast; the
    attribute table was written before, and its size decides the other join.
    """
    per_sku = attributes.drop("max_penetration", "max_requirement")
    return demand.join(per_sku, ["report_date", "sku"], "left").join(
        F.broadcast(batch_maxima(attributes)), "report_date", "left"
    )


def with_demand_score(df: DataFrame, params: Params) -> DataFrame:
    """Relative signals, the priority tuple and the demand score, missing kept."""
    score = (
        F.col("market_weight") * float(params.market_weightage)
        + F.col("norm_penetration") * float(params.penetration_weightage)
        + F.col("norm_requirement") * float(params.requirement_weightage)
        + F.col("top_flag") * float(params.top_sku_weightage)
    )
    priority = F.struct(
        (-F.col("market_weight")).alias("market_weight"),
        (-F.col("penetration")).alias("penetration"),
        (-F.col("requirement")).alias("requirement"),
        (-F.col("top_flag")).alias("top_flag"),
    )
    return (
        df.withColumns(
            {
                "norm_penetration": ratio(F.col("penetration"), F.col("top_penetration")),
                "norm_requirement": ratio(F.col("requirement"), F.col("top_requirement")),
                "priority": priority,
            }
        )
        .withColumn("demand_score", score)
    )


def with_consolidated_score(df: DataFrame, params: Params) -> DataFrame:
    """Fill missing numbers with 0, then weigh demand, stock-outs and revenue.

    The fill comes after the demand score (an unknown market scores 0, not a
    partial sum) and before the two relative scores.
    """
    inventory = F.coalesce(ratio(F.col("inventory"), F.col("top_inventory")), F.lit(0.0))
    price = F.coalesce(ratio(F.col("rev_pot"), F.col("top_revenue")), F.lit(0.0))
    total = (
        F.col("demand_score") * float(params.demand_weight)
        + F.col("norm_inventory") * float(params.inventory_weight)
        + F.col("price_priority") * float(params.price_weight)
    )
    return (
        df.na.fill(0, [c for c in ZERO_FILLED if c in df.columns])
        .withColumns({"norm_inventory": inventory, "price_priority": price})
        .withColumn("consolidated", total)
        .drop("top_penetration", "top_requirement", "top_inventory", "top_revenue")
    )
