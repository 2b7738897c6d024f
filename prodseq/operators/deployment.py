"""Machines and moulds against the demand ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseq.functions import ratio, rim_size, rounded
from prodseq.operators.ranking import Rows, with_rank
from prodseq.plans.params import Params
from prodseq.plans.workspace import SALT

# What a product without demand is given.
GHOST_MARKET = "RE"
GHOST_CURE_TIME = 20.0
GHOST_SHARE_OF_LOWEST = 0.5

# Columns whose missing numbers become 0.
ZERO_FILLED = [
    "norm", "virtual_norm", "adjusted_target", "stock", "requirement", "penetration",
    "norm_penetration", "norm_requirement", "inventory", "norm_inventory", "demand_score",
    "consolidated", "proxy", "proxy_rank", "asp", "daily_cure", "rev_pot", "price_priority",
    "market_weight", "top_flag",
]


def mould_summary(mould: DataFrame, params: Params) -> DataFrame:
    """Distinct machines and mean mould health per product."""
    health = ratio(F.col("mould_life"), F.col("target_life"))
    return (
        mould.filter(F.col("sku").isNotNull())
        .groupBy("report_date", "sku")
        .agg(
            F.count_distinct("machine").alias("machine_count"),
            F.avg(health).alias("mould_health"),
        )
        .withColumn("mould_health", rounded(F.col("mould_health"), params.health_scale))
    )


def with_machines(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Left join of machines and health; a product or date without moulds has zeros."""
    return rows.join(summary, ["report_date", "sku"], "left").withColumns(
        {
            "machine_count": F.coalesce("machine_count", F.lit(0)),
            "mould_health": F.coalesce("mould_health", F.lit(0.0)),
        }
    )


def with_deployment(demand: DataFrame, summary: DataFrame | None) -> DataFrame:
    """Demand rows with machines, tagged as real demand.

    Rows that already carry machines are only tagged; without a mould report
    every row has zeros.
    """
    if "machine_count" not in demand.columns:
        demand = (
            with_machines(demand, summary)
            if summary is not None
            else demand.withColumns(
                {"machine_count": F.lit(0).cast("long"), "mould_health": F.lit(0.0)}
            )
        )
    return demand.withColumn("is_ghost", F.lit(False))


def ghost_rows(demand: DataFrame, summary: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Products on machines that have no demand row on a date that has demand.

    ``products`` are the date and product pairs in demand, once each; they are
    taken from the demand rows if not given. The per-date score floor has one
    row per calendar day.
    """
    if products is None:
        products = demand.select("report_date", "sku").distinct()
    floor = demand.groupBy("report_date").agg(F.min("consolidated").alias("_lowest"))
    score = F.coalesce("_lowest", F.lit(0.0)) * GHOST_SHARE_OF_LOWEST
    return (
        summary.join(products, ["report_date", "sku"], "left_anti")
        .join(F.broadcast(floor), "report_date")
        .select(
            "report_date",
            "sku",
            rim_size(F.col("sku")).alias("size"),
            F.lit(GHOST_MARKET).alias("market"),
            F.lit(0.0).alias("requirement"),
            F.lit(0.0).alias("penetration"),
            F.lit(GHOST_CURE_TIME).alias("cure_time"),
            "machine_count",
            "mould_health",
            score.alias("consolidated"),
            F.lit(True).alias("is_ghost"),
        )
    )


def with_ghosts(deployed: DataFrame, ghosts: DataFrame) -> DataFrame:
    """Append ghost rows; columns they lack are missing until the fill."""
    if SALT in deployed.columns:
        ghosts = ghosts.withColumn(SALT, F.xxhash64("report_date", "sku"))
    return deployed.unionByName(ghosts, allowMissingColumns=True)


def with_proxy_score(df: DataFrame, params: Params) -> DataFrame:
    """Score lowered by a share per running machine, at most to 0."""
    left = F.greatest(
        F.lit(0.0), F.lit(1.0) - F.col("machine_count") * float(params.machine_count_penalty)
    )
    return df.withColumn("proxy", F.col("consolidated") * left)


def with_proxy_rank(rows: Rows, params: Params) -> DataFrame:
    """Rank of demand and ghost rows together by the lowered score."""
    return with_rank(rows, rounded(F.col("proxy"), params.rank_scale), "proxy_rank")


def with_gap_flags(df: DataFrame, params: Params) -> DataFrame:
    """Critical gap, excess production and mould alert; a missing rank raises no flag."""
    rank = F.col("demand_rank" if "demand_rank" in df.columns else "proxy_rank")
    machines = F.col("machine_count")
    flags = {
        "critical_gap": (rank <= int(params.critical_gap_rank)) & (machines == 0),
        "excess_production": (rank > int(params.excess_production_rank))
        & (machines > int(params.excess_machine_count)),
        "mould_alert": F.col("mould_health") > float(params.mould_life_threshold),
    }
    return df.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in flags.items()})


def filled(df: DataFrame) -> DataFrame:
    return df.na.fill(0, [c for c in ZERO_FILLED if c in df.columns])
