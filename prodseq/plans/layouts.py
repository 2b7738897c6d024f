"""Report layouts: internal column name → display name, in output order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Display names of the report columns.
_IDENTITY = {"sku": "SKUCode", "description": "SKU Description", "size": "size"}
_TARGETS = {
    "market": "Market",
    "norm": "Norm ",
    "virtual_norm": "Virtual Norm",
    "adjusted_target": "Adjusted_Target",
}
_STOCK = {"stock": "Stock"}
_SIGNALS = {
    "requirement": "Requirement",
    "penetration": "Penetration",
    "norm_penetration": "NormPenetration",
    "norm_requirement": "NormRequirement",
}
_ATTRIBUTES = {
    "top_sku": "Top SKU",
    "top_flag": "TopSKUFlag",
    "market_weight": "MarketWeight",
    "priority": "priority",
}
_INVENTORY = {"inventory": "PriorityScore_Inventory", "norm_inventory": "NormInventoryScore"}
_DEPLOYMENT = {
    "machine_count": "MachineCount",
    "mould_health": "AvgMouldHealth",
    "proxy": "ProxyPenetration",
    "proxy_rank": "ProxyRank",
    "critical_gap": "CriticalGap",
    "excess_production": "ExcessProduction",
    "mould_alert": "MouldAlert",
    "is_ghost": "IsGhostSKU",
}
_REVENUE = {
    "asp": "ASP",
    "cure_time": "Cure Time",
    "daily_cure": "daily_cure",
    "rev_pot": "rev_pot",
    "price_priority": "price_priority",
}
_SCORES = {
    "demand_score": "PriorityScore",
    "consolidated": "ConsolidatedPriorityScore",
    "demand_rank": "Rank_ConsolidatedPriorityScore",
}
_OVERRIDE = {
    "source": "Source",
    "highest_priority": "HighestPriority",
    "manual_score": "ManualPriorityScore",
    "manual_rank": "ManualRank",
    "strategic": "StrategicPriorityScore",
}
_TWO_SOURCES = {"prior_requirement": "Vector_Requirement", "manual_requirement": "CPT_Requirement"}

STAGE1 = (
    _IDENTITY | _TARGETS | _STOCK | _SIGNALS | _ATTRIBUTES | _INVENTORY | _REVENUE | _SCORES
)
STAGE2 = (
    _IDENTITY | _TARGETS | _STOCK | _SIGNALS | _ATTRIBUTES | _INVENTORY
    | _DEPLOYMENT | _REVENUE | _SCORES
)
STAGE3 = (
    {"final_rank": "Final Rank"} | _IDENTITY | _OVERRIDE | _TARGETS | _STOCK | _TWO_SOURCES
    | _SIGNALS | _ATTRIBUTES | _INVENTORY | _DEPLOYMENT | _REVENUE | _SCORES
)
# A date without manual entries keeps the second layout and gains two columns.
STAGE3_NO_MANUAL = {"final_rank": "Final Rank"} | STAGE2 | {"source": "Source"}


def to_report(df: DataFrame, layout: dict[str, str]) -> DataFrame:
    """Select the layout's columns that exist, in order, under display names."""
    present = set(df.columns)
    return df.select(
        "report_date",
        *[F.col(name).alias(shown) for name, shown in layout.items() if name in present],
    )
