"""Weights and thresholds, resolved from a parameter table.

The table has one row per parameter: sheet, ``Parameter``, ``Default_Value``
and ``User_Input``. A non-blank user value wins over the default.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseq.functions import number, strip

PARAMETER_SCHEMA = "sheet string, Parameter string, Default_Value double, User_Input string"

# Parameter names and defaults, by sheet.
DEFAULTS = {
    "Stage1_Config": {
        "MARKET_WEIGHTS_OE": 4,
        "MARKET_WEIGHTS_ST": 3,
        "MARKET_WEIGHTS_EXP": 2,
        "MARKET_WEIGHTS_RE": 1,
        "MARKET_PRIORITY_OE": 1,
        "MARKET_PRIORITY_ST": 2,
        "MARKET_PRIORITY_EXP": 3,
        "MARKET_PRIORITY_RE": 4,
        "LOCATION_WEIGHTS_JIT": 5,
        "LOCATION_WEIGHTS_Depot": 4,
        "LOCATION_WEIGHTS_Depot_Mobility": 3,
        "LOCATION_WEIGHTS_Feeder": 2,
        "LOCATION_WEIGHTS_PWH": 1,
        "SCORING_market_weightage": 0.25,
        "SCORING_penetration_weightage": 0.35,
        "SCORING_requirement_weightage": 0.30,
        "SCORING_top_sku_weightage": 0.10,
        "INVENTORY_BLACK_FACTOR": 1.0,
        "INVENTORY_RED_FACTOR": 0.5,
        "CONSOLIDATED_demand_priority": 0.4,
        "CONSOLIDATED_inventory_priority": 0.3,
        "CONSOLIDATED_price_priority": 0.3,
        "EFFICIENCY_FACTOR": 0.9,
        "DEFAULT_ASP": 3000,
        "DEFAULT_CURE_TIME": 15,
    },
    "Stage2_Config": {
        "MOULD_LIFE_THRESHOLD": 0.9,
        "MACHINE_COUNT_PENALTY": 0.05,
        "CRITICAL_GAP_RANK": 50,
        "EXCESS_PRODUCTION_RANK": 200,
        "EXCESS_MACHINE_COUNT": 2,
    },
}

# Parameters used as whole numbers; fractions are cut off.
WHOLE_NUMBERS = {
    "MARKET_WEIGHTS_OE", "MARKET_WEIGHTS_ST", "MARKET_WEIGHTS_EXP", "MARKET_WEIGHTS_RE",
    "MARKET_PRIORITY_OE", "MARKET_PRIORITY_ST", "MARKET_PRIORITY_EXP", "MARKET_PRIORITY_RE",
    "LOCATION_WEIGHTS_JIT", "LOCATION_WEIGHTS_Depot", "LOCATION_WEIGHTS_Depot_Mobility",
    "LOCATION_WEIGHTS_Feeder", "LOCATION_WEIGHTS_PWH",
    "DEFAULT_ASP", "DEFAULT_CURE_TIME",
    "CRITICAL_GAP_RANK", "EXCESS_PRODUCTION_RANK", "EXCESS_MACHINE_COUNT",
}


def _default(name: str) -> float:
    for sheet in DEFAULTS.values():
        if name in sheet:
            return sheet[name]
    raise KeyError(name)


def _weights(prefix: str, names: list[str]) -> dict[str, float]:
    return {n: _default(prefix + n.replace(" ", "_")) for n in names}


MARKETS = ["OE", "ST", "EXP", "RE"]
LOCATION_TYPES = ["JIT", "Depot", "Depot Mobility", "Feeder", "PWH"]


@dataclass(frozen=True)
class Params:
    """Resolved values used while a plan is built.

    ``asp_scale``, ``health_scale`` and ``rank_scale`` are off by default. When
    set, the two averages and the ranked scores are rounded to that many places,
    which makes ranks independent of the order in which partial sums were added.
    """

    market_weights: dict[str, float] = field(
        default_factory=lambda: _weights("MARKET_WEIGHTS_", MARKETS)
    )
    location_weights: dict[str, float] = field(
        default_factory=lambda: _weights("LOCATION_WEIGHTS_", LOCATION_TYPES)
    )
    market_weightage: float = _default("SCORING_market_weightage")
    penetration_weightage: float = _default("SCORING_penetration_weightage")
    requirement_weightage: float = _default("SCORING_requirement_weightage")
    top_sku_weightage: float = _default("SCORING_top_sku_weightage")
    black_factor: float = _default("INVENTORY_BLACK_FACTOR")
    red_factor: float = _default("INVENTORY_RED_FACTOR")
    demand_weight: float = _default("CONSOLIDATED_demand_priority")
    inventory_weight: float = _default("CONSOLIDATED_inventory_priority")
    price_weight: float = _default("CONSOLIDATED_price_priority")
    efficiency_factor: float = _default("EFFICIENCY_FACTOR")
    default_asp: float = _default("DEFAULT_ASP")
    default_cure_time: float = _default("DEFAULT_CURE_TIME")
    mould_life_threshold: float = _default("MOULD_LIFE_THRESHOLD")
    machine_count_penalty: float = _default("MACHINE_COUNT_PENALTY")
    critical_gap_rank: int = _default("CRITICAL_GAP_RANK")
    excess_production_rank: int = _default("EXCESS_PRODUCTION_RANK")
    excess_machine_count: int = _default("EXCESS_MACHINE_COUNT")
    asp_scale: int | None = None
    health_scale: int | None = None
    rank_scale: int | None = None


_FIELDS = {
    "market_weightage": "SCORING_market_weightage",
    "penetration_weightage": "SCORING_penetration_weightage",
    "requirement_weightage": "SCORING_requirement_weightage",
    "top_sku_weightage": "SCORING_top_sku_weightage",
    "black_factor": "INVENTORY_BLACK_FACTOR",
    "red_factor": "INVENTORY_RED_FACTOR",
    "demand_weight": "CONSOLIDATED_demand_priority",
    "inventory_weight": "CONSOLIDATED_inventory_priority",
    "price_weight": "CONSOLIDATED_price_priority",
    "efficiency_factor": "EFFICIENCY_FACTOR",
    "default_asp": "DEFAULT_ASP",
    "default_cure_time": "DEFAULT_CURE_TIME",
    "mould_life_threshold": "MOULD_LIFE_THRESHOLD",
    "machine_count_penalty": "MACHINE_COUNT_PENALTY",
    "critical_gap_rank": "CRITICAL_GAP_RANK",
    "excess_production_rank": "EXCESS_PRODUCTION_RANK",
    "excess_machine_count": "EXCESS_MACHINE_COUNT",
}


def default_parameters(spark: SparkSession) -> DataFrame:
    """The parameter table with every user value blank."""
    rows = [
        (sheet, name, float(value), None)
        for sheet, values in DEFAULTS.items()
        for name, value in values.items()
    ]
    return spark.createDataFrame(rows, PARAMETER_SCHEMA)


def resolve_parameters(parameters: DataFrame) -> DataFrame:
    """Add ``value``: the user's number if one is given, else the default.

    ``is_valid`` is false where the user's text is not a number.
    """
    user = strip(F.col("User_Input"))
    given = F.coalesce(F.length(user) > 0, F.lit(False))
    value = F.when(given, number(user)).otherwise(F.col("Default_Value"))
    whole = F.col("Parameter").isin(sorted(WHOLE_NUMBERS))
    cut = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)).cast("double")
    return parameters.select(
        "sheet", "Parameter", "Default_Value", "User_Input",
        F.when(whole, cut).otherwise(value).alias("value"),
        (~given | number(user).isNotNull()).alias("is_valid"),
    )


def load_params(parameters: DataFrame, **scales: int | None) -> Params:
    """Collect the known parameters (at most one row per name) into ``Params``."""
    known = {n for sheet in DEFAULTS.values() for n in sheet}
    rows = (
        resolve_parameters(parameters)
        .filter(F.col("Parameter").isin(sorted(known)))
        .limit(len(known) + 1)  # one more than can be valid, to notice duplicates
        .collect()
    )
    values = {r["Parameter"]: r["value"] for r in rows}
    if len(values) < len(rows):
        raise ValueError("a parameter is listed more than once")
    missing = sorted(known - values.keys())
    if missing:
        raise KeyError(f"parameters not found in the parameter table: {missing}")
    wrong = sorted(r["Parameter"] for r in rows if not r["is_valid"] or r["value"] is None)
    if wrong:
        raise ValueError(f"parameters without a numeric value: {wrong}")
    return Params(
        market_weights={m: values[f"MARKET_WEIGHTS_{m}"] for m in MARKETS},
        location_weights={
            t: values["LOCATION_WEIGHTS_" + t.replace(" ", "_")] for t in LOCATION_TYPES
        },
        **{f: values[name] for f, name in _FIELDS.items()},
        **scales,
    )
