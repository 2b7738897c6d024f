"""Planners' manual orders on top, overstocked products at the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.functions import number, rim_size, rounded, strip
from prodseq.operators.deployment import ZERO_FILLED as STAGE2_ZERO_FILLED
from prodseq.operators.ranking import Rows, tie_break, with_row_number
from prodseq.plans.workspace import SALT
from prodseq.sources.reports import REQUIRED_MANUAL

# Manual score base and bonus, overstock limit and factor, alert of manual rows.
BOOST_BASE = 10.0
BOOST_PER_PRIORITY = 1.0
OVERSTOCK_PENETRATION = 100
OVERSTOCK_FACTOR = 0.0
MANUAL_ALERT_HEALTH = 0.9

MANUAL = "Manual"
AUTOMATED = "Automated"

# Columns of the manual list.
MANUAL_COLUMNS = {
    "SKU Code": "sku",
    "SKU Description": "description",
    "Market": "market",
    "Quantity": "quantity",
    "Highest Priority": "highest_priority",
}

# Columns whose missing numbers become 0, and whose missing texts become empty.
ZERO_FILLED = [
    *STAGE2_ZERO_FILLED,
    "prior_requirement", "manual_requirement", "manual_score", "highest_priority", "manual_rank",
]
BLANK_FILLED = ["description", "top_sku", "source"]


def clean_manual(raw: DataFrame) -> DataFrame:
    """Standard names, trimmed keys, numbers or 0; entries without a code are left out."""
    trimmed = raw.toDF(*[c.strip() for c in raw.columns])
    absent = [c for c in REQUIRED_MANUAL if c not in trimmed.columns]
    if absent:
        raise ValueError(f"manual demand lacks required columns: {absent}")
    df = trimmed.withColumnsRenamed(MANUAL_COLUMNS)
    if "description" not in df.columns:
        df = df.withColumn("description", F.lit(""))

    def amount(name: str) -> Column:
        return F.coalesce(number(F.col(name).cast("string")), F.lit(0.0))

    # Truncation toward zero, as an integer cast does.
    level = amount("highest_priority")
    held = F.when(F.abs(level) < 2.0**63, level).otherwise(0.0)  # else no whole number of 64 bits
    whole = F.when(held < 0, F.ceil(held)).otherwise(F.floor(held)).cast("long")
    return (
        df.withColumns(
            {
                "sku": strip(F.col("sku").cast("string")),
                "market": strip(F.col("market").cast("string")),
                "quantity": amount("quantity"),
                "highest_priority": whole,
            }
        ).filter(F.length("sku") > 0)
    )


def with_manual_score(manual: DataFrame) -> DataFrame:
    bonus = F.col("highest_priority") * BOOST_PER_PRIORITY
    return manual.withColumn("manual_score", bonus + BOOST_BASE)


def with_manual_rank(rows: Rows) -> DataFrame:
    """Row number by score, then quantity, then the order of entry."""
    order = [
        F.col("manual_score").desc(),
        F.col("quantity").desc(),
        F.col("entry_no").asc_nulls_last(),
    ]
    return with_row_number(rows, order, "manual_rank")


def manual_keys(manual: DataFrame) -> DataFrame:
    return manual.select("report_date", "sku").distinct()


def with_trimmed_sku(stage2: DataFrame) -> DataFrame:
    """Keep the code as stored beside the trimmed one, which identifies the product."""
    return stage2.withColumn("raw_sku", F.col("sku")).withColumn("sku", strip(F.col("sku")))


def with_manual_mark(stage2: DataFrame, manual: DataFrame) -> DataFrame:
    """Tell rows whose product the manual list supersedes from those that remain, by one join.

    ``superseded`` holds for rows of any market. The code as stored stays beside the
    trimmed one.
    """
    keys = manual_keys(manual).withColumn("superseded", F.lit(True))
    marked = with_trimmed_sku(stage2).join(keys, ["report_date", "sku"], "left")
    return marked.withColumn("superseded", F.coalesce("superseded", F.lit(False)))


def superseded_rows(marked: DataFrame) -> DataFrame:
    """Automated rows of any market whose product is in the manual list."""
    return marked.filter("superseded").drop("superseded")


def remaining_rows(marked: DataFrame) -> DataFrame:
    """Automated rows whose product is not in the manual list."""
    return marked.filter("NOT superseded").drop("superseded", "raw_sku")


def as_stored(marked: DataFrame) -> DataFrame:
    """Rows as they were before they were marked."""
    return marked.withColumn("sku", F.col("raw_sku")).drop("raw_sku", "superseded")


def prior_facts(superseded: DataFrame) -> DataFrame:
    """Per superseded product: requirement of its best-ranked row, machines and health.

    "Best" is the first row in the order of the demand rank, with unranked
    (ghost) rows last. Machines and health are equal on all rows of a product,
    and are looked up under the code as stored, so only an untrimmed match counts.
    """
    rank, market = F.col("demand_rank"), F.col("market")
    place = F.struct(rank.isNull(), rank, market.isNull(), market, -F.col("requirement"))
    same_code = F.col("raw_sku") == F.col("sku")
    return superseded.groupBy("report_date", "sku").agg(
        F.min_by("requirement", place).alias("prior_requirement"),
        F.max(F.when(same_code, F.col("machine_count"))).alias("machine_count"),
        F.max(F.when(same_code, F.col("mould_health"))).alias("mould_health"),
    )


def manual_rows(ranked_manual: DataFrame, facts: DataFrame) -> DataFrame:
    """Manual entries in the shape of report rows."""
    joined = ranked_manual.join(facts, ["report_date", "sku"], "left")
    machines = F.coalesce("machine_count", F.lit(0).cast("long"))
    health = F.coalesce("mould_health", F.lit(0.0))
    return joined.select(
        "report_date",
        "sku",
        "description",
        rim_size(F.col("sku")).alias("size"),
        "market",
        "highest_priority",
        "manual_score",
        "manual_rank",
        F.coalesce("prior_requirement", F.lit(0.0)).alias("prior_requirement"),
        F.col("quantity").alias("manual_requirement"),
        F.col("quantity").alias("requirement"),
        F.lit(False).alias("is_ghost"),
        machines.alias("machine_count"),
        health.alias("mould_health"),
        (machines == 0).alias("critical_gap"),
        F.lit(False).alias("excess_production"),
        (health > MANUAL_ALERT_HEALTH).alias("mould_alert"),
        F.lit(MANUAL).alias("source"),
        F.col("manual_rank").alias("proxy_rank"),
        F.col("manual_score").alias("consolidated"),
        *([SALT] if SALT in joined.columns else []),
    )


def automated_rows(remaining: Rows, manual_counts: DataFrame) -> DataFrame:
    """Remaining rows, renumbered in proxy order after the last manual rank.

    ``manual_counts`` has one row per calendar day.
    """
    df = remaining.df
    order = [F.col("proxy_rank").asc(), *tie_break(df)]
    numbered = with_row_number(remaining, order, "_row").join(
        F.broadcast(manual_counts), "report_date", "left"
    )
    return (
        numbered.withColumns(
            {
                "proxy_rank": F.col("_row") + F.coalesce("n_manual", F.lit(0)),
                "source": F.lit(AUTOMATED),
                "prior_requirement": F.col("requirement"),
                "manual_requirement": F.lit(0.0),
            }
        ).drop("_row", "n_manual")
    )


def hybrid_union(manual: DataFrame, automated: DataFrame) -> DataFrame:
    """Both sources together, numbers filled with 0 and texts with blanks."""
    both = manual.unionByName(automated, allowMissingColumns=True)
    zero = [c for c in ZERO_FILLED if c in both.columns]
    blank = [c for c in BLANK_FILLED if c in both.columns]
    return both.na.fill(0, zero).na.fill("", blank)


def with_strategic_score(hybrid: DataFrame) -> DataFrame:
    chosen = F.when(F.col("source") == MANUAL, F.col("manual_score")).otherwise(
        F.col("consolidated")
    )
    return hybrid.withColumn("strategic", chosen)


def with_overstock(hybrid: DataFrame) -> DataFrame:
    """Mark automated rows past their buffer limit and lower their score."""
    if "penetration" not in hybrid.columns:
        return hybrid.withColumn("is_overstock", F.lit(False))
    over = (F.coalesce("penetration", F.lit(0.0)) > OVERSTOCK_PENETRATION) & (
        F.col("source") != MANUAL
    )
    lowered = F.when(over, F.col("strategic") * OVERSTOCK_FACTOR).otherwise(F.col("strategic"))
    return hybrid.withColumn("is_overstock", over).withColumn("strategic", lowered)


def final_order(score: Column) -> list[Column]:
    """Normal rows by score, then overstocked rows by penetration.

    Equal keys keep the order before this step: manual rows by manual rank, then
    automated rows by proxy order. ``proxy_rank`` holds exactly that, once per date.
    """
    over = F.col("is_overstock")
    return [
        over.asc(),
        F.when(~over, score).desc_nulls_last(),
        F.when(over, F.col("penetration")).asc_nulls_last(),
        F.col("proxy_rank").asc(),
    ]


def in_final_order(hybrid: DataFrame, scale: int | None) -> DataFrame:
    """Rows of each date in their final order, dates ascending."""
    return hybrid.orderBy("report_date", *final_order(rounded(F.col("strategic"), scale)))


def with_final_rank(rows: Rows, scale: int | None) -> DataFrame:
    order = final_order(rounded(F.col("strategic"), scale))
    return with_row_number(rows, order, "final_rank")


def without_manual(stage2: Rows) -> DataFrame:
    """Dates with an empty manual list: second-stage rows, numbered as they stand."""
    order = [F.col("demand_rank").asc_nulls_last(), *tie_break(stage2.df)]
    return with_row_number(stage2, order, "final_rank").withColumn("source", F.lit(AUTOMATED))
