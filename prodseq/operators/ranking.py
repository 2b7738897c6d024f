"""Ranks within a date that do not put a whole date into one task.

A shared rank needs only the number of rows above each score. Rows are counted by score
first, so a frequent score is one row; distinct scores are cut into slices at quantiles
of their date, and small dates are one slice each. A running number follows a total
order: rows are range-partitioned on it, so a row's number is its place in its partition
plus the rows of the partitions before it. Equal rows are told apart by a stored row hash,
so even a long run of equal keys is cut into several partitions. Both are the same plan
whatever the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodseq.operators.demand import expand_copies
from prodseq.plans.workspace import SALT, Workspace

DATE = "report_date"
_SLOT_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id: place in partition

# Order of rows whose ranking keys are equal; the rest of the columns follow.
TIE_BREAK = [("sku", True), ("market", True), ("requirement", False)]
TIE_BREAK_REST = [
    "description", "norm", "virtual_norm", "adjusted_target", "stock", "penetration",
    "top_sku", "machine_count", "inventory", "demand_score", "consolidated", "proxy_rank",
]


#: Slices of a date at most, a power of two; quantiles are taken at as many places.
MOST_SLICES = 1024


@dataclass(frozen=True)
class Rows:
    """Written rows, each with a hash of its place, or steps on them."""

    df: DataFrame
    workspace: Workspace

    def using(self, df: DataFrame) -> Rows:
        """The same workspace with other rows."""
        return replace(self, df=df)


def stored_rows(ws: Workspace, df: DataFrame, label: str) -> Rows:
    """Write ``df`` and give each row a hash; rows held as copies are repeated after that."""
    table = ws.salted(ws.write(df.drop(SALT), label))
    if "copies" in df.columns:
        table = expand_copies(table, ws.copies_per_task)
    return Rows(table, ws)


def tie_break(df: DataFrame) -> list[Column]:
    """Total order of report rows with equal ranking keys."""
    named = [
        F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in TIE_BREAK
    ]
    rest = [F.col(c).asc_nulls_last() for c in TIE_BREAK_REST if c in df.columns]
    return named + rest


def with_rank(rows: Rows, score: Column, out: str) -> DataFrame:
    """Descending rank; equal scores share the lowest number, a missing score has none.

    Rows of a score that more than ``copies_per_task`` rows share are dealt over lots, and the
    score's rank is repeated for each; rows without a score are dealt at will. So no task
    gets all rows of a frequent score.
    """
    keyed = rows.df.withColumn("_score", score + 0.0)  # +0.0 makes -0.0 equal to 0.0
    counts = keyed.filter(F.col("_score").isNotNull()).groupBy(DATE, "_score").agg(F.count("*").alias("_n"))
    lots = F.ceil(F.col("_n") / rows.workspace.copies_per_task)
    above = rows_above(counts, rows.workspace.slice_rows)
    first = above.select(DATE, "_score", F.explode(F.sequence(F.lit(0).cast("long"), lots - 1)).alias("_lot"), (F.col("_above") + 1).alias(out))
    # no more than one frequent score for so many rows
    frequent = counts.filter(lots > 1).select(DATE, "_score", lots.alias("_lots"))
    salt = F.col(SALT) if SALT in keyed.columns else F.xxhash64(*rows.df.columns)
    lot = F.when(F.col("_score").isNull(), salt).when(F.col("_lots").isNotNull(), F.pmod(salt, "_lots")).otherwise(0)
    dealt = keyed.join(F.broadcast(frequent), [DATE, "_score"], "left").withColumn("_lot", lot).drop("_lots")
    return dealt.join(first, [DATE, "_score", "_lot"], "left").drop("_score", "_lot")


def rows_above(counts: DataFrame, slice_rows: int) -> DataFrame:
    """Add ``_above`` to distinct scores and their counts: the rows of the date with a higher score.

    A slice holds the scores between two quantiles of the date's distinct scores, about
    ``slice_rows`` of them. Within it counts are summed in order; the sums of the slices
    above are added. Tables with one row per date or slice are broadcast.
    """
    # one text, not an expression for each share, which every later step would analyse again
    shares = F.split(F.lit(",".join(str(i / MOST_SLICES) for i in range(1, MOST_SLICES))), ",").cast("array<double>")
    quantiles = counts.groupBy(DATE).agg(F.count("*").alias("_scores"), F.percentile_approx("_score", shares, 10_000).alias("_cuts"))
    # a power of two, so that the cuts of fewer slices are some of the cuts of more
    wanted = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("_scores") / slice_rows)))
    slices = F.least(F.lit(MOST_SLICES), F.pow(F.lit(2.0), wanted)).cast("int")
    step = F.expr(f"{MOST_SLICES} DIV _slices").cast("int")
    some = F.transform(F.sequence(F.lit(1), F.col("_slices") - 1), lambda i: F.get("_cuts", i * F.col("_step") - 1))
    cuts = quantiles.withColumn("_slices", slices).withColumn("_step", step)
    cuts = cuts.select(DATE, F.when(F.col("_slices") > 1, some).otherwise(F.array().cast("array<double>")).alias("_cuts"))
    sliced = counts.join(F.broadcast(cuts), DATE).withColumn("_slice", F.size(F.filter("_cuts", lambda c: c > F.col("_score")))).drop("_cuts")
    totals = sliced.groupBy(DATE, "_slice").agg(F.sum("_n").alias("_total"))
    higher = Window.partitionBy(DATE).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(DATE, "_slice", F.coalesce(F.sum("_total").over(higher), F.lit(0)).alias("_before"))
    within = Window.partitionBy(DATE, "_slice").orderBy(F.col("_score").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summed = sliced.withColumn("_here", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    return summed.join(F.broadcast(offsets), [DATE, "_slice"]).withColumn("_above", F.col("_here") + F.col("_before")).drop("_slice", "_here", "_before")


def with_row_number(rows: Rows, order: list[Column], out: str) -> DataFrame:
    """1, 2, 3 … per date in the given order."""
    return _placed(rows.workspace, rows.df, order).withColumnRenamed("_place", out)


def _placed(ws: Workspace, df: DataFrame, order: list[Column]) -> DataFrame:
    """Add ``_place``, the row's position in its date, using every task of the cluster."""
    order = [F.col(DATE).asc(), *order, *([F.col(SALT).asc()] if SALT in df.columns else [])]
    slices = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_slot", F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_MASK)))
    )
    stored = ws.write(slices, "ranked")
    # One row per slice and date: no more than the number of slices plus the
    # number of dates, so the offsets are broadcast.
    runs = stored.groupBy(DATE, "_slice").agg(
        F.min("_slot").alias("_start"), F.count("*").alias("_n")
    )
    before = Window.partitionBy(DATE).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = runs.select(
        DATE,
        "_slice",
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start") + 1).alias("_shift"),
    )
    return (
        # Left, so that the join falls away where the place is not read.
        stored.join(F.broadcast(offsets), [DATE, "_slice"], "left")
        .withColumn("_place", F.col("_slot") + F.col("_shift"))
        .drop("_slice", "_slot", "_shift")
    )
