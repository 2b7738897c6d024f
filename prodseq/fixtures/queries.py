"""One query per operator, over reports derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseq.fixtures import oracle
from prodseq.fixtures.views import DAILY_SHEETS, MANUAL_LIST, SINGLE_DATE, landed, landed_csv
from prodseq.functions import case_of
from prodseq.operators import demand as dm
from prodseq.operators import deployment as dp
from prodseq.operators import inventory as inv
from prodseq.operators import override as ov
from prodseq.operators import revenue as rev
from prodseq.operators import scoring as sc
from prodseq.operators import summary as sm
from prodseq.operators.ranking import Rows
from prodseq.plans import layouts
from prodseq.plans import params as pm
from prodseq.plans import pipeline as pl
from prodseq.plans.workspace import SLICE_ROWS, Workspace
from prodseq.sources import calendar as cal
from prodseq.sources import reports as rp
from prodseq.sources.left_out import LeftOut
from prodseq.sources.sinks import order_faults, read_report, write_report

# Averages and ranked scores are rounded so that both engines order rows alike.
PARAMS = pm.Params(asp_scale=6, health_scale=6, rank_scale=9)

#: Scores of a slice in the queries that show ranks over many slices.
FEW_ROWS = 64

Query = Callable[[SparkSession, str], DataFrame]


def _shown(df: DataFrame) -> DataFrame:
    """Comparable values: dates as text, doubles to 6 places, integers as long."""

    def cell(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "double":
            c = F.round(c, 6)
        elif kind == "int":
            c = c.cast("long")
        elif kind == "date":
            c = c.cast("string")
        return c.alias(name)

    return df.select(*[cell(n, t) for n, t in df.dtypes if not t.startswith("struct")])


def _pick(df: DataFrame, columns: list[str]) -> DataFrame:
    return _shown(df.select(*columns))


class _Run:
    """Steps of one run at one scale; each step is built when asked for."""

    def __init__(
        self, spark: SparkSession, sf_dir: str, yearly: bool = False, slice_rows: int = SLICE_ROWS, params: pm.Params = PARAMS
    ) -> None:
        self.ws = Workspace(spark, slice_rows=slice_rows)
        self.reports = landed(spark, sf_dir, yearly).reports()
        self.params = params

    def expanded(self, df: DataFrame) -> DataFrame:
        return dm.expand_copies(self.ws.write(df, "rows"))

    def signals(self) -> DataFrame:
        return dm.domestic_signals(self.reports.bor)

    def marked(self) -> DataFrame:
        return dm.with_top_sku(self.signals(), self.reports.bpr)

    def demand(self) -> DataFrame:
        both = dm.combined_demand(self.marked(), dm.export_rows(self.reports.bmr))
        return dm.with_market_columns(both, PARAMS)

    def attributed(self) -> DataFrame:
        rows = pl.demand_rows(self.ws, self.reports)
        attributes = pl.product_attributes(self.ws, rows, self.reports, PARAMS)
        return sc.with_attributes(self.demand(), attributes)

    def demand_scored(self) -> DataFrame:
        return sc.with_demand_score(self.attributed(), PARAMS)

    def scored(self) -> DataFrame:
        rows = pl.demand_rows(self.ws, self.reports)
        attributes = pl.product_attributes(self.ws, rows, self.reports, PARAMS)
        return self.expanded(pl.scored_demand(rows, attributes, PARAMS))

    def stage1(self, with_moulds: bool = False) -> pl.Ranking:
        reports = self.reports if with_moulds else replace(self.reports, mould=None)
        return pl.stage1(self.ws, reports, self.params)

    def moulds(self) -> DataFrame:
        return dp.mould_summary(self.reports.mould, PARAMS)

    def stage2(self) -> Rows:
        return pl.stage2(self.ws, self.stage1(with_moulds=True), self.params)

    def override(self) -> pl.Override:
        return pl.prepare_override(self.ws, self.stage2(), pl.manual_entries(self.ws, self.reports.manual))

    def cleaned_manual(self) -> DataFrame:
        return ov.clean_manual(self.reports.manual)

    def marked_gaps(self) -> DataFrame:
        return ov.with_manual_mark(self.stage2().df, self.cleaned_manual())

    def final(self) -> DataFrame:
        return pl.stage3(self.ws, self.stage2(), self.reports.manual, PARAMS)


def _step(build: Callable[[_Run], DataFrame], **how: int) -> Query:
    return lambda spark, sf_dir: build(_Run(spark, sf_dir, **how))


def _with_parameters(build: Callable[[_Run], DataFrame]) -> Query:
    """The same step with user values of every weight, read through the parameter table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        given = spark.createDataFrame([(n, f" {v} ") for n, (v, _) in oracle.OTHER_PARAMETERS.items()], "Parameter string, User_Input string")
        table = pm.default_parameters(spark).drop("User_Input").join(given, "Parameter", "left")
        return build(_Run(spark, sf_dir, params=pm.load_params(table, asp_scale=6, health_scale=6, rank_scale=9)))

    return run


def _moulds_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rp.read_csv(spark, landed_csv(spark, sf_dir, ["mould"]), rp.MOULD)
    return _pick(rows.filter("sku IS NOT NULL"), ["report_date", "sku", "machine", "mould_life", "target_life"])


def _manual_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = rp.read_manual(spark, f"{landed_csv(spark, sf_dir, ['manual'])}/{MANUAL_LIST}", [date.fromisoformat(SINGLE_DATE)])
    cleaned = ov.clean_manual(raw).withColumnRenamed("entry_no", "place")
    return _pick(cleaned, ["sku", "description", "market", "quantity", "highest_priority", "place"])


def _manual_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each part of the manual list has its columns, and how many files say so."""
    columns = rp.manual_columns(spark, f"{landed_csv(spark, sf_dir, ['manual'])}/{MANUAL_LIST}")
    part = F.regexp_extract("file", "/([a-z]+)/[^/]*$", 1).alias("part")
    return columns.groupBy(part, "column_name", "is_required").agg(F.min("position").alias("first"), F.max("position").alias("last"))


def _written(build: Callable[[_Run], DataFrame], layout: dict[str, str], rank: str, fmt: str = "parquet", yearly: bool = False) -> Callable[[SparkSession, str], str]:
    """A report written to files; returns their folder."""

    def run(spark: SparkSession, sf_dir: str) -> str:
        r = _Run(spark, sf_dir, yearly)
        out = r.ws.path("report")
        write_report(r.ws.write(build(r), "final"), layout, out, rank, fmt)
        return out

    return run


def _sink(written: Callable[[SparkSession, str], str], fmt: str = "parquet") -> Query:
    """The written report read back, each row with its place in the files of its date."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = read_report(spark, written(spark, sf_dir), fmt)
        return rows.select(F.col("report_date").cast("string").alias("report_date"), F.col("SKUCode").alias("sku"), F.col("Market").alias("market"), "place")

    return run


def _sink_order(written: Callable[[SparkSession, str], str], rank: str) -> Query:
    return lambda spark, sf_dir: _shown(order_faults(spark, written(spark, sf_dir), rank))


def _unusable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left out for missing keys, counted by a whole run on its way."""
    r = _Run(spark, sf_dir)
    left_out = LeftOut()
    r.reports = replace(left_out.watch(r.reports), manual=left_out.watch_manual(r.reports.manual))
    r.final().write.format("noop").mode("overwrite").save()
    return left_out.counts(spark)


def _priority(r: _Run) -> DataFrame:
    parts = {
        "by_market": "market_weight",
        "by_penetration": "penetration",
        "by_requirement": "requirement",
        "by_top": "top_flag",
    }
    rows = r.expanded(r.demand_scored())
    return rows.select(
        "report_date", "sku", *[F.col(f"priority.{c}").alias(n) for n, c in parts.items()]
    )


def _manual_union(r: _Run) -> DataFrame:
    parts = r.override()
    return ov.hybrid_union(pl.manual_part(parts), pl.automated_part(parts))


def planner_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter table whose user values are figures taken from the tables."""
    segment = {"AUTOMOBILE": "OE", "MACHINERY": "ST", "FURNITURE": "EXP", "HOUSEHOLD": "RE"}
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    weights = (
        customers.filter(F.col("c_mktsegment").isin(list(segment)))
        .groupBy("c_mktsegment")
        .agg(F.concat(F.lit(" "), F.count("*").cast("string"), F.lit(".5 ")).alias("User_Input"))
        .select(
            F.concat(F.lit("MARKET_WEIGHTS_"), case_of(F.col("c_mktsegment"), segment)).alias(
                "Parameter"
            ),
            "User_Input",
        )
    )
    highest = F.floor(F.max("l_extendedprice")).cast("string")
    asp = lines.agg(F.concat(highest, F.lit(".75")).alias("User_Input"))
    share = (F.count("*") % 19 + 80).cast("string")
    efficiency = lines.agg(F.concat(F.lit("0."), share).alias("User_Input"))
    blank = parts.agg(F.when(F.count("*") > 0, F.lit("  ")).alias("User_Input"))
    answers = weights
    for name, df in [
        ("DEFAULT_ASP", asp), ("EFFICIENCY_FACTOR", efficiency), ("DEFAULT_CURE_TIME", blank)
    ]:
        answers = answers.unionByName(df.select(F.lit(name).alias("Parameter"), "User_Input"))
    defaults = pm.default_parameters(spark).drop("User_Input")
    return defaults.join(answers, "Parameter", "left")


def _params(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = pm.resolve_parameters(planner_answers(spark, sf_dir))
    return resolved.toDF(*[c.lower() for c in resolved.columns])


def _date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = cal.complete_dates(cal.report_files(spark, landed_csv(spark, sf_dir, DAILY_SHEETS)))
    span = landed(spark, sf_dir, yearly=True, names=["bor"]).tables["bor"]
    first, last = span.agg(F.min("report_date"), F.max("report_date")).first()
    days = cal.date_range(spark, first, last)
    marked = days.join(complete.withColumn("complete", F.lit(True)), "report_date", "left")
    return _shown(marked.withColumn("complete", F.coalesce("complete", F.lit(False))))


def _stage1_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First stage from dated CSV files, over the complete dates of a range."""
    base = landed_csv(spark, sf_dir, [*DAILY_SHEETS, "mould", "dispatch", "curing"])
    span = landed(spark, sf_dir, yearly=True, names=["bor"]).tables["bor"]
    first, last = span.agg(F.min("report_date"), F.max("report_date")).first()
    dates = cal.runnable_dates(spark, base, first, last)
    reports = rp.read_reports(spark, base, dates)
    rows = pl.stage1(Workspace(spark), reports, PARAMS)
    return _shown(layouts.to_report(rows.df, layouts.STAGE1))


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(cal.complete_dates(cal.report_files(spark, landed_csv(spark, sf_dir, DAILY_SHEETS))))


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rp.read_csv(spark, landed_csv(spark, sf_dir, ["bor"]), rp.BOR)
    return _pick(
        rows, ["report_date", "sku", "description", "loc", "norm", "virtual_norm", "stock"]
    )


def _promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rp.read_promoted(spark, landed_csv(spark, sf_dir, ["bmr"]), rp.BMR)
    kept = rows.filter(F.col("plant") == dm.PLANT)
    return _pick(kept, ["report_date", "plant", "sku", "requirement", "penetration"])


def queries() -> dict[str, Query]:
    o = oracle
    steps: dict[str, Callable[[_Run], DataFrame]] = {
        "inventory_counts": lambda r: _shown(inv.colour_counts(r.reports.bpr)),
        "inventory_pivot": lambda r: _shown(inv.colour_pivot(r.reports.bpr)),
        "inventory_score": lambda r: _shown(inv.inventory_score(r.reports.bpr, PARAMS)),
        "demand_signals": lambda r: _pick(r.signals(), o.SIGNALS),
        "demand_topsku_join": lambda r: _pick(
            r.expanded(r.marked()), [*o.SIGNALS, "top_sku"]
        ),
        "export_demand": lambda r: _shown(dm.export_rows(r.reports.bmr).drop("copies")),
        "demand_combined": lambda r: _pick(r.expanded(r.demand()), o.DEMAND),
        "rim_size": lambda r: _pick(r.expanded(r.demand()), ["report_date", "sku", "size"]),
        "demand_norm": lambda r: _pick(
            r.expanded(r.demand_scored()),
            ["report_date", "sku", "market", "norm_penetration", "norm_requirement"],
        ),
        "demand_score": lambda r: _pick(
            r.expanded(r.demand_scored()),
            ["report_date", "sku", "market", "market_weight", "top_flag", "demand_score"],
        ),
        "priority_struct": lambda r: _shown(_priority(r)),
        "inventory_norm": lambda r: _pick(
            r.scored(), ["report_date", "sku", "market", "inventory", "norm_inventory"]
        ),
        "asp_by_sku": lambda r: _shown(rev.asp_by_sku(r.reports.dispatch, PARAMS)),
        "cure_time_by_sku": lambda r: _shown(rev.cure_time_by_sku(r.reports.curing)),
        "revenue_potential": lambda r: _pick(r.expanded(r.attributed()), o.REVENUE),
        "price_priority": lambda r: _pick(
            r.scored(), ["report_date", "sku", "market", "rev_pot", "price_priority"]
        ),
        "consolidated_rank": lambda r: _pick(
            r.stage1().df, ["report_date", "sku", "market", "consolidated", "demand_rank"]
        ),
        "stage1_report": lambda r: _shown(layouts.to_report(r.stage1().df, layouts.STAGE1)),
        "mould_summary": lambda r: _shown(r.moulds()),
        "ghost_skus": lambda r: _pick(dp.ghost_rows(r.stage1().df, r.moulds()), o.GHOSTS),
        "deployment_join": lambda r: _pick(
            dp.with_deployment(r.stage1().df, r.moulds()),
            ["report_date", "sku", "market", "requirement", "machine_count", "mould_health",
             "is_ghost"],
        ),
        "proxy_rank": lambda r: _pick(
            r.stage2().df,
            ["report_date", "sku", "market", "machine_count", "consolidated", "proxy",
             "proxy_rank"],
        ),
        "gap_flags": lambda r: _pick(
            r.stage2().df,
            ["report_date", "sku", "market", "demand_rank", "machine_count", "mould_health",
             "critical_gap", "excess_production", "mould_alert"],
        ),
        "deployment_report": lambda r: _shown(layouts.to_report(r.stage2().df, layouts.STAGE2)),
        "stage2_summary": lambda r: _shown(sm.stage2_summary(r.stage2().df)),
        "proxy_range": lambda r: _shown(sm.proxy_range(r.stage2().df)),
        "top_k_priority": lambda r: _pick(
            sm.top_rows(r.stage2().df, 5),
            ["report_date", "sku", "market", "machine_count", "consolidated", "proxy",
             "proxy_rank"],
        ),
        "top_critical_gaps": lambda r: _pick(
            sm.top_rows(r.stage2().df, 5, F.col("critical_gap")),
            ["report_date", "sku", "market", "demand_rank", "machine_count"],
        ),
        "manual_clean": lambda r: _shown(r.cleaned_manual()),
        "manual_rank": lambda r: _pick(
            r.override().manual.df,
            ["report_date", "sku", "market", "manual_score", "manual_rank"],
        ),
        "manual_prior_requirement": lambda r: _pick(
            ov.prior_facts(ov.superseded_rows(r.marked_gaps())),
            ["report_date", "sku", "prior_requirement"],
        ),
        "manual_rows": lambda r: _pick(pl.manual_part(r.override()), o.MANUAL_ROWS),
        "superseded_rows": lambda r: _pick(
            ov.superseded_rows(r.marked_gaps()),
            ["report_date", "sku", "market", "requirement", "demand_rank"],
        ),
        "superseded_removed": lambda r: _pick(
            ov.remaining_rows(r.marked_gaps()),
            ["report_date", "sku", "market", "requirement", "proxy_rank"],
        ),
        "automated_rerank": lambda r: _pick(
            pl.automated_part(r.override()),
            ["report_date", "sku", "market", "requirement", "proxy_rank"],
        ),
        "hybrid_union": lambda r: _pick(_manual_union(r), o.UNION),
        "strategic_score": lambda r: _pick(
            ov.with_strategic_score(_manual_union(r)),
            ["report_date", "sku", "market", "source", "strategic"],
        ),
        "overstock_penalty": lambda r: _pick(
            pl.overstock_rows(r.override(), PARAMS),
            ["report_date", "sku", "market", "source", "penetration", "strategic",
             "is_overstock"],
        ),
        "final_rank": lambda r: _pick(
            r.final(), ["report_date", "sku", "market", "source", "final_rank"]
        ),
        "hybrid_report": lambda r: _shown(layouts.to_report(r.final(), layouts.STAGE3)),
        "hybrid_report_no_manual": lambda r: _shown(
            layouts.to_report(ov.without_manual(r.stage2()), layouts.STAGE3_NO_MANUAL)
        ),
        "stage3_summary": lambda r: _shown(sm.stage3_summary(r.final())),
    }
    stage1_rows = lambda r: r.stage1().df
    stage2_rows = lambda r: r.stage2().df
    # so few scores to a slice that every date has many, as a large one has
    in_slices = {
        "rank_range_stage1": "consolidated_rank",
        "rank_range_proxy": "proxy_rank",
        "rank_range_final": "final_rank",
    }
    return {n: _step(build) for n, build in steps.items()} | {
        n: _step(steps[like], slice_rows=FEW_ROWS) for n, like in in_slices.items()
    } | {
        "top_k_per_date": _step(
            lambda r: _pick(sm.top_rows(r.stage2().df, 5), ["report_date", "sku", "market", "machine_count", "demand_rank"]),
            yearly=True,
        ),
        "stage1_with_parameters": _with_parameters(steps["stage1_report"]),
        "deployment_with_parameters": _with_parameters(steps["deployment_report"]),
        "src_mould_csv": _moulds_csv,
        "src_manual_csv": _manual_csv,
        "src_manual_columns": _manual_columns,
        "sink_read_back": _sink(_written(_Run.final, layouts.STAGE3, "final_rank", "csv"), "csv"),
        "sink_stage1": _sink(_written(stage1_rows, layouts.STAGE1, "demand_rank", yearly=True)),
        "sink_stage2": _sink(_written(stage2_rows, layouts.STAGE2, "proxy_rank")),
        "sink_stage1_order": _sink_order(_written(stage1_rows, layouts.STAGE1, "demand_rank", yearly=True), layouts.STAGE1["demand_rank"]),
        "sink_stage2_order": _sink_order(_written(stage2_rows, layouts.STAGE2, "proxy_rank"), layouts.STAGE2["proxy_rank"]),
        "unusable_rows": _unusable,
        "src_dated_reports": _dated,
        "src_promote_header": _promoted,
        "gate_complete_dates": _gate,
        "date_range_dates": _date_range,
        "stage1_date_range": _stage1_range,
        "params_resolve": _params,
    }
