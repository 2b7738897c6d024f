"""The three stages, over all dates at once."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodseq.functions import rounded
from prodseq.operators import demand as dm
from prodseq.operators import deployment as dp
from prodseq.operators import inventory as inv
from prodseq.operators import override as ov
from prodseq.operators import revenue as rev
from prodseq.operators import scoring as sc
from prodseq.operators.ranking import Rows, stored_rows, with_rank
from prodseq.plans.params import Params
from prodseq.plans.workspace import Workspace
from prodseq.sources.reports import Reports


def demand_rows(ws: Workspace, reports: Reports) -> DataFrame:
    """Written demand rows of every date; rows that repeat are held as ``copies``.

    Products, scores and maxima are all taken from this table, so the demand reports are
    parsed once.
    """
    rows = dm.combined_demand(
        dm.with_top_sku(dm.domestic_signals(reports.bor), reports.bpr),
        dm.export_rows(reports.bmr),
    )
    return ws.write(rows.drop("loc"), "signals")


def product_attributes(
    ws: Workspace, demand: DataFrame, reports: Reports, params: Params, moulds: DataFrame | None = None
) -> DataFrame:
    """Written table of one row per date and product in demand."""
    table = sc.sku_attributes(
        demand,
        inv.inventory_score(reports.bpr, params),
        rev.asp_by_sku(reports.dispatch, params),
        rev.cure_time_by_sku(reports.curing),
        params,
        moulds,
    )
    return ws.write(table, "attributes")


def scored_demand(demand: DataFrame, attributes: DataFrame, params: Params) -> DataFrame:
    """Demand rows with every score; rows that repeat are still held as ``copies``."""
    rows = sc.with_attributes(dm.with_market_columns(demand, params), attributes)
    return sc.with_consolidated_score(sc.with_demand_score(rows, params), params)


@dataclass(frozen=True)
class Ranking:
    """First-stage result, with what the second stage can reuse."""

    rows: Rows
    products: DataFrame  # date and product pairs in demand
    moulds: DataFrame | None  # mould summary, if the reports had moulds

    @property
    def df(self) -> DataFrame:
        return self.rows.df


def stage1(ws: Workspace, reports: Reports, params: Params) -> Ranking:
    """Demand ranking of every date.

    If the reports include moulds, their summary is joined to the product table,
    not to the demand rows.
    """
    moulds = None
    # moulds and demand do not wait for each other
    with ThreadPoolExecutor(1) as pool:
        written = None
        if reports.mould is not None:
            summary = dp.mould_summary(reports.mould, params)
            written = pool.submit(ws.write, summary, "moulds")
        # two steps read the buffer report: its used rows and columns are parsed once
        used = reports.bpr.filter(dm.marks_top_sku() | inv.is_stock_out())
        reports = replace(reports, bpr=ws.write(used, "buffer"))
        demand = demand_rows(ws, reports)
        if written is not None:
            moulds = written.result()
    attributes = product_attributes(ws, demand, reports, params, moulds)
    rows = stored_rows(ws, scored_demand(demand, attributes, params), "demand")
    score = rounded(F.col("consolidated"), params.rank_scale)
    ranked = rows.using(with_rank(rows, score, "demand_rank"))
    return Ranking(ranked, attributes.select("report_date", "sku"), moulds)


def deployed_rows(ranking: Ranking) -> DataFrame:
    """Ranked demand with machines, and ghost rows below it."""
    deployed = dp.with_deployment(ranking.df, ranking.moulds)
    if ranking.moulds is None:
        return deployed
    return dp.with_ghosts(deployed, dp.ghost_rows(ranking.df, ranking.moulds, ranking.products))


def stage2(ws: Workspace, ranking: Ranking, params: Params) -> Rows:
    """Gap analysis of the demand ranking against machines."""
    rows = stored_rows(ws, dp.with_proxy_score(deployed_rows(ranking), params), "deployment")
    flagged = dp.with_gap_flags(dp.with_proxy_rank(rows, params), params)
    return rows.using(dp.filled(flagged))


@dataclass(frozen=True)
class Override:
    """Parts of the third stage."""

    manual: Rows  # cleaned and ranked entries of dates that have a report
    counts: DataFrame  # entries per date
    stage2: Rows  # second-stage rows of dates with entries, marked where superseded
    rest: Rows | None  # second-stage rows of dates without


def manual_entries(ws: Workspace, manual: DataFrame) -> Rows:
    """Cleaned entries with their score, written."""
    return stored_rows(ws, ov.with_manual_score(ov.clean_manual(manual)), "manual")


def prepare_override(ws: Workspace, gaps: Rows, entries: Rows) -> Override:
    """Mark and write the ranked rows in one pass; all later steps read what it wrote."""
    marked = gaps.using(ws.write(ov.with_manual_mark(gaps.df, entries.df), "gaps"))
    dates = marked.df.select("report_date").distinct()
    # One row per calendar day on the broadcast side.
    asked = entries.using(entries.df.join(F.broadcast(dates), "report_date", "left_semi"))
    ranked = asked.using(ov.with_manual_rank(asked))
    counts = asked.df.groupBy("report_date").agg(F.count("*").alias("n_manual"))
    if dates.join(F.broadcast(counts), "report_date", "left_anti").isEmpty():
        return Override(ranked, counts, marked, None)
    with_entries = marked.df.join(F.broadcast(counts), "report_date", "left_semi")
    without = marked.df.join(F.broadcast(counts), "report_date", "left_anti")
    return Override(ranked, counts, marked.using(with_entries), marked.using(ov.as_stored(without)))


def manual_part(parts: Override) -> DataFrame:
    facts = ov.prior_facts(ov.superseded_rows(parts.stage2.df))
    return ov.manual_rows(parts.manual.df, facts)


def automated_part(parts: Override) -> DataFrame:
    remaining = ov.remaining_rows(parts.stage2.df)
    return ov.automated_rows(parts.stage2.using(remaining), parts.counts)


def hybrid_rows(parts: Override) -> DataFrame:
    """Manual and automated rows with strategic score and overstock mark, unordered."""
    both = ov.hybrid_union(manual_part(parts), automated_part(parts))
    return ov.with_overstock(ov.with_strategic_score(both))


def overstock_rows(parts: Override, params: Params) -> DataFrame:
    """The whole overstock rule: hybrid rows with lowered scores, normal ones by score and then
    overstocked ones by penetration, for each date.

    The final rank numbers rows in this order, so it starts from unordered ones.
    """
    return ov.in_final_order(hybrid_rows(parts), params.rank_scale)


def stage3(ws: Workspace, gaps: Rows, manual: DataFrame, params: Params) -> DataFrame:
    """Final sequence: manual orders by boosted score, overstock last.

    A date without manual entries keeps its second-stage rows and order.
    """
    entries = manual_entries(ws, manual)
    if entries.df.isEmpty():
        return ov.without_manual(gaps)
    parts = prepare_override(ws, gaps, entries)
    rows = parts.stage2.using(hybrid_rows(parts))
    final = ov.with_final_rank(rows, params.rank_scale)
    if parts.rest is None:
        return final
    return final.unionByName(ov.without_manual(parts.rest), allowMissingColumns=True)
