"""Runs whose every date is cut into many slices equal runs with one slice per date."""

from dataclasses import replace
from datetime import date

import pytest
from frames import bor_row, bpr_row, manual_row, reports, sku
from pyspark.sql import functions as F

from prodseq.fixtures.queries import PARAMS
from prodseq.fixtures.views import landed
from prodseq.plans import layouts
from prodseq.plans.params import Params
from prodseq.plans.pipeline import stage1, stage2, stage3

SF_DIR = "/root/testdata/sf0.001"


def final(ws, r, params=PARAMS):
    gaps = stage2(ws, stage1(ws, r, params), params)
    shown = layouts.to_report(stage3(ws, gaps, r.manual, params), layouts.STAGE3)
    return shown.drop("priority")


def same(left, right):
    rounded = [
        [F.round(F.col(f"`{n}`"), 6).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
        for df in (left, right)
    ]
    left, right = left.select(rounded[0]), right.select(rounded[1])
    assert left.count() == right.count() > 0
    assert left.exceptAll(right).isEmpty()


def test_one_large_date(spark, ws, tiny_tasks):
    r = landed(spark, SF_DIR).reports()
    same(final(tiny_tasks, r), final(ws, r))


def test_many_dates_some_without_manual_entries(spark, ws, tiny_tasks):
    r = landed(spark, SF_DIR, yearly=True).reports()
    days = [date(y, 1, 1) for y in (1996, 1998, 2030)]
    manual = r.manual.withColumn("report_date", F.explode(F.array(*[F.lit(d) for d in days])))
    r = replace(r, manual=manual)
    plain = final(ws, r)
    same(final(tiny_tasks, r), plain)
    per_date = plain.groupBy("report_date").agg(
        F.count("*").alias("n"),
        F.count_distinct("Final Rank").alias("ranks"),
        F.max("Final Rank").alias("last"),
        F.count_if(F.col("Source") == "Manual").alias("manual"),
    )
    rows = per_date.collect()
    assert len(rows) == 7 and all(r["n"] == r["ranks"] == r["last"] for r in rows)
    assert {r["report_date"] for r in rows if r["manual"] > 0} == set(days[:2])


def test_sequence_properties(spark, ws):
    r = landed(spark, SF_DIR).reports()
    ranking = stage1(ws, r, PARAMS)
    gaps = stage2(ws, ranking, PARAMS)
    done = stage3(ws, gaps, r.manual, PARAMS).cache()
    ghosts = gaps.df.filter("is_ghost").count()
    assert gaps.df.count() == ranking.df.count() + ghosts
    manual = done.filter("source = 'Manual'").select("sku")
    assert done.filter("source = 'Automated'").join(manual, "sku", "left_semi").isEmpty()
    removed = gaps.df.join(manual, "sku", "left_semi").count()
    assert done.count() == gaps.df.count() - removed + manual.count()
    done.unpersist()


@pytest.mark.parametrize("limit", [1, 1000])
def test_one_product_holds_most_rows(spark, ws, tiny_tasks, limit):
    """One SKU x location repeated, with repeated buffer rows and a manual entry."""
    hot, other = sku(1), sku(2)
    space = replace(tiny_tasks, slice_rows=limit)
    r = reports(
        spark,
        bor=[bor_row(hot, norm=100.0 + i % 3) for i in range(30)] + [bor_row(other), bor_row(hot, "1300_ST10")],
        bpr=[bpr_row(hot)] * 7 + [bpr_row(hot, top="F")] * 2 + [bpr_row(other)],
        mould=[(date(2026, 1, 2), hot, "WC1", 1.0, 50.0)],
        manual=[manual_row(other)],
    )
    ranking = stage1(space, r, Params())
    assert ranking.df.filter(F.col("sku") == hot).count() == 30 * 9 + 1
    ranks = {x["demand_rank"]: x["count"] for x in ranking.df.groupBy("demand_rank").count().collect()}
    assert sum(ranks.values()) == 30 * 9 + 2
    # Ranks are dense over group sizes: each rank is one more than the rows before it.
    before = 0
    for rank in sorted(ranks):
        assert rank == before + 1
        before += ranks[rank]
    done = stage3(space, stage2(space, ranking, Params()), r.manual, Params())
    places = sorted(x[0] for x in done.select("final_rank").collect())
    assert places == list(range(1, 30 * 9 + 3))
