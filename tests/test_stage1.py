import pytest
from frames import DAY, bor_row, bpr_row, reports, sku
from pyspark.sql import functions as F

from prodseq.operators import demand as dm
from prodseq.operators import inventory as inv
from prodseq.operators import revenue as rev
from prodseq.plans.params import Params
from prodseq.plans.pipeline import stage1

A, B, C, D, E = (sku(i) for i in range(1, 6))
PARAMS = Params()


def run(ws, spark, **tables):
    rows = stage1(ws, reports(spark, **tables), PARAMS).df.collect()
    return {r["sku"]: r for r in rows}, rows


def test_missing_norm_is_kept_and_reads_zero(ws, spark):
    by_sku, _ = run(ws, spark, bor=[bor_row(A, norm=None), bor_row(B)])
    row = by_sku[A]
    assert row["requirement"] == 0 and row["virtual_norm"] == 0
    assert row["demand_score"] == 0  # a missing part makes the whole demand score 0
    assert row["priority"]["requirement"] is None  # the tuple is built before the fill


def test_zero_norm_has_no_depletion(spark):
    bor = reports(spark, bor=[bor_row(A, norm=0.0, stock=-5.0)]).bor
    row = dm.domestic_signals(bor).first()
    assert (row["penetration"], row["requirement"]) == (0, 5)


def test_replacement_market_halves_target(ws, spark):
    by_sku, rows = run(
        ws, spark, bor=[bor_row(A, "1300_FG10", 100.0, 40.0), bor_row(B, "1300_FG10", 100.0, 60.0)]
    )
    row = by_sku[A]
    assert (row["adjusted_target"], row["requirement"], row["penetration"]) == (50, 10, 60)
    assert len(rows) == 1  # nothing is open for the second product


@pytest.mark.parametrize("loc", ["1300_ZZ", "1300"])
def test_unknown_market_scores_zero(ws, spark, loc):
    by_sku, _ = run(ws, spark, bor=[bor_row(A, loc), bor_row(B)])
    assert by_sku[A]["market_weight"] == 0 and by_sku[A]["demand_score"] == 0


def test_unknown_token_passes_through(spark):
    bor = reports(spark, bor=[bor_row(A, "1300_ZZ_9"), bor_row(B, "1300")]).bor
    markets = {r["sku"]: r["market"] for r in dm.domestic_signals(bor).collect()}
    assert markets == {A: "ZZ", B: None}


def test_rows_without_keys_or_of_other_plants_are_left_out(spark):
    bor = reports(
        spark, bor=[bor_row(None), bor_row(A, None), bor_row(B, "1400_OE10"), bor_row(C)]
    ).bor
    assert [r["sku"] for r in dm.domestic_signals(bor).collect()] == [C]


def test_buffer_duplicates_repeat_demand_rows(ws, spark):
    _, rows = run(
        ws,
        spark,
        bor=[bor_row(A), bor_row(B)],
        bpr=[bpr_row(A), bpr_row(A), bpr_row(A, top="F"), bpr_row(B, loc="1300_ST10")],
    )
    found = sorted((r["sku"], r["top_sku"] or "-") for r in rows)
    assert found == [(A, "F"), (A, "T"), (A, "T"), (B, "-")]


def test_copies_are_cut_into_blocks(spark, tiny_tasks):
    bpr = [bpr_row(A)] * 11 + [bpr_row(B)] * 2
    rows = stage1(tiny_tasks, reports(spark, bor=[bor_row(A), bor_row(B)], bpr=bpr), PARAMS).df
    counts = {r["sku"]: r["n"] for r in rows.groupBy("sku").agg(F.count("*").alias("n")).collect()}
    assert counts == {A: 11, B: 2}
    assert rows.select("_salt").distinct().count() == 13


def test_export_rows_keep_reported_figures(ws, spark):
    by_sku, rows = run(
        ws,
        spark,
        bor=[bor_row(A)],
        bmr=[
            (DAY, "1300", B, -3.0, 150.0),
            (DAY, "1300", C, 0.0, 10.0),
            (DAY, "1300", D, None, 10.0),
            (DAY, "1400", E, 5.0, 10.0),
        ],
    )
    assert set(by_sku) == {A, B, D}
    assert by_sku[B]["requirement"] == -3 and by_sku[B]["market"] == "EXP"
    assert by_sku[B]["adjusted_target"] == 0 and by_sku[B]["top_flag"] == 1
    assert by_sku[D]["requirement"] == 0 and by_sku[D]["demand_score"] == 0


def test_only_red_buffers(spark):
    bpr = reports(spark, bpr=[bpr_row(A, place="JIT", colour="Red"), bpr_row(B, place="depot", colour="Red")]).bpr
    scores = {r["sku"]: r["inventory"] for r in inv.inventory_score(bpr, PARAMS).collect()}
    assert scores == {A: 2.5, B: 2.0}


def test_inventory_ignores_other_colours_and_unweighted_places(spark):
    bpr = reports(
        spark,
        bpr=[
            bpr_row(A, place="JIT"),
            bpr_row(A, place="JIT", colour="Yellow"),
            bpr_row(B, place="Other"),
            bpr_row(C, place=None),
            bpr_row(D, colour="black"),
        ],
    ).bpr
    scores = {r["sku"]: r["inventory"] for r in inv.inventory_score(bpr, PARAMS).collect()}
    assert scores == {A: 5.0, B: 0.0}
    pivot = {r["sku"]: r for r in inv.colour_pivot(bpr).collect()}
    assert pivot[A]["Black Count_JIT"] == 1 and pivot[A]["Red Count_PWH"] == 0
    assert pivot[B]["Black Count_JIT"] == 0


def test_no_flagged_buffers_gives_zero_share(ws, spark):
    by_sku, _ = run(ws, spark, bor=[bor_row(A)], bpr=[bpr_row(A, colour="Green")])
    assert by_sku[A]["inventory"] == 0 and by_sku[A]["norm_inventory"] == 0


def test_dispatch_price(spark):
    lines = [
        (1300, A, "1,000.00", "10"), (1300, A, "400", "2"), (1301, A, "9", "1"),
        (1300, B, "100", "1,200"), (1300, C, "100", "0"), (1300, C, "90", "3"),
        (1300, D, "12d", "1"), (1300, None, "5", "1"),
    ]
    table = rev.asp_by_sku(reports(spark, dispatch=lines).dispatch, PARAMS)
    assert {r["sku"]: r["asp"] for r in table.collect()} == {A: 150.0, B: None, C: 30.0, D: None}


def test_defaults_and_longest_cure_time(ws, spark):
    by_sku, _ = run(
        ws,
        spark,
        bor=[bor_row(A), bor_row(B)],
        dispatch=[(1300, A, "100", "1,200")],
        curing=[(A, 12.0), (A, 15.0), (B, float("nan"))],
    )
    row = by_sku[A]
    assert row["asp"] == 3000 and row["cure_time"] == 17.5 and row["daily_cure"] == 75
    assert row["rev_pot"] == 3000 * 75


def test_rank_shares_lowest_number(ws, spark):
    # Same figures give the same score; the third product has less open demand.
    rows = [bor_row(A), bor_row(B), bor_row(C, stock=50.0)]
    by_sku, _ = run(ws, spark, bor=rows)
    assert [by_sku[s]["demand_rank"] for s in (A, B, C)] == [1, 1, 3]


def test_dates_are_scored_apart(ws, spark):
    from datetime import date

    other = date(2026, 1, 3)
    _, rows = run(ws, spark, bor=[bor_row(A), bor_row(B, norm=1000.0, day=other)])
    assert {r["sku"]: (r["norm_requirement"], r["demand_rank"]) for r in rows} == {
        A: (1.0, 1),
        B: (1.0, 1),
    }


def test_all_zero_maxima_do_not_spoil_scores(ws, spark):
    by_sku, _ = run(ws, spark, bmr=[(DAY, "1300", A, None, None)], dispatch=[(1300, A, "0", "5")])
    row = by_sku[A]
    assert row["norm_requirement"] == 0 and row["demand_score"] == 0
    assert row["price_priority"] == 0 and row["consolidated"] == 0 and row["demand_rank"] == 1


@pytest.mark.parametrize(
    ("code", "size"),
    [("ABCDEFGH15XX", 15), ("ABCDEFGH5DXX", 0), ("ABCDEFGH.5XX", 0), ("ABCDEFGH7.XX", 7), ("AB", 0)],
)
def test_rim_size(spark, code, size):
    from prodseq.functions import rim_size

    assert spark.createDataFrame([(code,)], "sku string").select(rim_size(F.col("sku"))).first()[0] == size
