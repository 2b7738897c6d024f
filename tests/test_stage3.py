from datetime import date
from types import SimpleNamespace

import pytest
from frames import DAY, MANUAL, bor_row, manual_row, reports, sku

from prodseq.fixtures import queries
from prodseq.operators import override as ov
from prodseq.plans import layouts
from prodseq.plans.params import Params
from prodseq.plans.pipeline import stage1, stage2, stage3

A, B, C, D, G, M = (sku(i) for i in (1, 2, 3, 4, 9, 20))
PARAMS = Params()
NEXT = date(2026, 1, 3)


def run(ws, spark, manual, mould=(), **tables):
    r = reports(spark, mould=mould, manual=manual, **tables)
    gaps = stage2(ws, stage1(ws, r, PARAMS), PARAMS)
    return stage3(ws, gaps, r.manual, PARAMS)


def in_order(df):
    return df.orderBy("report_date", "final_rank").collect()


def test_manual_rows_lead_and_replace_every_market(ws, spark):
    df = run(
        ws,
        spark,
        [manual_row(A, quantity=7.0), manual_row(M, level=1, entry=2)],
        bor=[bor_row(A, norm=80.0), bor_row(A, "1300_FG10", 300.0, 20.0), bor_row(B)],
    )
    rows = in_order(df)
    assert [(r["sku"], r["source"]) for r in rows] == [(M, "Manual"), (A, "Manual"), (B, "Automated")]
    assert [r["final_rank"] for r in rows] == [1, 2, 3]
    assert [r["strategic"] for r in rows[:2]] == [11.0, 10.0]
    a, m, b = rows[1], rows[0], rows[2]
    # The OE row ranks above the replacement row, so its requirement is shown.
    assert a["prior_requirement"] == 80 and a["requirement"] == 7 and a["manual_requirement"] == 7
    assert m["prior_requirement"] == 0 and m["critical_gap"]
    assert b["proxy_rank"] == 3 and b["prior_requirement"] == b["requirement"]
    assert b["manual_requirement"] == 0 and b["manual_rank"] == 0 and b["top_sku"] == ""


def test_unranked_rows_come_last_in_the_prior_lookup(spark):
    rows = [(DAY, A, A, None, "RE", 5.0, 1, 0.1), (DAY, A, A, 4, "ST", 6.0, 1, 0.1)]
    schema = (
        "report_date date, sku string, raw_sku string, demand_rank long, market string,"
        " requirement double, machine_count long, mould_health double"
    )
    assert ov.prior_facts(spark.createDataFrame(rows, schema)).first()["prior_requirement"] == 6


def test_codes_are_matched_trimmed_but_machines_as_stored(ws, spark):
    padded = f" {A}"
    mould = [(DAY, padded, "WC1", 48.0, 50.0)]
    rows = in_order(run(ws, spark, [manual_row(f"{A}\t")], mould=mould, bor=[bor_row(padded), bor_row(B)]))
    assert [r["sku"] for r in rows] == [A, B]
    assert rows[0]["prior_requirement"] == 100 and rows[0]["machine_count"] == 0


def test_machines_of_manual_products(ws, spark):
    mould = [(DAY, A, "WC1", 48.0, 50.0), (DAY, A, "WC2", 48.0, 50.0)]
    row = in_order(run(ws, spark, [manual_row(A)], mould=mould, bor=[bor_row(A), bor_row(B)]))[0]
    assert (row["machine_count"], row["mould_alert"], row["critical_gap"]) == (2, True, False)


def test_overstock_goes_last_by_penetration(ws, spark):
    bmr = [(DAY, "1300", C, 500.0, 150.0), (DAY, "1300", D, 400.0, 120.0)]
    rows = in_order(run(ws, spark, [manual_row(M)], bor=[bor_row(A, stock=90.0)], bmr=bmr))
    assert [r["sku"] for r in rows] == [M, A, D, C]
    assert [r["strategic"] for r in rows[2:]] == [0.0, 0.0]
    assert [r["is_overstock"] for r in rows] == [False, False, True, True]


def test_overstock_query_puts_rows_in_order(spark, monkeypatch):
    bmr = [(DAY, "1300", C, 500.0, 150.0), (DAY, "1300", D, 400.0, 120.0), (DAY, "1300", G, 300.0, 110.0)]
    bor = [bor_row(A, stock=90.0), bor_row(B, stock=50.0)]
    made = reports(spark, mould=[], manual=[manual_row(M), manual_row(sku(21), level=1, entry=2)], bor=bor, bmr=bmr)
    monkeypatch.setattr(queries, "landed", lambda *_: SimpleNamespace(reports=lambda: made))
    rows = queries.queries()["overstock_penalty"](spark, "").collect()
    assert [r["sku"] for r in rows] == [sku(21), M, B, A, G, D, C]
    assert [r["is_overstock"] for r in rows] == [False] * 4 + [True] * 3
    assert [r["strategic"] for r in rows[:2]] == [11.0, 10.0] and {r["strategic"] for r in rows[4:]} == {0.0}


def test_manual_rank_order(ws, spark):
    entries = [
        manual_row(A, 5.0, 0, entry=1), manual_row(B, 9.0, 0, entry=2),
        manual_row(C, 1.0, 1, entry=3), manual_row(D, 5.0, 0, entry=4),
    ]
    rows = in_order(run(ws, spark, entries, bor=[bor_row(M)]))
    assert [r["sku"] for r in rows] == [C, B, A, D, M]


def test_repeated_manual_products_stay(ws, spark):
    rows = in_order(run(ws, spark, [manual_row(A, 1.0, entry=1), manual_row(A, 2.0, entry=2)], bor=[bor_row(A)]))
    assert [(r["sku"], r["requirement"], r["prior_requirement"]) for r in rows] == [(A, 2, 100), (A, 1, 100)]


def test_empty_manual_list_keeps_second_stage_order(ws, spark):
    mould = [(DAY, G, "WC1", 1.0, 50.0), (DAY, A, "WC1", 1.0, 50.0)]
    bmr = [(DAY, "1300", C, 500.0, 150.0)]
    df = run(ws, spark, [], mould=mould, bor=[bor_row(A), bor_row(B, stock=50.0)], bmr=bmr)
    rows = in_order(df)
    assert [r["sku"] for r in rows][-1] == G  # ghosts last, although the export row is overstocked
    ranks = [r["demand_rank"] for r in rows[:-1]]
    assert ranks == sorted(ranks) and {r["source"] for r in rows} == {"Automated"}
    shown = layouts.to_report(df, layouts.STAGE3_NO_MANUAL)
    assert shown.columns[1] == "Final Rank" and shown.columns[-1] == "Source"


def test_dates_with_and_without_manual_entries(ws, spark):
    bmr = [(d, "1300", C, 500.0, 150.0) for d in (DAY, NEXT)]
    bor = [bor_row(A, stock=90.0, day=d) for d in (DAY, NEXT)]
    rows = in_order(run(ws, spark, [manual_row(M)], bor=bor, bmr=bmr))
    first = [(r["sku"], r["final_rank"]) for r in rows if r["report_date"] == DAY]
    second = [(r["sku"], r["final_rank"], r["strategic"]) for r in rows if r["report_date"] == NEXT]
    assert first == [(M, 1), (A, 2), (C, 3)]
    assert len(second) == 2 and [r[2] for r in second] == [None, None]
    assert [r[1] for r in second] == [1, 2]


def test_manual_entries_of_dates_without_a_report_are_ignored(ws, spark):
    rows = in_order(run(ws, spark, [manual_row(M, day=NEXT)], bor=[bor_row(A)]))
    assert [r["sku"] for r in rows] == [A]


def test_manual_cleaning(spark):
    raw = spark.createDataFrame(
        [(DAY, f"  {A} ", " OE ", "x", "1", 1), (DAY, "  ", "OE", "3", "1", 2), (DAY, B, "ST", "4.5", "y", 3)],
        "report_date date, ` SKU Code ` string, Market string, Quantity string, `Highest Priority` string, entry_no long",
    )
    rows = ov.clean_manual(raw).orderBy("entry_no").collect()
    assert [(r["sku"], r["market"], r["quantity"], r["highest_priority"]) for r in rows] == [
        (A, "OE", 0.0, 1),
        (B, "ST", 4.5, 0),
    ]
    assert rows[0]["description"] == ""


def test_manual_priority_is_not_limited(spark):
    raw = spark.createDataFrame([manual_row(A, level=3)], MANUAL)
    assert ov.with_manual_score(ov.clean_manual(raw)).first()["manual_score"] == 13.0


def test_missing_manual_columns_are_named(spark):
    raw = spark.createDataFrame([("x",)], "`SKU Code` string")
    with pytest.raises(ValueError, match="Quantity.*Market.*Highest Priority"):
        ov.clean_manual(raw)


def test_high_weights_can_beat_manual_rows(ws, spark):
    params = Params(market_weights={"OE": 400, "ST": 3, "EXP": 2, "RE": 1})
    r = reports(spark, bor=[bor_row(A)], manual=[manual_row(M)], mould=[])
    gaps = stage2(ws, stage1(ws, r, params), params)
    final = stage3(ws, gaps, r.manual, params)
    assert [x["sku"] for x in in_order(final)] == [A, M]
    from prodseq.operators.summary import stage3_summary

    assert stage3_summary(final).first()["automated_above_manual_floor"] == 1
