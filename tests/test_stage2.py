from datetime import date

import pytest
from frames import DAY, bor_row, reports, sku

from prodseq.operators import deployment as dp
from prodseq.operators import summary as sm
from prodseq.plans.params import Params
from prodseq.plans.pipeline import stage1, stage2

A, B, C, G = (sku(i) for i in (1, 2, 3, 9))
PARAMS = Params()


def run(ws, spark, mould, params=PARAMS, **tables):
    r = reports(spark, mould=mould, **tables)
    return stage2(ws, stage1(ws, r, params), params).df


def machines(s, n, life=10.0, target=50.0, day=DAY):
    return [(day, s, f"WC{i}", life, target) for i in range(n)]


def test_penalty_by_machines(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 4), (1.0, 25)], "consolidated double, machine_count long")
    proxy = [round(r["proxy"], 9) for r in dp.with_proxy_score(df, PARAMS).collect()]
    assert proxy == [1.0, 0.8, 0.0]


def test_mould_summary_counts_machines_once(spark):
    rows = [
        (DAY, A, "WC1", 10.0, 50.0), (DAY, A, "WC1", 30.0, 50.0), (DAY, A, None, 20.0, 50.0),
        (DAY, B, "WC1", 10.0, 0.0), (DAY, None, "WC1", 1.0, 1.0),
    ]
    table = dp.mould_summary(reports(spark, mould=rows).mould, PARAMS)
    found = {r["sku"]: (r["machine_count"], r["mould_health"]) for r in table.collect()}
    assert found == {A: (1, pytest.approx(0.4)), B: (1, None)}


def test_ghost_rows_get_half_the_lowest_score(ws, spark):
    df = run(ws, spark, machines(G, 3, life=48.0), bor=[bor_row(A), bor_row(B, stock=50.0)])
    rows = {r["sku"]: r for r in df.collect()}
    ghost, low = rows[G], min(rows[A]["consolidated"], rows[B]["consolidated"])
    assert ghost["consolidated"] == low * 0.5 and ghost["is_ghost"]
    assert ghost["demand_rank"] is None and ghost["cure_time"] == 20.0 and ghost["market"] == "RE"
    assert not ghost["critical_gap"] and not ghost["excess_production"] and ghost["mould_alert"]
    assert ghost["stock"] == 0 and ghost["top_sku"] is None and ghost["size"] == 15
    assert ghost["proxy_rank"] == 3


def test_ghost_score_floor_value(spark):
    demand = spark.createDataFrame([(DAY, A, 0.4), (DAY, B, 0.9)], "report_date date, sku string, consolidated double")
    summary = spark.createDataFrame([(DAY, G, 1, 0.1)], "report_date date, sku string, machine_count long, mould_health double")
    assert dp.ghost_rows(demand, summary).first()["consolidated"] == 0.2


def test_ghosts_only_on_dates_with_demand(ws, spark):
    df = run(ws, spark, machines(G, 1, day=date(2026, 1, 3)), bor=[bor_row(A)])
    assert [r["sku"] for r in df.collect()] == [A]


def test_ghost_without_health_raises_no_alert(ws, spark):
    df = run(ws, spark, machines(G, 1, target=0.0), bor=[bor_row(A)])
    ghost = {r["sku"]: r for r in df.collect()}[G]
    assert ghost["mould_health"] is None and ghost["mould_alert"] is False


def test_no_mould_report(ws, spark):
    for mould in (None, []):
        rows = run(ws, spark, mould, bor=[bor_row(A), bor_row(B)]).collect()
        assert len(rows) == 2
        assert all(r["machine_count"] == 0 and r["mould_health"] == 0 for r in rows)
        assert all(r["critical_gap"] for r in rows)


def test_excess_production(ws, spark):
    params = Params(excess_production_rank=1, critical_gap_rank=1)
    rows = run(
        ws, spark, machines(B, 3) + machines(C, 2), params,
        bor=[bor_row(A), bor_row(B, stock=50.0), bor_row(C, stock=60.0)],
    ).collect()
    flags = {r["sku"]: (r["critical_gap"], r["excess_production"]) for r in rows}
    assert flags == {A: (True, False), B: (False, True), C: (False, False)}


def test_flags_use_proxy_rank_without_a_demand_rank(spark):
    df = spark.createDataFrame([(1, 0, 0.95)], "proxy_rank long, machine_count long, mould_health double")
    row = dp.with_gap_flags(df, PARAMS).first()
    assert row["critical_gap"] and row["mould_alert"] and not row["excess_production"]


def test_summary(ws, spark):
    df = run(ws, spark, machines(A, 1) + machines(G, 1, life=50.0), bor=[bor_row(A), bor_row(B)])
    row = sm.stage2_summary(df).first().asDict()
    row.pop("report_date")
    assert row == {
        "critical_gaps": 1, "excess_production": 0, "mould_alerts": 1, "ghost_skus": 1,
        "in_production": 2, "not_in_production": 1, "rows_analyzed": 3,
    }
