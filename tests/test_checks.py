"""Counts of rows left out, and the order of written reports."""

from dataclasses import replace
from datetime import date

from frames import DAY, bor_row, bpr_row, manual_row, reports, sku

from prodseq.operators import override as ov
from prodseq.plans.params import Params
from prodseq.plans.pipeline import stage1, stage2, stage3
from prodseq.sources.left_out import LeftOut
from prodseq.sources.sinks import order_faults, read_report

NEXT = date(2026, 1, 3)


def test_left_out_rows_are_counted_by_the_run_itself(spark, ws):
    r = reports(
        spark,
        bor=[bor_row(sku(1)), bor_row(None), bor_row(sku(2), loc=None), bor_row(None, loc="1400_FG10")],
        bmr=[(DAY, "1300", None, 1.0, 1.0), (DAY, "1400", None, 1.0, 1.0), (DAY, "1300", sku(5), 1.0, 1.0)],
        bpr=[bpr_row(sku(1)), bpr_row(None)],
        dispatch=[(1300, None, "1", "1"), (1300, sku(1), "1,0", "1")],
        curing=[(None, 3.0), (sku(1), 3.0), (None, 4.0)],
        mould=[(DAY, None, "WC1", 1.0, 2.0), (DAY, sku(1), "WC1", 1.0, 2.0)],
        manual=[manual_row(" "), manual_row(None), manual_row(sku(7)), manual_row("\t")],
    )
    left_out = LeftOut()
    watched = replace(left_out.watch(r), manual=left_out.watch_manual(r.manual))
    assert stage3(ws, stage2(ws, stage1(ws, watched, Params()), Params()), watched.manual, Params()).count() == 3
    counts = {x["report"]: x["rows"] for x in left_out.counts(spark).collect()}
    assert counts == {"BOR": 3, "BMR": 1, "BPR": 1, "DISPATCH": 1, "CURING": 2, "MOULD": 1, "MANUAL": 3}


def test_reports_that_the_plan_drops_are_still_counted(spark, ws):
    r = reports(spark, bor=[bor_row(None)], dispatch=[(1300, None, "1", "1")], bpr=[bpr_row(None)] * 2)
    left_out = LeftOut()
    assert stage1(ws, left_out.watch(r), Params()).df.count() == 0
    counts = {x["report"]: x["rows"] for x in left_out.counts(spark).collect()}
    assert counts == {"BOR": 1, "BMR": 0, "BPR": 2, "DISPATCH": 1, "CURING": 0}


def test_faults_in_the_order_of_a_report_are_seen(spark, tmp_path):
    def put(day, ranks):
        frame = spark.createDataFrame([(day, n) for n in ranks], "report_date date, r long").coalesce(1)
        frame.write.mode("append").partitionBy("report_date").parquet(str(tmp_path / "out"))

    put(DAY, [1, 2, 2, None])
    put(NEXT, [3, 1, 2])
    faults = {x["report_date"]: tuple(x)[1:] for x in order_faults(spark, str(tmp_path / "out"), "r").collect()}
    assert faults == {DAY: (4, 0, 0), NEXT: (3, 0, 1)}
    put(DAY, [7])  # stands before or after the file that ends with a missing rank: either way below it
    put(DAY, [8, 9])
    faults = {x["report_date"]: tuple(x)[1:] for x in order_faults(spark, str(tmp_path / "out"), "r").collect()}
    assert faults[DAY][0] == 7 and faults[DAY][1] >= 1 and faults[NEXT] == (3, 0, 1)
    places = [(x["report_date"], x["place"]) for x in read_report(spark, str(tmp_path / "out")).collect()]
    assert sorted(places) == [(DAY, n) for n in range(1, 8)] + [(NEXT, n) for n in range(1, 4)]


def test_mark_keeps_every_row_once(spark):
    rows = [(DAY, f" {sku(1)}", 1), (DAY, sku(1), 2), (DAY, sku(2), 3), (NEXT, sku(1), 4), (DAY, None, 5)]
    frame = spark.createDataFrame(rows, "report_date date, sku string, n int")
    manual = spark.createDataFrame([(DAY, sku(1)), (DAY, sku(1)), (NEXT, sku(9))], "report_date date, sku string")
    marked = ov.with_manual_mark(frame, manual)
    assert {r["n"]: r["superseded"] for r in marked.collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert marked.count() == 5
    assert {tuple(r) for r in ov.as_stored(marked).select(*frame.columns).collect()} == set(rows)
    assert "raw_sku" not in ov.remaining_rows(marked).columns
