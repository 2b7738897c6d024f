from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from prodseq.__main__ import main
from prodseq.plans import params as pm
from prodseq.plans.runner import Job, run_stage1, run_stage3
from prodseq.sources import calendar as cal
from prodseq.sources import heads, places
from prodseq.sources import reports as rp

FIRST, SECOND, THIRD = date(2026, 1, 2), date(2026, 1, 3), date(2026, 1, 4)
A, B, C, G = "P000000115XX", "P000000216XX", "0000000317XX", "P000000918XX"


def put(root: Path, name: str, text: str, encoding: str = "utf-8") -> None:
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)


def land(root: Path) -> None:
    for day, spelled in [("02", "02-01-2026"), ("03", "03-01-2026"), ("04", "04-01-2026")]:
        v = "Vectordata"
        put(
            root, f"{v}/BOR/BORColorBandwiseReport__{spelled}.csv",
            "Zone,SKUCode,SKU Description,Location Code,Norm ,Virtual Norm,Stock\n"
            f"N,{A},Tyre A,1300_OE10,50,100,{day}\nN,{B},\"Tyre, B\",1300_FG10,50,80,10\n"
            "N,,none,1300_OE10,1,1,0\nN,X,none,,1,1,0\n",
        )
        put(
            root, f"{v}/BMR/Prod_OverAll_BMReport__{spelled.replace('-', '_')}.csv",
            "Export report\nSr,Plant Code,BPP,Item Code,Pending CCR Qty\n"
            f"1,1300,150,{C},40\n2,1400,10,{A},9\n3,1300,n/a,{B},n/a\n",
        )
        put(
            root, f"{v}/BPR/BufferPenetrationReport__{spelled}.csv",
            "SKUCode,Location Code,Location Type,On hand Inv. Color,Top SKU\n"
            f"{A},1300_OE10,JIT,Black,T\n{B},1300_FG10,depot,Red,F\n",
        )
        if day != "04":
            put(root, f"{v}/SPOR/Single_Production_Order_Report_{day}012026.csv", "any\n")
    put(
        root, "Vectordata/Daily Mould Report/02012026 MouldDetails.csv",
        f"Sapcode,WCNAME,Mould life,Target life\n{A},WC1,45,50\n{A},WC2,50,50\n{G},WC3,5,50\n",
    )
    put(
        root, "DISPATCH1.csv",
        f'Plant,Material,Amt.in loc.cur.,Quantity,Name\n1300,{A},"1,500.00",3,Müller\n',
        "iso-8859-1",
    )
    put(root, "curing_cycletime.csv", f"SKUCode,Cure Time\n{A},12\n{A},15\n")
    put(
        root, "manual_frontend_demand.csv",
        f" SKU Code,SKU Description,Market,Quantity,Highest Priority\n {B} ,By hand,RE,25,1\n",
    )


@pytest.fixture(scope="module")
def data(tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    land(root)
    return root


def test_gate_and_calendar(spark, data):
    files = cal.report_files(spark, str(data))
    assert files.count() == 11
    complete = {r[0] for r in cal.complete_dates(files).collect()}
    assert complete == {FIRST, SECOND}
    assert cal.runnable_dates(spark, str(data), date(2025, 12, 30), THIRD) == [FIRST, SECOND]
    assert cal.runnable_dates(spark, str(data), THIRD, THIRD) == []


def test_gate_without_any_file(spark, tmp_path):
    assert cal.complete_dates(cal.report_files(spark, str(tmp_path))).count() == 0


def test_date_range_is_inclusive(spark):
    days = [r[0] for r in cal.date_range(spark, FIRST, THIRD).orderBy("report_date").collect()]
    assert days == [FIRST, SECOND, THIRD]


def test_only_asked_dates_are_opened(spark, data):
    scan = rp.read_csv(spark, str(data), rp.BOR, [SECOND])
    assert len(scan.inputFiles()) == 1
    assert {r[0] for r in scan.select("report_date").collect()} == {SECOND}


def test_scan_reads_used_columns_only(spark, data):
    plan = rp.read_csv(spark, str(data), rp.BOR, [SECOND]).select("sku")._jdf.queryExecution()
    assert "ReadSchema: struct<SKUCode:string>" in plan.executedPlan().toString()


def test_codes_keep_leading_zeros_and_header_below_banner(spark, data):
    rows = {r["sku"]: r for r in rp.read_promoted(spark, str(data), rp.BMR, [FIRST]).collect()}
    assert rows[C]["plant"] == "1300" and rows[C]["requirement"] == 40
    assert rows[B]["requirement"] is None and rows[B]["penetration"] is None
    assert "Item Code" not in rows


def test_sheet_without_header_stops_the_job(spark, tmp_path):
    put(tmp_path, "Vectordata/BMR/Prod_OverAll_BMReport__02_01_2026.csv", "a,b\n1300,X\n")
    with pytest.raises(ValueError, match="no header row in report BMR of 2026-01-02"):
        rp.read_promoted(spark, str(tmp_path), rp.BMR)


def test_sheets_with_different_headers(spark, tmp_path):
    for day, text in [
        ("02", f"banner\nItem Code,BPP,Plant Code,Pending CCR Qty\n{A},1,1300,2\n"),
        ("03", f"banner,,\nx,Plant Code,\"Item Code\",Pending CCR Qty,y,BPP\n0,1300,{B},3,0,4\n"),
    ]:
        put(tmp_path, f"Vectordata/BMR/Prod_OverAll_BMReport__{day}_01_2026.csv", text)
    rows = rp.read_promoted(spark, str(tmp_path), rp.BMR).filter("plant = '1300'").collect()
    found = {r["report_date"]: (r["sku"], r["requirement"], r["penetration"]) for r in rows}
    assert found == {FIRST: (A, 2.0, 1.0), SECOND: (B, 3.0, 4.0)}


def test_part_files_in_other_column_orders(spark, tmp_path):
    put(tmp_path, "curing_cycletime.csv/a.csv", "SKUCode,Cure Time\nX,1\n")
    put(tmp_path, "curing_cycletime.csv/b.csv", "Cure Time,note,SKUCode\n2,n,Y\n")
    put(tmp_path, "curing_cycletime.csv/c.csv", "")
    rows = {tuple(r) for r in rp.read_csv(spark, str(tmp_path), rp.CURING).collect()}
    assert rows == {("X", 1.0), ("Y", 2.0)}
    put(tmp_path, "curing_cycletime.csv/d.csv", "Cure Time\n2\n")
    with pytest.raises(ValueError, match=r"CURING lacks columns \['SKUCode'\].*d.csv"):
        rp.read_csv(spark, str(tmp_path), rp.CURING)


def test_no_file_is_opened_on_the_driver_alone(spark, tmp_path):
    # 60 dates in two column orders make two scans
    for k in range(60):
        day = FIRST + timedelta(k)
        head, row = ("SKUCode,Cure Time", f"{A},{k}") if k % 2 else ("Cure Time,SKUCode", f"{k},{A}")
        put(tmp_path, f"R/rep_{day:%d-%m-%Y}.csv", f"{head}\n{row}\n")
    report = rp.Report("R", "R/rep_{date}.csv", rp.CURING.columns, "dd-MM-yyyy")
    found = heads.shapes(heads.file_heads(spark, f"{tmp_path}/R/*.csv"), heads.first_record(), heads.first_cells, report.name())
    assert sorted(len(s.paths) for s in found) == [30, 30]
    rows = {r["report_date"]: r["cure_time"] for r in rp.read_csv(spark, str(tmp_path), report).collect()}
    assert rows == {FIRST + timedelta(k): float(k) for k in range(60)}


@pytest.mark.parametrize("small", [1 << 26, 1 << 20])
def test_heads_of_small_and_large_files(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(heads, "SMALL_FILE", small)
    put(tmp_path, "big.csv", '\ufeffa,"b ""x""\nc"\n\n' + "x,y\n" * 400_000)
    put(tmp_path, "little.csv", 'a,b\n"open')
    rows = {r["file"].rsplit("/", 1)[1]: r["records"] for r in heads.file_heads(spark, f"{tmp_path}/*.csv", lines=4).collect()}
    assert rows == {"big.csv": ['a,"b ""x""\nc"', "x,y", "x,y"], "little.csv": ["a,b"]}


def test_quoted_line_breaks_in_headers(spark, tmp_path):
    put(
        tmp_path, "Vectordata/BMR/Prod_OverAll_BMReport__02_01_2026.csv",
        f'"Banner, with\nline break",,\n"Open\r\n(pieces)",Plant Code,"Remark ""x""\nnext",BPP,Item Code,Pending CCR Qty\n7,1300,"two\nlines",5,{A},40\n',
    )
    put(tmp_path, "Vectordata/BMR/Prod_OverAll_BMReport__03_01_2026.csv", f"b\nPlant Code,BPP,Item Code,Pending CCR Qty\n1300,6,{B},41\n")
    rows = rp.read_promoted(spark, str(tmp_path), rp.BMR).filter("plant = '1300'").collect()
    assert {tuple(r) for r in rows} == {(FIRST, "1300", A, 40.0, 5.0), (SECOND, "1300", B, 41.0, 6.0)}
    put(tmp_path, "curing_cycletime.csv", 'SKUCode,"Cure\nremark",Cure Time\nX,"a\nb",3\nY,c,4\n')
    assert {tuple(r) for r in rp.read_csv(spark, str(tmp_path), rp.CURING).collect()} == {("X", 3.0), ("Y", 4.0)}


def test_report_whose_files_are_all_empty(spark, tmp_path):
    put(tmp_path, "curing_cycletime.csv", "")
    frame = rp.read_csv(spark, str(tmp_path), rp.CURING)
    assert frame.columns == ["sku", "cure_time"] and frame.count() == 0


def test_manual_files_in_other_column_orders(spark, tmp_path):
    put(tmp_path, "m/a.csv", " SKU Code,SKU Description,Market,Quantity,Highest Priority\nP1,one,RE,25,1\nP2,two,OE,5,0\n")
    put(tmp_path, "m/b.csv", 'Market,"Highest Priority ",remark,SKU Code,Quantity\nST,0,"x, y",P3,7\n')
    put(tmp_path, "m/deep/c.csv", "SKU Code,Market,Quantity,Highest Priority\nP4,EXP,1,0\n")
    put(tmp_path, "m/none.csv", "")
    rows = {r["entry_no"]: (r["SKU Code"], r["SKU Description"], r["Market"], r["Quantity"], r["Highest Priority"]) for r in rp.read_manual(spark, f"{tmp_path}/m", [FIRST]).collect()}
    assert rows == {1: ("P1", "one", "RE", "25", "1"), 2: ("P2", "two", "OE", "5", "0"), 3: ("P3", None, "ST", "7", "0"), 4: ("P4", None, "EXP", "1", "0")}
    seen = {(r["file"].rsplit("/", 1)[1], r["column_name"]): (r["is_required"], r["position"]) for r in rp.manual_columns(spark, f"{tmp_path}/m").collect()}
    assert len(seen) == 15 and seen["a.csv", "Quantity"] == (True, 4) and seen["b.csv", "SKU Code"] == (True, 4)
    assert seen["b.csv", "SKU Description"] == (False, None)
    put(tmp_path, "m/bad.csv", "SKU Code,Market\nP5,RE\n")
    with pytest.raises(ValueError, match=r"bad.csv \['Quantity', 'Highest Priority'\]"):
        rp.read_manual(spark, f"{tmp_path}/m", [FIRST])


def test_numbers_by_file_and_place(spark, tmp_path):
    spark.range(5000).repartitionByRange(7, "id").sortWithinPartitions("id").write.partitionBy().csv(f"{tmp_path}/n")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # several splits of a file, several files in a task
    try:
        rows = places.numbered(places.with_position(spark.read.schema("id long").csv(f"{tmp_path}/n")), "n")
        assert rows.filter("n <> id + 1").isEmpty() and rows.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_full_run_writes_reports(spark, data, tmp_path):
    job = Job(str(data), str(tmp_path), FIRST, THIRD, count_unusable=True)
    summary = {r["report_date"]: r for r in run_stage3(spark, job).collect()}
    assert set(summary) == {FIRST, SECOND}
    assert summary[FIRST]["manual_entries"] == 1 and summary[FIRST]["overstock"] == 1
    assert summary[FIRST]["mould_alerts"] == 1
    left_out = {r["report"]: r["rows"] for r in spark.read.parquet(f"{tmp_path}/unusable_rows").collect()}
    assert left_out == {"BOR": 4, "BMR": 0, "BPR": 0, "DISPATCH": 0, "CURING": 0, "MOULD": 0, "MANUAL": 0}
    report = spark.read.parquet(f"{tmp_path}/final_hybrid_deployment_report")
    first = report.filter(F.col("report_date") == FIRST).orderBy("Final Rank").collect()
    assert [r["SKUCode"] for r in first] == [B, A, G, C]
    a = first[1]
    assert (a["ASP"], a["Cure Time"], a["MachineCount"], a["Top SKU"]) == (500.0, 17.5, 2, "T")
    assert first[0]["Vector_Requirement"] == 30 and first[0]["SKU Description"] == "By hand"


def test_rewriting_a_date_keeps_the_others(spark, data, tmp_path):
    run_stage1(spark, Job(str(data), str(tmp_path), FIRST, SECOND))
    run_stage1(spark, Job(str(data), str(tmp_path), SECOND, SECOND))
    report = spark.read.parquet(f"{tmp_path}/combined_data_output")
    assert {r[0] for r in report.select("report_date").distinct().collect()} == {FIRST, SECOND}
    assert report.columns[-2] == "Rank_ConsolidatedPriorityScore" and len(report.columns) == 27


def test_command_line_writes_csv(spark, data, tmp_path, capsys):
    main(["stage2", "--data", str(data), "--out", str(tmp_path), "--start", "02.01.2026", "--format", "csv"])
    assert "critical_gaps" in capsys.readouterr().out
    report = spark.read.option("header", True).csv(f"{tmp_path}/deployment_analysis_report")
    assert report.count() == 5 and "Norm " in report.columns


def test_missing_manual_list_and_dates_are_errors(spark, data, tmp_path):
    with pytest.raises(FileNotFoundError):
        run_stage3(spark, Job(str(data), str(tmp_path), FIRST, FIRST, manual=f"{data}/none.csv"))
    with pytest.raises(ValueError, match="all daily reports"):
        run_stage1(spark, Job(str(data), str(tmp_path), THIRD, THIRD))


def test_parameter_resolution(spark):
    rows = [
        ("s", "EFFICIENCY_FACTOR", 0.9, None), ("s", "MOULD_LIFE_THRESHOLD", 0.9, " "),
        ("s", "MARKET_WEIGHTS_OE", 4.0, "7"), ("s", "MARKET_WEIGHTS_ST", 3.0, " 2.5 "),
        ("s", "DEFAULT_ASP", 3000.0, "-2.5"), ("s", "DEFAULT_CURE_TIME", 15.0, "abc"),
    ]
    table = pm.resolve_parameters(spark.createDataFrame(rows, pm.PARAMETER_SCHEMA))
    found = {r["Parameter"]: (r["value"], r["is_valid"]) for r in table.collect()}
    assert found == {
        "EFFICIENCY_FACTOR": (0.9, True), "MOULD_LIFE_THRESHOLD": (0.9, True),
        "MARKET_WEIGHTS_OE": (7.0, True), "MARKET_WEIGHTS_ST": (2.0, True),
        "DEFAULT_ASP": (-2.0, True), "DEFAULT_CURE_TIME": (None, False),
    }


def test_loading_parameters(spark):
    defaults = pm.default_parameters(spark)
    assert pm.load_params(defaults) == pm.Params()
    assert defaults.count() == 30

    def answer(name, text):
        return defaults.withColumn(
            "User_Input", F.when(F.col("Parameter") == name, text).otherwise(F.col("User_Input"))
        )

    assert pm.load_params(answer("CRITICAL_GAP_RANK", "10")).critical_gap_rank == 10
    with pytest.raises(ValueError, match="CRITICAL_GAP_RANK"):
        pm.load_params(answer("CRITICAL_GAP_RANK", "ten"))
    with pytest.raises(KeyError, match="EFFICIENCY_FACTOR"):
        pm.load_params(defaults.filter("Parameter <> 'EFFICIENCY_FACTOR'"))
    with pytest.raises(ValueError, match="more than once"):
        pm.load_params(defaults.unionByName(defaults.limit(1)))
