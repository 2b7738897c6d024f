"""Plant reports derived from the star-schema test tables.

Each report is a rule over lineitem, orders, customer and part (FIXTURES.md,
section B). ``oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prodseq.plans.workspace import Workspace
from prodseq.sources import reports as rp

SINGLE_DATE = "2026-01-02"
MANUAL_LIST = "manual_frontend_demand.csv"
REMARKS = "Remarks\nof the plant"
LOCATION_OF_SEGMENT = {
    "AUTOMOBILE": "1300_OE10",
    "MACHINERY": "1300_ST10",
    "HOUSEHOLD": "1300_FG10",
    "BUILDING": "1400_FG10",
}
LOCATION_TYPE_LIST = ["JIT", "Depot", "depot", "Depot Mobility", "Feeder", "PWH", "Other"]
#: Bytes a task below which a table's own splits are too few for the tasks there are.
SMALL_SPLIT = 4 << 20
COLOUR_LIST = ["Black", "Red", "Yellow", "Green"]


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sku_code() -> Column:
    return F.concat(
        F.lit("P"),
        F.lpad(F.col("p_partkey").cast("string"), 7, "0"),
        F.lpad(F.col("p_size").cast("string"), 2, "0"),
        F.lit("XX"),
    )


def _bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file or folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def base_rows(spark: SparkSession, sf_dir: str, yearly: bool) -> DataFrame:
    """Lines with product, segment and report date.

    Orders get their segment first, so that lines, by far the most rows, are shuffled for
    one join less.
    """
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    day = (
        F.make_date(F.year("l_shipdate"), F.lit(1), F.lit(1))
        if yearly
        else F.lit(SINGLE_DATE).cast("date")
    )
    line = line.select(
        day.alias("report_date"), "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_linestatus",
    )  # the date alone goes through the joins, not the time
    tasks = spark.sparkContext.defaultParallelism
    if len(line.inputFiles()) < tasks and _bytes(spark, f"{sf_dir}/lineitem.parquet") < tasks * SMALL_SPLIT:
        line = line.repartition(tasks)  # one small file would keep every later step in one task
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_mktsegment")
    segments = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", "p_brand")
    location = F.col("c_mktsegment")
    cases = F.when(F.lit(False), "")
    for segment, loc in LOCATION_OF_SEGMENT.items():
        cases = cases.when(location == segment, loc)
    return (
        line.join(segments, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "report_date",
            sku_code().alias("sku"),
            # every fifth product is stocked by another plant only
            F.when(F.col("p_partkey") % 5 != 4, cases).when(cases.isNotNull(), "1400_FG10").alias("loc"),
            "p_partkey", "p_brand", "c_mktsegment", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_returnflag", "l_linestatus",
        )
    )


def _sum_when(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("l_quantity")).otherwise(0.0))


def bor(base: DataFrame) -> DataFrame:
    shipped = _sum_when(F.col("l_linestatus") == "F")
    returned = _sum_when(F.col("l_returnflag") == "R")
    return (
        base.filter("c_mktsegment <> 'FURNITURE'")
        .groupBy("report_date", "sku", "loc")
        .agg(
            (F.count("*") * 25.0).alias("Norm "),
            F.sum("l_quantity").alias("Virtual Norm"),
            (shipped * 2 - returned).alias("Stock"),
        )
        .select(
            "report_date",
            F.col("sku").alias("SKUCode"),
            F.concat(F.lit('Tyre 15" wide, '), "sku").alias("SKU Description"),
            F.col("loc").alias("Location Code"),
            "Norm ", "Virtual Norm", "Stock",
        )
    )


def bmr(base: DataFrame) -> DataFrame:
    elsewhere = (F.col("p_partkey") % 11 == 0) | (F.col("p_partkey") % 5 == 4)
    plant = F.when(elsewhere, "1400").otherwise("1300")
    shipped = _sum_when(F.col("l_linestatus") == "F")
    returned = _sum_when(F.col("l_returnflag") == "R")
    return (
        base.filter("c_mktsegment = 'FURNITURE'")
        .groupBy("report_date", "sku", plant.alias("Plant Code"))
        .agg(
            _sum_when(F.col("l_linestatus") == "O").alias("Pending CCR Qty"),
            F.try_divide(returned * 100, shipped).alias("BPP"),
        )
        .select("report_date", "Plant Code", F.col("sku").alias("Item Code"), "Pending CCR Qty", "BPP")
    )


def bpr(base: DataFrame) -> DataFrame:
    def rows(df: DataFrame, loc: Column, place: Column, colour: Column, top: Column) -> DataFrame:
        return df.select(
            "report_date",
            F.col("sku").alias("SKUCode"),
            loc.alias("Location Code"),
            place.alias("Location Type"),
            colour.alias("On hand Inv. Color"),
            top.alias("Top SKU"),
        )

    # 84 is 12 * 7, so these two numbers stand for the three texts, and equal rows are found by numbers
    marks = base.select("report_date", "sku", (F.col("l_suppkey") % 84).alias("place"), (F.col("l_linenumber") % 4).alias("colour"))
    spread = rows(
        marks.distinct(),
        F.concat(F.lit("L"), (F.col("place") % 12).cast("string")),
        _pick(LOCATION_TYPE_LIST, F.col("place") % 7),
        _pick(COLOUR_LIST, F.col("colour")),
        F.lit("F"),
    )
    places = base.filter("loc IS NOT NULL").select(
        "report_date", "sku", "loc", "p_partkey", "p_brand"
    ).distinct()
    top = F.when(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"), "T").otherwise("F")
    stocked = rows(
        places.filter("p_partkey % 7 <> 0"),
        F.col("loc"), F.lit("PWH"), _pick(COLOUR_LIST, F.col("p_partkey") % 4), top,
    )
    doubled = rows(
        places.filter("p_partkey % 50 = 1"),
        F.col("loc"), F.lit("PWH"), F.lit("Black"), F.lit("T"),
    )
    return spread.unionAll(stocked).unionAll(doubled)


def dispatch(base: DataFrame) -> DataFrame:
    whole = F.col("l_quantity").cast("long").cast("string")
    quantity = (
        F.when(F.col("l_linenumber") == 7, "0")
        .when(F.col("l_linenumber") == 6, F.concat(F.lit("1,"), F.lpad(whole, 3, "0")))
        .otherwise(whole)
    )
    # a product in thirteen is sold by no plant of this number: a fraction, or a huge one
    odd = F.when(F.col("l_suppkey") % 2 == 0, 1300.7).otherwise(99999999999.0)
    return base.select(
        F.when(F.col("p_partkey") % 13 == 0, odd).otherwise(F.lit(1300.0) + F.col("l_suppkey") % 2).alias("Plant"),
        F.col("sku").alias("Material"),
        F.format_number("l_extendedprice", 2).alias("Amt.in loc.cur."),
        quantity.alias("Quantity"),
    )


def curing(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    usual = part.select(
        sku_code().alias("SKUCode"),
        F.when(F.col("p_partkey") % 10 != 0, F.lit(10.0) + F.col("p_partkey") % 20).alias("Cure Time"),
        "p_partkey",
    )
    slower = usual.filter("p_partkey % 4 = 0").withColumn("Cure Time", F.col("Cure Time") + 3)
    return usual.unionAll(slower).drop("p_partkey")


def mould(base: DataFrame) -> DataFrame:
    target = F.when(F.col("p_partkey") % 101 == 0, 0.0).otherwise(50.0)
    # a product in three has no code here, so nothing runs it
    return base.select(
        "report_date",
        F.when(F.col("p_partkey") % 3 != 0, F.col("sku")).alias("Sapcode"),
        F.concat(F.lit("WC"), F.col("l_suppkey").cast("string")).alias("WCNAME"),
        F.col("l_quantity").alias("Mould life"),
        target.alias("Target life"),
    )


def manual(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    # most lines of the list are left blank by the planner
    return part.select(
        F.lit(SINGLE_DATE).cast("date").alias("report_date"),
        F.when(F.col("p_partkey") % 37 == 3, sku_code()).otherwise(" ").alias("SKU Code"),
        F.concat(F.lit("Manual "), F.col("p_name")).alias("SKU Description"),
        _pick(["OE", "ST", "EXP", "RE"], F.col("p_partkey") % 4).alias("Market"),
        (F.col("p_size") * 10.0).alias("Quantity"),
        F.when(F.col("p_partkey") % 111 == 3, "9999999999").when(F.col("p_partkey") % 2 == 0, "1").otherwise("0").alias("Highest Priority"),
        F.col("p_partkey").alias("entry_no"),
    )


@dataclass(frozen=True)
class Landed:
    """Raw report tables as they land: reported column names, Parquet."""

    tables: dict[str, DataFrame]
    workspace: Workspace

    def reports(self) -> rp.Reports:
        t = self.tables
        return rp.Reports(
            bor=rp.typed(t["bor"], rp.BOR),
            bmr=rp.typed(t["bmr"], rp.BMR),
            bpr=rp.typed(t["bpr"], rp.BPR),
            dispatch=rp.typed(t["dispatch"], rp.DISPATCH),
            curing=rp.typed(t["curing"], rp.CURING),
            mould=rp.typed(t["mould"], rp.MOULD),
            manual=t["manual"],
        )


#: The tables that are a rule over the base rows, and those over products alone.
_FROM_BASE = {"bor": bor, "bmr": bmr, "bpr": bpr, "dispatch": dispatch, "mould": mould}
_FROM_PARTS = {"curing": curing, "manual": manual}
#: Tables that have a row for each base row; beside written base rows they are not written once more.
_ROW_BY_ROW = ("dispatch", "mould")
TABLES = (*_FROM_BASE, *_FROM_PARTS)
#: Sheets of the data folder: the tables, and the order report.
SHEETS = (*TABLES, "spor")
DAILY_SHEETS = ("spor", "bor", "bmr", "bpr")

_LANDED: dict[tuple[str, str, bool], Landed] = {}
_LANDED_CSV: dict[tuple[str, str], tuple[str, set[str]]] = {}


def landed(spark: SparkSession, sf_dir: str, yearly: bool = False, names: Iterable[str] = TABLES) -> Landed:
    """Land the named tables of one scale once per application and return all that have landed.

    The base rows are written if more than one table is made from them. A table with a row for
    each of them is then read from them.
    """
    key = (spark.sparkContext.applicationId, sf_dir, yearly)
    if key not in _LANDED:
        _LANDED[key] = Landed({}, Workspace(spark))
    found = _LANDED[key]
    ws, missing = found.workspace, [n for n in names if n not in found.tables]
    ruled = [n for n in missing if n in _FROM_BASE]
    if ruled:
        base = base_rows(spark, sf_dir, yearly)
        shared = len(ruled) > 1
        if shared:
            base = ws.write(base, "base")

        def land(name: str) -> DataFrame:
            table = _FROM_BASE[name](base)
            return table if shared and name in _ROW_BY_ROW else ws.write(table, name)

        # the tables do not wait for each other
        with ThreadPoolExecutor(len(ruled)) as pool:
            found.tables.update(zip(ruled, pool.map(land, ruled), strict=True))
    for name in set(missing) & _FROM_PARTS.keys():
        found.tables[name] = ws.write(_FROM_PARTS[name](spark, sf_dir), name)
    return found


def landed_csv(spark: SparkSession, sf_dir: str, names: Iterable[str] = SHEETS) -> str:
    """Land the named yearly sheets as CSV, daily ones in dated folders; return the data folder.

    Each sheet is written once per application. The order report (presence only) is missing
    for every third year, so those dates are incomplete.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    needed = ["bor" if n == "spor" else n for n in names]
    source = landed(spark, sf_dir, yearly=True, names=dict.fromkeys(needed))
    root, written = _LANDED_CSV.setdefault(key, (source.workspace.path("csv"), set()))
    for name in names:
        if name not in written:
            try:
                _write_sheet(name, source.tables, root)
            except BaseException:
                _LANDED_CSV.pop(key)  # a sheet written in part is not added to
                raise
            written.add(name)
    return root


def _write_sheet(name: str, t: dict[str, DataFrame], root: str) -> None:
    even = F.year("report_date") % 2 == 0
    if name == "manual":
        _write_manual(t["manual"], root)
    elif name == "spor":
        orders = t["bor"].filter(F.year("report_date") % 3 != 0).select("report_date", "SKUCode")
        _write_dated(orders, root, rp.SPOR, header=True)
    elif name == "bor":
        # every second year has its columns in another order
        _write_dated(t["bor"].filter(even), root, rp.BOR, header=True)
        turned = ["report_date", *reversed(t["bor"].columns[1:])]
        _write_dated(t["bor"].filter(~even).select(*turned), root, rp.BOR, header=True)
    elif name == "bmr":
        _write_dated(_with_banner(t["bmr"].filter(~even)), root, rp.BMR, header=False)
        # the sheets of the other years hold remarks, with line breaks in their header and cells
        noted = t["bmr"].filter(even).withColumn(REMARKS, F.concat(F.lit("seen\n"), "Item Code"))
        _write_dated(_with_banner(noted.select("report_date", REMARKS, *t["bmr"].columns[1:])), root, rp.BMR, header=False)
    elif name in ("dispatch", "curing"):
        report = {"dispatch": rp.DISPATCH, "curing": rp.CURING}[name]
        t[name].write.options(header="true", escape='"', encoding=report.encoding).csv(f"{root}/{report.path}")
    else:
        _write_dated(t[name], root, {"bpr": rp.BPR, "mould": rp.MOULD}[name], header=True)


def _write_manual(entries: DataFrame, root: str) -> None:
    """The manual list in two parts of several files, in order of entry and without the number of it.

    The second part has its columns in another order.
    """
    last = entries.agg(F.max("entry_no")).first()[0]
    early = F.col("entry_no") <= last // 2
    names = [c for c in entries.columns if c not in ("report_date", "entry_no")]
    for part, some, columns in [("early", entries.filter(early), names), ("late", entries.filter(~early), names[::-1])]:
        listed = some.repartitionByRange("entry_no").sortWithinPartitions("entry_no").select(*columns)
        listed.write.options(header="true", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/{MANUAL_LIST}/{part}")


def _with_banner(sheet: DataFrame) -> DataFrame:
    """A banner and a header row above the data of each date, all as text."""
    names = sheet.columns[1:]
    top = sheet.select("report_date").distinct()
    banner = top.select("report_date", *[F.lit(f"Report {i}").alias(n) for i, n in enumerate(names)])
    header = top.select("report_date", *[F.lit(n).alias(n) for n in names])
    text = sheet.select("report_date", *[F.col(n).cast("string").alias(n) for n in names])
    return banner.unionAll(header).unionAll(text)


def _write_dated(df: DataFrame, root: str, report: rp.Report, header: bool) -> None:
    folder, name = report.path.rsplit("/", 1)
    before, after = name.split("{date}")
    file = F.concat(F.lit(before), F.date_format("report_date", report.style), F.lit(after))
    (
        df.withColumn("file", file)
        .drop("report_date")
        .write.mode("append").partitionBy("file")
        .options(header=header, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(f"{root}/{folder}")
    )
