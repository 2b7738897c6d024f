"""Plant reports: where they land, which columns are used, how they are read.

A report of one date is one CSV file, or a folder of part files, whose name
carries the date. All dates of a run are read by one scan; the date comes from
the path. Tables that are already landed as Parquet need only ``typed``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from prodseq.functions import nan_to_null, number
from prodseq.sources.heads import HEAD_LINES, Cells, Shape, file_heads, first_cells, first_record, holding, records_with, shapes
from prodseq.sources.places import numbered, with_position


@dataclass(frozen=True)
class Reports:
    """Typed report tables; dispatch and curing have no date."""

    bor: DataFrame
    bmr: DataFrame
    bpr: DataFrame
    dispatch: DataFrame
    curing: DataFrame
    mould: DataFrame | None = None
    manual: DataFrame | None = None


@dataclass(frozen=True)
class Report:
    """``path`` is relative to the data folder; ``{date}`` stands for the date in ``style``."""

    kind: str
    path: str
    columns: dict[str, tuple[str, str]]  # reported name → (internal name, type)
    style: str | None = None
    encoding: str = "UTF-8"
    multi_line: bool = False  # cells may hold line breaks; such files are not split over tasks

    def options(self, shape: Shape) -> dict[str, str]:
        """CSV dialect: a quote inside a quoted cell is doubled; a header with line breaks is enough to look for more."""
        multi_line = self.multi_line or shape.multi_line
        return {"encoding": self.encoding, "quote": '"', "escape": '"', "multiLine": str(multi_line).lower()}

    def name(self) -> str:
        """Pattern of the names of its files or folders, with the date as its group if it has one."""
        digits = "".join(r"\d" if ch.isalpha() else ch for ch in self.style or "")
        name = self.path.rsplit("/", 1)[-1].replace(".", r"\.").replace(" ", "(?: |%20)")
        return name.replace("{date}", f"({digits})")

    def glob(self, dates: Iterable[date] | None = None) -> str:
        """Path pattern of the given dates, or of all dates."""
        if self.style is None:
            return self.path
        spelled = sorted({_spell(d, self.style) for d in dates}) if dates is not None else ["*"]
        choice = spelled[0] if len(spelled) == 1 else "{" + ",".join(spelled) + "}"
        folder, name = self.path.rsplit("/", 1)
        return f"{folder}/*{name.replace('{date}', choice)}"

    def day_of(self, path: str) -> date:
        """The same on the driver, for the path of a file or folder."""
        before, after = self.path.rsplit("/", 1)[1].split("{date}")
        name = path.replace("%20", " ").rsplit("/", 1)[1]
        return _unspelled(name[len(name) - len(after) - len(self.style) : len(name) - len(after)], self.style)

    def date_in(self, path: Column) -> Column:
        """Date written in a file path (blanks may be percent-encoded there)."""
        return F.try_to_timestamp(F.regexp_extract(path, self.name(), 1), F.lit(self.style)).cast("date")


def _unspelled(text: str, style: str) -> date:
    part = {k: int(text[style.index(k) : style.index(k) + len(k)]) for k in ("yyyy", "MM", "dd")}
    return date(part["yyyy"], part["MM"], part["dd"])


def _spell(d: date, style: str) -> str:
    return style.replace("yyyy", f"{d.year:04d}").replace("MM", f"{d.month:02d}").replace(
        "dd", f"{d.day:02d}"
    )


# File names, date spellings and column names of the reports.
BOR = Report(
    "BOR",
    "Vectordata/BOR/BORColorBandwiseReport__{date}.csv",
    {
        "SKUCode": ("sku", "string"),
        "SKU Description": ("description", "string"),
        "Location Code": ("loc", "string"),
        "Norm ": ("norm", "double"),
        "Virtual Norm": ("virtual_norm", "double"),
        "Stock": ("stock", "double"),
    },
    "dd-MM-yyyy",
)
BMR = Report(
    "BMR",
    "Vectordata/BMR/Prod_OverAll_BMReport__{date}.csv",
    {
        "Plant Code": ("plant", "string"),
        "Item Code": ("sku", "string"),
        "Pending CCR Qty": ("requirement", "double"),
        "BPP": ("penetration", "double"),
    },
    "dd_MM_yyyy",
)
BPR = Report(
    "BPR",
    "Vectordata/BPR/BufferPenetrationReport__{date}.csv",
    {
        "SKUCode": ("sku", "string"),
        "Location Code": ("loc", "string"),
        "Location Type": ("location_type", "string"),
        "On hand Inv. Color": ("colour", "string"),
        "Top SKU": ("top_sku", "string"),
    },
    "dd-MM-yyyy",
)
# Only the presence of this report matters; nothing reads its content.
SPOR = Report("SPOR", "Vectordata/SPOR/Single_Production_Order_Report_{date}.csv", {}, "ddMMyyyy")
MOULD = Report(
    "MOULD",
    "Vectordata/Daily Mould Report/{date} MouldDetails.csv",
    {
        "Sapcode": ("sku", "string"),
        "WCNAME": ("machine", "string"),
        "Mould life": ("mould_life", "double"),
        "Target life": ("target_life", "double"),
    },
    "ddMMyyyy",
)
DISPATCH = Report(
    "DISPATCH",
    "DISPATCH1.csv",
    {
        "Plant": ("plant", "double"),  # a number in the list; 1300.7 is not plant 1300
        "Material": ("sku", "string"),
        "Amt.in loc.cur.": ("amount", "string"),
        "Quantity": ("quantity", "string"),
    },
    encoding="ISO-8859-1",
)
CURING = Report(
    "CURING",
    "curing_cycletime.csv",
    {"SKUCode": ("sku", "string"), "Cure Time": ("cure_time", "double")},
)
DAILY = [SPOR, BOR, BMR, BPR]


#: Lines in which a header without a banner above it must end.
HEADER_LINES = 10


def typed(raw: DataFrame, report: Report) -> DataFrame:
    """Internal names and types of the used columns; NaN becomes missing."""
    types = dict(raw.dtypes)

    def column(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "string":
            return c.cast("string")
        if types[name] == "string":
            return number(c).cast(kind)
        return nan_to_null(c).cast(kind) if types[name] == "double" else c.cast(kind)

    dated = ["report_date"] if "report_date" in raw.columns else []
    return raw.select(
        *dated, *[column(n, kind).alias(inner) for n, (inner, kind) in report.columns.items()]
    )


def _shapes(spark: SparkSession, base: str, report: Report, dates: Iterable[date] | None, lines: int, candidates: Column, pick: Callable[[Cells], list[str] | None], shared: bool = False) -> list[Shape]:
    pattern = f"{base}/{report.glob(dates)}"
    if not matching_paths(spark, pattern):
        raise FileNotFoundError(f"no file of report {report.kind}: {pattern}")
    return shapes(file_heads(spark, pattern, report.encoding, lines), candidates, pick, report.name(), shared)


def read_csv(
    spark: SparkSession, base: str, report: Report, dates: Iterable[date] | None = None
) -> DataFrame:
    """All dates of a report, columns matched by the header of each file.

    Files with equal headers are read by one scan; another column order, or more
    columns, only makes one more scan. A header cell may hold line breaks in quotes.
    """
    found = _shapes(spark, base, report, dates, HEADER_LINES, first_record(), first_cells)

    def scan(shape: Shape) -> DataFrame:
        absent = [n for n in report.columns if n not in shape.header]
        if absent:
            raise ValueError(f"report {report.kind} lacks columns {absent}: {shape.paths[0]}")
        cells = StructType([StructField(n, StringType()) for n in shape.header])
        read = spark.read.schema(cells).options(**report.options(shape), header="true", enforceSchema="false").csv(list(shape.paths))
        dated = [] if report.style is None else [report.date_in(F.col("_metadata.file_path")).alias("report_date")]
        return read.select(*dated, *[F.col(f"`{n}`") for n in report.columns])

    if not found:
        return _empty(spark, report)
    return typed(reduce(DataFrame.unionByName, map(scan, found)), report)


def read_promoted(
    spark: SparkSession, base: str, report: Report, dates: Iterable[date] | None = None
) -> DataFrame:
    """Read a sheet whose header stands below a banner row.

    The header is the first record that names the report's columns; it may hold line breaks
    in quotes. It is looked up in the first lines of each date's files, so that the scan
    itself reads only the used cells. Dates whose headers differ are read apart. A date
    without a header is an error.
    """
    names = list(report.columns)
    found = _shapes(spark, base, report, dates, HEAD_LINES, records_with(names), holding(names), shared=True)
    for shape in found:
        if shape.header is None:
            raise ValueError(f"no header row in report {report.kind} of {report.day_of(shape.paths[0])}")

    def scan(shape: Shape) -> DataFrame:
        places = [shape.header.index(n) for n in names]
        width = ", ".join(f"_c{i} string" for i in range(max(places) + 1))
        cells = spark.read.schema(width).options(**report.options(shape), header="false").csv(list(shape.paths))
        named = cells.select(
            report.date_in(F.col("_metadata.file_path")).alias("report_date"),
            *[F.col(f"_c{at}").alias(n) for n, at in zip(names, places)],
        )
        is_header = reduce(Column.__and__, [F.col(n).eqNullSafe(F.lit(n)) for n in names])
        return named.filter(~is_header)

    if not found:
        return _empty(spark, report)
    return typed(reduce(DataFrame.unionByName, map(scan, found)), report)


def _empty(spark: SparkSession, report: Report) -> DataFrame:
    """The report without rows, where all its files are empty."""
    dated = "report_date date, " if report.style else ""
    return typed(spark.createDataFrame([], dated + ", ".join(f"`{n}` string" for n in report.columns)), report)


def read_reports(spark: SparkSession, base: str, dates: list[date]) -> Reports:
    """All reports of the given dates; a date without a mould report has no mould rows.

    The looks at the files' heads are small jobs of their own, so they run side by side.
    """
    reads = {
        "bor": lambda: read_csv(spark, base, BOR, dates),
        "bmr": lambda: read_promoted(spark, base, BMR, dates),
        "bpr": lambda: read_csv(spark, base, BPR, dates),
        "dispatch": lambda: read_csv(spark, base, DISPATCH),
        "curing": lambda: read_csv(spark, base, CURING),
    }
    if matching_paths(spark, f"{base}/{MOULD.glob(dates)}"):
        reads["mould"] = lambda: read_csv(spark, base, MOULD, dates)
    with ThreadPoolExecutor(len(reads)) as pool:
        started = {name: pool.submit(read) for name, read in reads.items()}
        return Reports(**{name: read.result() for name, read in started.items()})


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files or folders that match; one per report date at most."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [str(s.getPath()) for s in fs.globStatus(path) or []]


# Columns of the manual list, and those that every file of it must have.
MANUAL_NAMES = ["SKU Code", "SKU Description", "Market", "Quantity", "Highest Priority"]
REQUIRED_MANUAL = ["SKU Code", "Quantity", "Market", "Highest Priority"]
#: Columns of ours that a list may bring along.
OWN_MANUAL = ["report_date", "entry_no"]


def _manual_shapes(spark: SparkSession, path: str) -> list[Shape]:
    """The files of a CSV list by their header names, without blanks around them."""
    heads = file_heads(spark, path, lines=HEADER_LINES, nested=True)
    return shapes(heads, first_record(), lambda found: [n.strip() for n in first_cells(found) or []])


def is_csv(spark: SparkSession, path: str) -> bool:
    """Whether a list is CSV, by the suffix of the path or of the files in it."""
    return path.rstrip("/").endswith(".csv") or bool(matching_paths(spark, f"{path}/*.csv"))


def manual_columns(spark: SparkSession, path: str) -> DataFrame:
    """(file, column_name, is_required, position) for every file of a manual list in CSV and every column.

    ``position`` counts from 1 and is missing where the file lacks the column.
    """
    rows = [
        (file, name, name in REQUIRED_MANUAL, shape.header.index(name) + 1 if name in shape.header else None)
        for shape in _manual_shapes(spark, path)
        for file in shape.paths
        for name in MANUAL_NAMES
    ]
    return spark.createDataFrame(rows, "file string, column_name string, is_required boolean, position long")


def _manual_csv(spark: SparkSession, path: str) -> DataFrame:
    """All files of the list under its column names, each read by its own header."""
    found = _manual_shapes(spark, path)
    lacking = {p: absent for s in found for p in s.paths if (absent := [n for n in REQUIRED_MANUAL if n not in s.header])}
    if lacking:
        told = "; ".join(f"{p} {absent}" for p, absent in sorted(lacking.items())[:20])
        raise ValueError(f"manual demand lacks required columns: {told}")

    def scan(shape: Shape) -> DataFrame:
        cells = StructType([StructField(f"_c{i}", StringType()) for i in range(len(shape.header))])
        read = spark.read.schema(cells).options(header="true", quote='"', escape='"', multiLine=str(shape.multi_line).lower()).csv(list(shape.paths))
        used = [n for n in [*MANUAL_NAMES, *OWN_MANUAL] if n in shape.header]
        return with_position(read).select(*[F.col(f"_c{shape.header.index(n)}").alias(n) for n in used], "_file", "_start", "_slot")

    if not found:
        return spark.createDataFrame([], ", ".join(f"`{n}` string" for n in MANUAL_NAMES) + ", _file string, _start long, _slot long")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(scan, found))


def read_manual(spark: SparkSession, path: str, dates: list[date]) -> DataFrame:
    """Manual list from CSV or Parquet, in order of entry (``entry_no``).

    Columns are matched by the header of each CSV file, so files of one list may order
    them differently; a file that lacks a required one stops the job, and
    ``manual_columns`` shows which. Without an own ``entry_no`` column entries are numbered
    by file name and place in the file. A list without its own ``report_date`` column holds
    for each of the given dates.
    """
    if is_csv(spark, path):
        raw = _manual_csv(spark, path)
    else:
        raw = with_position(spark.read.parquet(path))
    raw = raw.drop("_file", "_start", "_slot") if "entry_no" in raw.columns else numbered(raw, "entry_no")
    if "report_date" not in raw.columns:
        days = spark.createDataFrame([(d,) for d in dates], "report_date date")
        span = F.sequence(F.lit(min(dates)), F.lit(max(dates)))
        raw = raw.withColumn("report_date", F.explode(span)).join(F.broadcast(days), "report_date", "left_semi")
    return raw.withColumns(
        {"report_date": F.col("report_date").cast("date"), "entry_no": F.col("entry_no").cast("long")}
    )
