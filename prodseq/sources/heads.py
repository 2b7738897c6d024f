"""What stands at the start of files, looked up by tasks instead of the driver.

Every file gets a task of its own, and its first lines are put together to records, in
which a quoted cell may hold line breaks. A small file is read to its end by the JVM, which
takes less time than a Python process to start. A task on a large one hands its lines to
Python, which stops the task after the first of them. Only the records that a caller asks
for, and the paths that share them, come back.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines at the start of a file among which its header must be.
HEAD_LINES = 50
#: Bytes up to which a file is read whole by the JVM.
SMALL_FILE = 64 << 20

# So large that no two files share a task; a file of more gets more tasks, which end at once.
_FILE_PER_TASK = str(1 << 30)
_LINES_AT_ONCE = 64
_SLOT_MASK = (1 << 33) - 1  # low bits of monotonically_increasing_id: place in the task

Cells = list[list[str]]


def file_heads(spark: SparkSession, pattern: str, encoding: str = "UTF-8", lines: int = HEAD_LINES, nested: bool = False) -> DataFrame:
    """(file, records): the whole records in the first ``lines`` lines of every file that matches, as text.

    Empty files, hidden ones and blank lines are passed over. ``nested`` also looks into
    folders below a matching one.
    """
    session = spark.newSession()  # settings of this look-up only
    for name, value in [
        ("spark.sql.files.maxPartitionBytes", _FILE_PER_TASK),
        ("spark.sql.files.openCostInBytes", _FILE_PER_TASK),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", str(_LINES_AT_ONCE)),
        ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
    ]:
        session.conf.set(name, value)
    # one cell per line: no character separates or quotes
    read = session.read.schema("line string").options(encoding=encoding, sep="\x01", quote="", escape="", header="false")
    rows = read.option("recursiveFileLookup", str(nested).lower()).csv(pattern)
    size = F.col("_metadata.file_size")
    columns = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().bitwiseAND(F.lit(_SLOT_MASK)).alias("at"), F.coalesce("line", F.lit("")).alias("line")]
    small = rows.filter(size <= SMALL_FILE).select(*columns).filter((F.col("at") < lines) & (F.col("start") == 0))
    large = rows.filter(size > SMALL_FILE).select(*columns).mapInArrow(lambda batches: _first(batches, lines), "file string, start long, at long, line string")
    found = small.unionByName(large).groupBy("file").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines"))
    return found.select("file", _records(F.transform("lines", lambda x: x["line"])).alias("records"))


def _first(batches: Iterator[pa.RecordBatch], lines: int) -> Iterator[pa.RecordBatch]:
    """The first lines of a task's file; the task ends without reading on."""
    taken = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if batch.column("start")[0].as_py() > 0:
            return  # a later part of the file
        yield batch.slice(0, lines - taken)
        taken += batch.num_rows
        if taken >= lines:
            return


def _records(lines: Column) -> Column:
    """Lines put together wherever a quote is still open at the end of one; an unfinished record is left out."""

    def step(state: Column, line: Column) -> Column:
        text = F.when(state["open"] > 0, F.concat(state["text"], F.lit("\n"), line)).otherwise(line)
        quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
        open_ = (state["open"] + quotes) % 2
        done = F.when(open_ == 0, F.concat(state["done"], F.array(text))).otherwise(state["done"])
        return F.struct(done.alias("done"), text.alias("text"), open_.alias("open"))

    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("text"), F.lit(0).alias("open"))
    plain = F.transform(lines, lambda x: F.regexp_replace(x, "^﻿", ""))
    return F.reduce(plain, start, step, lambda state: state["done"])


def first_record() -> Column:
    """Candidates: the first record alone."""
    return F.slice("records", 1, 1)


def records_with(names: list[str]) -> Column:
    """Candidates: all records in which every name stands somewhere."""
    return F.filter("records", lambda r: F.forall(F.array(*[F.lit(n) for n in names]), lambda n: F.contains(r, n)))


def holding(names: list[str]) -> Callable[[Cells], list[str] | None]:
    """Picks the first candidate that has all the names as cells."""
    return lambda candidates: next((cells for cells in candidates if set(names) <= set(cells)), None)


def first_cells(candidates: Cells) -> list[str] | None:
    return candidates[0] if candidates else None


@dataclass(frozen=True)
class Shape:
    """Files that share a header; ``header`` is missing where none was found."""

    header: tuple[str, ...] | None
    paths: tuple[str, ...]

    @property
    def multi_line(self) -> bool:
        """Whether a header cell holds a line break; such files must not be split."""
        return any("\n" in name for name in self.header or ())


def shapes(
    heads: DataFrame, candidates: Column, pick: Callable[[Cells], list[str] | None], folder: str | None = None, shared: bool = False
) -> list[Shape]:
    """The files grouped by header, one entry per header.

    ``candidates`` are records that may be the header; files with equal ones are grouped by
    tasks, and ``pick`` decides for each group. ``folder`` is a pattern of folder names whose
    files belong together: where all of them have equal candidates the folder stands for
    them. With ``shared`` the files of such a folder have one header in common, which stands
    in one of them.
    """
    parent = F.regexp_replace("file", "/[^/]*$", "")
    place = F.when(parent.rlike(f"{folder}$"), parent) if folder else F.lit(None).cast("string")
    found = heads.select("file", F.coalesce(place, F.col("file")).alias("place"), candidates.alias("candidates"))
    files = found.groupBy("place").agg(F.sort_array(F.collect_list(F.struct(F.col("file").alias("path"), "candidates"))).alias("files"))
    distinct = F.array_distinct(F.flatten(F.transform("files", lambda f: f["candidates"])))
    if shared:
        paths = files.select(F.col("place").alias("path"), distinct.alias("candidates"))
    else:
        alike = F.size(F.array_distinct(F.transform("files", lambda f: f["candidates"]))) == 1
        one = F.array(F.struct(F.col("place").alias("path"), F.get("files", F.lit(0))["candidates"].alias("candidates")))
        paths = files.select(F.explode(F.when(alike, one).otherwise(F.col("files"))).alias("f")).select("f.*")
    grouped = paths.groupBy("candidates").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    merged: dict[tuple[str, ...] | None, list[str]] = {}
    for row in grouped:
        cells = pick([next(csv.reader(io.StringIO(text, newline="")), []) for text in row["candidates"]])
        merged.setdefault(None if cells is None else tuple(cells), []).extend(map(unquote, row["paths"]))
    return sorted((Shape(header, tuple(sorted(paths))) for header, paths in merged.items()), key=lambda s: s.paths)
