"""What a query writes, shuffles and puts into one task grows no faster than its input."""

import os
import re
from collections import Counter
from contextlib import contextmanager

import pytest
from frames import DAY
from pyspark.sql import functions as F

import __spark_entry__ as entry
from prodseq.fixtures import views
from prodseq.operators.ranking import stored_rows, with_rank
from prodseq.plans.workspace import Workspace

SF_DIR = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    named = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k) for k in named}
    for k, v in named.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.fixture
def fresh(tmp_path):
    """Tables at a path from which nothing has landed."""
    os.symlink(SF_DIR, tmp_path / "sf")
    return str(tmp_path / "sf")


@pytest.mark.parametrize(
    ("query", "folders"),
    [("src_mould_csv", {"Daily Mould Report"}), ("src_dated_reports", {"BOR"}), ("date_range_dates", {"BOR", "SPOR", "BMR", "BPR"})],
)
def test_only_the_sheets_a_query_reads_are_written(spark, fresh, query, folders):
    assert entry.queries()[query](spark, fresh).count() > 0
    root = views.landed_csv(spark, fresh, []).removeprefix("file:")
    assert set(os.listdir(f"{root}/Vectordata")) == folders


def test_sheets_written_one_by_one_hold_every_row_once(spark, fresh):
    for query in ["src_mould_csv", "src_dated_reports", "gate_complete_dates", "src_mould_csv"]:
        alone = entry.queries()[query](spark, fresh)
        together = entry.queries()[query](spark, SF_DIR)
        assert alone.count() == together.count() and alone.exceptAll(together).isEmpty()


def test_lines_are_written_once(spark, fresh, tmp_path):
    found = views.landed(spark, fresh)
    root = found.workspace.root.removeprefix("file:")
    written = {n.rsplit("-", 1)[0] for n in os.listdir(root)}
    assert written == {"base", "bor", "bmr", "bpr", "curing", "manual"}
    # one table alone is written itself, without the base rows; the rows are the same
    os.symlink(SF_DIR, tmp_path / "other")
    for name in ("dispatch", "mould"):
        alone = views.landed(spark, str(tmp_path / "other"), names=[name]).tables[name]
        assert alone.dtypes == found.tables[name].dtypes
        assert alone.count() == found.tables[name].count() > 0 and alone.exceptAll(found.tables[name]).isEmpty()


def test_lines_are_not_shuffled_by_customer(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        plan = views.base_rows(spark, SF_DIR, yearly=False)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    (at,) = [i for i, text in enumerate(lines) if re.search(r"Join Inner, \(o_custkey", text)]
    depth = re.search(r"[A-Za-z]", lines[at]).start()
    below = []
    for text in lines[at + 1 :]:
        if re.search(r"[A-Za-z]", text).start() <= depth:
            break
        below.append(text)
    assert below and not any("l_partkey" in text for text in below)


def test_equal_buffer_rows_are_found_by_numbers(spark):
    base = spark.createDataFrame(
        [(DAY, "a", "1300_OE10", 1, "Brand#1", s, n) for s in (1, 1, 13, 85, None) for n in (1, 5, 2, None)],
        "report_date date, sku string, loc string, p_partkey long, p_brand string, l_suppkey long, l_linenumber int",
    )
    found = views.bpr(base).filter("`Top SKU` = 'F'")
    assert found.count() == found.distinct().count() == 9  # (L1, 1), (L1, 6) and missing, each in Red, Yellow and missing
    exchanges = [x for x in views.bpr(base)._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in x]
    assert any("place" in x and "colour" in x for x in exchanges)


def test_rows_of_a_frequent_score_are_dealt_over_tasks(spark, tmp_path):
    space = Workspace(spark, copies_per_task=100)
    df = spark.range(4000).select(
        F.lit(DAY).alias("report_date"), "id", F.when(F.col("id") % 10 > 6, F.lit(None).cast("double")).when(F.col("id") % 10 > 0, -0.0).otherwise(F.col("id") * 1.0).alias("score")
    )
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false"):
        ranked = with_rank(stored_rows(space, df, "scores"), F.col("score"), "rank")
        # with the rank in it, since the join falls away where that is not read
        rows = ranked.withColumn("task", F.spark_partition_id()).collect()
    tasks = Counter(r["task"] for r in rows)
    assert max(tasks.values()) < 1200  # 2400 rows share a score, 1200 have none
    above = {r["id"]: r["rank"] for r in rows}
    assert len(rows) == len(above) == 4000
    assert {above[i] for i in range(4000) if i % 10 > 6} == {None}
    assert {above[i] for i in range(4000) if 0 < i % 10 <= 6} | {above[0]} == {400}
    assert [above[i] for i in range(3990, 0, -10)] == list(range(1, 400))
