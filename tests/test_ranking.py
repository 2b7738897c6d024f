"""Ranks on the distributed path equal the plain window, whatever the ties."""

from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from prodseq.operators.ranking import rows_above, stored_rows, with_rank, with_row_number
from prodseq.plans.workspace import Workspace

DAY = date(2026, 1, 1)


def random_rows(spark, n, scores, hot, seed):
    """``hot`` of the rows share one score; one date holds most rows."""
    pick = F.rand(seed)
    return spark.range(n).select(
        "id",
        F.when(pick < 0.7, F.lit(DAY))
        .when(pick < 0.9, F.lit(DAY + timedelta(1)))
        .otherwise(F.lit(DAY + timedelta(2)))
        .alias("report_date"),
        F.when(F.rand(seed + 1) < hot, F.lit(0.5))
        .when(F.rand(seed + 2) < 0.02, F.lit(None).cast("double"))
        .otherwise(F.floor(F.rand(seed + 3) * scores) / scores)
        .alias("score"),
    )


@pytest.mark.parametrize(
    ("scores", "hot", "aqe"),
    [(7, 0.0, "true"), (10_000, 0.4, "true"), (1, 1.0, "false"), (10_000, 0.35, "false")],
)
def test_distributed_rank_equals_window(spark, tiny_tasks, scores, hot, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        rows = stored_rows(tiny_tasks, random_rows(spark, 5000, scores, hot, scores), "t")
        ranked = with_rank(rows, F.col("score"), "r").select("id", "r")
        window = Window.partitionBy("report_date").orderBy(F.col("score").desc_nulls_last())
        plain = rows.df.select(
            "id", F.when(F.col("score").isNotNull(), F.rank().over(window)).alias("r")
        )
        assert ranked.count() == 5000
        assert ranked.exceptAll(plain).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("aqe", ["true", "false"])
def test_distributed_row_number_is_a_permutation_in_order(spark, tiny_tasks, aqe):
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        rows = stored_rows(tiny_tasks, random_rows(spark, 5000, 20, 0.3, 5), "t")
        order = [F.col("score").desc_nulls_last()]
        numbered = with_row_number(rows, order, "n")
        back = Window.partitionBy("report_date").orderBy("n")
        checked = numbered.withColumn("_row", F.row_number().over(back)).withColumn(
            "_before", F.lag("score").over(back)
        )
        wrong = checked.filter((F.col("_row") != F.col("n")) | (F.col("_before") < F.col("score")))
        assert wrong.isEmpty() and checked.count() == 5000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_score_is_spread_over_tasks(spark, tiny_tasks):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        equal = spark.range(8000).select(F.lit(DAY).alias("report_date"), F.lit(1.0).alias("score"))
        rows = stored_rows(tiny_tasks, equal, "t")
        numbered = with_row_number(rows, [F.col("score").desc()], "n")
        assert numbered.select("n").distinct().count() == 8000
        ranked = [p for p in _written(tiny_tasks) if "ranked" in p]
        sizes = spark.read.parquet(ranked[0]).groupBy("_slice").count().collect()
        assert len(sizes) == 8 and max(r["count"] for r in sizes) < 2500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _written(ws):
    import os

    root = ws.root.removeprefix("file:")
    return [os.path.join(root, p) for p in os.listdir(root)]


def test_negative_zero_ties_with_zero(spark, tiny_tasks, ws):
    df = spark.createDataFrame([(DAY, 0.0), (DAY, -0.0), (DAY, -1.0)], "report_date date, score double")
    for space in (ws, tiny_tasks):
        rows = with_rank(stored_rows(space, df, "t"), F.col("score"), "r").collect()
        assert sorted(r["r"] for r in rows) == [1, 1, 3]


@pytest.mark.parametrize(("scores", "slice_rows"), [(4000, 1), (4000, 7), (50, 3), (3, 1)])
def test_counts_above_each_score(spark, scores, slice_rows):
    rows = random_rows(spark, 6000, scores, 0.3, 11).filter("score IS NOT NULL")
    counts = rows.groupBy("report_date", F.col("score").alias("_score")).agg(F.count("*").alias("_n"))
    found = {(r["report_date"], r["_score"]): r["_above"] for r in rows_above(counts, slice_rows).collect()}
    held = {}
    for r in counts.collect():
        held.setdefault(r["report_date"], []).append((r["_score"], r["_n"]))
    want = {}
    for day, pairs in held.items():
        above = 0
        for score, n in sorted(pairs, reverse=True):
            want[day, score] = above
            above += n
    assert found == want


def test_scores_of_a_large_date_are_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counts = spark.range(20_000).select(F.lit(DAY).alias("report_date"), F.col("id").cast("double").alias("_score"), F.lit(1).cast("long").alias("_n"))
        plan = rows_above(counts, 1000)
        sizes = plan.groupBy(F.spark_partition_id()).count().collect()
        assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 8000
        assert plan.filter(F.col("_above") != 19_999 - F.col("_score")).isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_empty_input(spark, tiny_tasks):
    rows = stored_rows(tiny_tasks, random_rows(spark, 0, 5, 0.0, 1), "t")
    assert rows.df.isEmpty()
    assert with_row_number(rows, [F.col("score").desc()], "n").count() == 0
    assert with_rank(rows, F.col("score"), "r").count() == 0


def test_release_deletes_only_own_tables(spark):
    one, two = Workspace(spark), Workspace(spark)
    kept = one.write(spark.range(3), "t")
    two.write(spark.range(3), "t")
    two.release()
    import os

    assert kept.count() == 3 and not os.path.exists(two.root.removeprefix("file:"))
    one.release()
