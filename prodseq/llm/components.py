"""Connected components of a large graph by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from prodseq.llm.scratch import Scratch, met


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is its smallest node.

    Large-star and small-star steps alternate until the edges stay the same: a number of
    rounds that grows with the logarithm of the longest path. Each round is written, so
    lineage stays short; no neighbourhood is gathered in a task. Missing ends and loops
    are left out; no edges give no rows.
    """
    now, state = _written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), scratch)
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = 2 * state[0]  # at most
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(met(least, ends), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(met(low, ends), "a").select(F.explode(F.array(F.struct(F.col("b").alias("x"), F.col("m").alias("y")), F.struct(F.col("a").alias("x"), F.col("m").alias("y")))).alias("e"))
        last, before = now, state
        now, state = _written(small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).filter("a <> b").distinct(), scratch)
        scratch.drop(last)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _written(edges: DataFrame, scratch: Scratch) -> tuple[DataFrame, tuple]:
    """The written edges, and a count and two sums of hashes that equal edge sets share.

    They are taken during the write; a task that ran twice could only cause one more round.
    """
    seen = Observation()
    kept = scratch.write(edges.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("x"), F.sum(F.hash("a", "b").cast("long")).alias("y")), "edges")
    got = seen.get
    return kept, (got["n"], got["x"], got["y"])
