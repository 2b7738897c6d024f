"""Near-duplicate embeddings: small-world graphs per shard, searched by every shard."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodseq.llm.components import components
from prodseq.llm.graphs import SmallWorld
from prodseq.llm.scratch import Scratch

#: Vectors of one shard, about; a label with more is split by a hash.
SHARD_ROWS = 8192
#: Vectors of a label that are audited: one in so many, and so many at most.
AUDIT_EVERY, AUDIT_MOST = 8, 1024
#: Share of audited vectors with links whose links must all be found.
RECALL = 0.99
#: Beams, and how far below the limit the walk around what a beam finds goes on; the last step compares with all.
STEPS = ((48, 0.0), (96, 0.03), (192, 0.06), (384, 0.09), (768, 0.12), (None, 0.0))
#: The step of a label none of whose audited vectors has a link.
UNSEEN = 2
#: What 32-bit vectors may be off; pairs are decided in double precision.
MARGIN = 1e-5


def _stored(nodes: np.ndarray, copies: np.ndarray, vectors: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, nodes=nodes, copies=copies, vectors=vectors, **SmallWorld(vectors).arrays())
    return out.getvalue()


class Shard:
    """A shard's nodes, their numbers of copies, unit vectors in double precision, and graph."""

    def __init__(self, payload: bytes):
        arrays = dict(np.load(io.BytesIO(payload)))
        self.nodes, self.copies, self.vectors = arrays.pop("nodes"), arrays.pop("copies"), arrays.pop("vectors")
        self.graph = SmallWorld.stored(self.vectors, arrays)

    def found(self, asking: np.ndarray, least: float, beam: int, slack: float) -> np.ndarray:
        """Which of the asking vectors (rows) the search links with which of the shard's (columns)."""
        linked = np.zeros((len(asking), len(self.nodes)), bool)
        for q, v in self.graph.within(asking.astype(np.float32), least - MARGIN, beam, slack):
            for i in range(0, len(q), 1 << 16):
                a, b = q[i : i + (1 << 16)], v[i : i + (1 << 16)]
                good = np.einsum("nd,nd->n", asking[a], self.vectors[b]) >= least
                linked[a[good], b[good]] = True
        return linked

    def exact(self, asking: np.ndarray, least: float) -> np.ndarray:
        """The same by comparing with every vector."""
        return np.concatenate([asking[i : i + 512] @ self.vectors.T >= least for i in range(0, max(1, len(asking)), 512)])

    def linked(self, asking: np.ndarray, least: float, step: int) -> np.ndarray:
        """The same at a step of the audit's ladder."""
        beam, slack = STEPS[step]
        return self.exact(asking, least) if beam is None else self.found(asking, least, beam, slack)


def links_between(a: Shard, b: Shard, least: float, step: int) -> np.ndarray:
    """Links of two shards as a truth table: each side searches the other's graph, and what either finds counts."""
    linked = b.linked(a.vectors, least, step)
    if a is b:
        linked |= linked.T
        np.fill_diagonal(linked, False)
        return linked
    return linked | a.linked(b.vectors, least, step).T


def audited(shard: Shard, nodes: np.ndarray, vectors: np.ndarray, least: float) -> pd.DataFrame:
    """(node, step, links, found) of the audited vectors that have links in a shard, themselves left out."""
    truth = shard.exact(vectors, least) & (nodes[:, None] != shard.nodes[None, :])
    has = np.flatnonzero(truth.any(axis=1))
    truth, asking = truth[has], vectors[has]
    links = truth.sum(axis=1)
    parts, found = [], np.zeros(len(has), np.int64)
    for step in range(len(STEPS)):
        if len(has) and (found < links).any():  # wider beams find no less
            found = np.maximum(found, (shard.linked(asking, least, step) & truth).sum(axis=1))
        parts.append(pd.DataFrame({"node": nodes[has], "step": np.int32(step), "links": links, "found": found}))
    return pd.concat(parts)


def _roots(a: Shard, b: Shard, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest node that each node of either side reaches within the table."""
    left, right = a.nodes.copy(), (a.nodes.copy() if a is b else b.nodes.copy())
    most = np.iinfo(np.int64).max
    while True:
        before = left.copy(), right.copy()
        for i in range(0, len(left), 512):
            part = linked[i : i + 512]
            left[i : i + 512] = np.minimum(left[i : i + 512], np.where(part, right[None, :], most).min(axis=1, initial=most))
        if a is b:
            right = left.copy()
        else:
            for i in range(0, len(left), 512):
                part = linked[i : i + 512]
                right = np.minimum(right, np.where(part, left[i : i + 512, None], most).min(axis=0, initial=most))
        if (left == before[0]).all() and (right == before[1]).all():
            return left, right


def _packed(nodes: np.ndarray, vectors: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, nodes=nodes, vectors=vectors)
    return out.getvalue()


def _units(vectors: pd.Series) -> np.ndarray:
    """Vectors of length 1 in double precision."""
    rows = np.stack(vectors.to_numpy()).astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # so that no square is out of range
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _steps(nodes: DataFrame, counts: DataFrame, shards: DataFrame, scratch: Scratch, least: float, recall: float, kind: str) -> DataFrame:
    """(label, size, step, recall): the first step of the ladder that passes each label's audit.

    A fixed sample of a label's vectors, taken by a hash, is compared with all of the label,
    shard by shard, and searches each shard's graph at every step until all is found. So an
    audit grows with the rows times a bounded sample. A row passes if all its links in all
    shards were found; rows without links do not count.
    """
    key = ["label", "size"]
    by_hash = Window.partitionBy(*key).orderBy(F.xxhash64("node"), "node")
    # tasks keep so many rows of a label each, so a frequent label is no large task
    first = nodes.withColumn("place", F.row_number().over(by_hash)).filter(F.col("place") <= AUDIT_MOST)
    sample = first.join(counts, key).filter(F.col("place") <= F.greatest(F.lit(16), F.ceil(F.col("n") / AUDIT_EVERY)))

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        payload = _packed(frame["node"].to_numpy(), _units(frame["vector"]))
        return pd.DataFrame({"label": frame["label"].iloc[:1], "size": frame["size"].iloc[:1], "asking": [payload]})

    samples = scratch.write(sample.select(*key, "node", "vector").groupBy(*key).applyInPandas(gather, f"label {kind}, size int, asking binary"), "audits")
    everywhere = samples.join(counts, key).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
    # one row of either side per shard
    meetings = shards.join(everywhere.select(*key, "shard", "asking"), [*key, "shard"]).select(*key, "payload", "asking")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asking = dict(np.load(io.BytesIO(batch.column("asking")[i].as_py())))
                seen = audited(Shard(batch.column("payload")[i].as_py()), asking["nodes"], asking["vectors"], least)
                here = batch.select(key).take(pa.array(np.full(len(seen), i)))
                yield pa.RecordBatch.from_arrays([*here.columns, *(pa.array(seen[c]) for c in ("node", "step", "links", "found"))], names=[*key, "node", "step", "links", "found"])

    spread = meetings.repartition(int(scratch.spark.conf.get("spark.sql.shuffle.partitions")))
    seen = spread.mapInArrow(look, f"label {kind}, size int, node long, step int, links long, found long")
    rows = seen.groupBy(*key, "node", "step").agg((F.sum("links") == F.sum("found")).alias("whole"))
    rated = rows.groupBy(*key, "step").agg(F.avg(F.col("whole").cast("double")).alias("recall"))
    passed = rated.filter(F.col("recall") >= recall).groupBy(*key).agg(F.min("step").alias("step"), F.min_by("recall", "step").alias("recall"))
    chosen = counts.join(passed, key, "left")
    return scratch.write(chosen.select(*key, "shards", F.coalesce("step", F.lit(UNSEEN)).alias("step"), "recall"), "steps")


def near_duplicates(
    rows: DataFrame, least: float = 0.93, shard_rows: int = SHARD_ROWS, recall: float = RECALL, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label"
) -> DataFrame:
    """Links, component and whether it is the component's first, per vector row.

    Vectors are compared when their labels are equal and not missing. Equal vectors of a
    label are one node with a number of copies. A label's nodes are dealt by a hash to
    shards of about ``shard_rows``; each shard's graph is built once and written. An audit
    of each label chooses the beam (``_steps``). Then every two shards of a label meet in
    one task of bounded size, search each other's graph, count the links of each node and
    return the smallest node it reaches there; pairs are never written. Every pair that
    counts was decided in double precision.

    Vectors that are missing, zero, or hold missing or non-finite numbers link with nothing,
    as do rows without label; vectors of different length too. A row without id belongs to
    its group's component (missing if alone) and is never kept; rows that repeat an id are
    separate vectors. Other columns are not read; an empty table gives an empty result.
    ``audit_recall`` is missing where no audited vector of the label has a link;
    ``graph_searches`` is the number of graphs the row's vector was looked for in.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "embeddings")
    vector, key = F.col("vector"), ["label", "size"]
    plain = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))
    given = scratch.write(plain.withColumn("vector", F.when(usable, vector)), "vectors")
    distinct = given.filter("vector IS NOT NULL").groupBy("label", "vector").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    nodes = scratch.write(distinct.withColumn("size", F.size("vector")), "nodes")
    counts = scratch.write(nodes.groupBy(*key).agg(F.count("*").alias("n")).withColumn("shards", F.ceil(F.col("n") / shard_rows)), "counts")
    dealt = nodes.join(counts, key).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")))
    kind = given.schema["label"].dataType.simpleString()

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("node")
        payload = _stored(frame["node"].to_numpy(), frame["copies"].to_numpy(), _units(frame["vector"]))
        return pd.DataFrame({"label": frame["label"].iloc[:1], "size": frame["size"].iloc[:1], "shard": frame["shard"].iloc[:1], "payload": [payload]})

    built = dealt.select(*key, "shard", "node", "copies", "vector").groupBy(*key, "shard").applyInPandas(build, f"label {kind}, size int, shard long, payload binary")
    shards = scratch.write(built, "shards")
    steps = _steps(nodes, counts, shards, scratch, least, recall, kind)
    # the list of meetings is small; each side then brings its shard under the shard's own key
    every = F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)
    pairs = steps.withColumn("shard", F.explode(every)).withColumn("other", F.explode(every)).filter("shard <= other")
    left = pairs.select(*key, "shard", "other", "step").join(shards, [*key, "shard"])
    right = shards.select(*key, F.col("shard").alias("other"), F.col("payload").alias("other_payload"))
    meetings = left.join(right, [*key, "other"]).select(
        "step", (F.col("shard") == F.col("other")).alias("same"), "payload", F.when(F.col("shard") != F.col("other"), F.col("other_payload")).alias("other_payload")
    )
    # a meeting is long work on a short row, so each may have a task of its own
    meetings = meetings.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                step = batch.column("step")[i].as_py()
                a = Shard(batch.column("payload")[i].as_py())
                b = a if batch.column("same")[i].as_py() else Shard(batch.column("other_payload")[i].as_py())
                linked = links_between(a, b, least, step)
                roots = _roots(a, b, linked)
                sides = [(a, linked @ b.copies, roots[0])] if a is b else [(a, linked @ b.copies, roots[0]), (b, a.copies @ linked, roots[1])]
                searches = int(STEPS[step][0] is not None)
                for shard, links, root in sides:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(shard.nodes), pa.array(links.astype(np.int64)), pa.array(root), pa.array(np.full(len(root), searches))], names=["node", "links", "root", "searches"]
                    )

    met = scratch.write(meetings.mapInArrow(meet, "node long, links long, root long, searches long"), "links")
    grouped = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch)
    totals = met.groupBy("node").agg(F.sum("links").alias("links"), F.sum("searches").alias("searches"))
    full = nodes.join(totals, "node").join(grouped, "node", "left").join(steps.select(*key, "recall"), key)
    full = full.select("label", "vector", "copies", "links", "searches", "recall", F.coalesce("root", "node").alias("root"))
    named = given.join(full, ["label", "vector"], "left").select(
        "id", F.coalesce("root", "row").alias("root"), F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"), "recall", F.coalesce("searches", F.lit(0)).alias("searches")
    )
    least_id = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(least_id, "root").select(
        F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
        F.col("recall").alias("audit_recall"), F.col("searches").alias("graph_searches"),
    )
