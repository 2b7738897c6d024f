"""MinHash near-duplicates by an inverted join over signature coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodseq.llm.batches import over_texts, sliced, texts_of
from prodseq.llm.components import components
from prodseq.llm.scratch import Scratch, met
from prodseq.llm.shingles import shingle_sets

#: Signature coordinates that are posted, and how many two documents must share to be compared.
#: At a similarity of 0.8 a pair shares fewer than 24 of 48 with a chance below 0.000002.
COORDINATES, MATCHES = 48, 24
#: Nodes of a block in which the undecided part of a cluster is compared.
BLOCK = 512
#: Text bytes whose sets are made at once in a task.
SLICE_BYTES = 1 << 20

_seeds = np.random.default_rng(20240229)
_XOR = _seeds.integers(0, 1 << 32, COORDINATES, dtype=np.uint32)
_TIMES = _seeds.integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each coordinate's hash over a set, as 32-bit numbers."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(COORDINATES, (1 << 32) - 1, np.uint32)
    for start in range(0, len(short), 1 << 12):
        part = short[start : start + (1 << 12)]
        np.minimum(least, ((part[None, :] ^ _XOR[:, None]) * _TIMES[:, None]).min(axis=1), out=least)
    return least


def _sign(docs: DataFrame, width: int) -> DataFrame:
    """(row, id, n_shingles, set_key, coordinates, sketch) with one row per document row."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(texts_of(batch), width)
        counts = np.array([len(s) > 0 for s in sets])
        signed = np.array([signature(s) for s in sets if len(s)], np.uint32).reshape(-1, COORDINATES)
        # the lowest bits of a product are poor: the bits that sketches hold come from above
        bytes_ = (signed >> np.uint32(12)).astype(np.uint8).view("<i8")

        def lists(values: np.ndarray) -> pa.Array:
            ends = np.concatenate([[0], np.cumsum(counts * values.shape[1])]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))

        return {
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "set_key": pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
            "coordinates": lists(signed.view("<i4")),
            "sketch": lists(bytes_),
        }

    return over_texts(docs, ["row", "id", "text"], run, "n_shingles long, set_key binary, coordinates array<int>, sketch array<long>", SLICE_BYTES)


def _prefixes(nodes: DataFrame, scratch: Scratch, coordinates: int, matches: int) -> DataFrame:
    """(key, node): postings of the rarest coordinate values, of values that some other node has.

    Documents are posted under each pair of coordinate and value. A node with fewer than
    ``matches`` shared values has no partner and is skipped. Of the others, two that share
    ``matches`` values must share one among their ``coordinates - matches + 1`` rarest
    (rarest first, ties by value); values no other node has come first there and need no posting.
    """
    posted = nodes.select("node", F.posexplode("coordinates").alias("k", "v")).select(
        "node", (F.shiftleft(F.col("k").cast("long"), 32) + F.col("v").cast("long")).alias("key")
    )
    shared = posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    by_node = Window.partitionBy("node")
    ranked = posted.join(met(shared), "key").select(
        "node", "key", F.row_number().over(by_node.orderBy("n", "key")).alias("place"), F.count("*").over(by_node).alias("held")
    )
    kept = ranked.filter(F.col("place") <= F.col("held") - (matches - 1)).select("key", "node")
    return scratch.write(kept.join(met(nodes.select("node", "sketch")), "node").select("key", "node", "sketch"), "prefixes")


def _collisions(a: Column, b: Column, coordinates: int) -> Column:
    """Coordinates whose bytes in two sketches agree, at least as many as those that agree.

    A sketch holds eight bytes in a number. The bits of each byte of the exclusive or are
    folded into its lowest one, which stays unset where the sketches agree.
    """
    total = F.lit(coordinates)
    for k in range(coordinates // 8):
        x = a[k].bitwiseXOR(b[k])
        for shift, mask in ((4, 0x0F0F0F0F0F0F0F0F), (2, 0x0303030303030303), (1, 0x0101010101010101)):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift)).bitwiseAND(F.lit(mask))
        total = total - F.bit_count(x)
    return total


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs, a written table, that are similar enough on their full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("hashes_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("hashes_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "hashes_a"):
            linked = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("hashes_a", "hashes_b"))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    linked.append(i)
            yield batch.select(["a", "b"]).take(pa.array(linked, pa.int64()))

    joined = met(pairs, pairs.count()).join(right, "b").join(met(left), "a").select("a", "b", "hashes_a", "hashes_b")
    return joined.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, width: int = 2, percent: int = 80, coordinates: int = COORDINATES, matches: int = MATCHES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Shingle set size, component and whether it is the component's first, per document row.

    Documents with equal sets are one node of the graph, so copies are never paired. First
    the nodes of each posting list are matched with one pivot of it, and each node's best
    match is verified; so a group of copies that resemble each other becomes one component
    with as many comparisons as nodes. Nodes that matched are clusters. Within a cluster,
    nodes outside its main component are compared with all others in blocks; between
    clusters, nodes of one posting list are matched pair by pair. So no pair that shares a
    list and could join two components is left out.

    A missing or empty text has an empty set and links with nothing; its component is its
    own id. A row without id takes the component of its group (missing if the group has no
    id) and is never kept. Rows that repeat an id and text are in one component and share
    the verdict. Other columns are not read; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    plain = scratch.write(plain, "documents")  # row numbers must stay what they are
    signed = scratch.write(_sign(plain, width), "signatures")
    rooted = _rooted(plain, signed, scratch, width, percent, coordinates, matches)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(met(least), "root").select("set_key", "component_id")
    found = signed.select("id", "n_shingles", "set_key").join(met(named), "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(
        F.col("id").alias(id_column), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")
    )


def keep_one(
    docs: DataFrame, width: int = 5, percent: int = 80, coordinates: int = COORDINATES, matches: int = MATCHES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The input rows without near copies: of each component one row, of the smallest id.

    Rows that repeat an id and text are copies too, so one of them stays; rows without id
    stay only if their component has no id. Texts without words all stay.
    """
    scratch = Scratch(docs.sparkSession, "minhash")
    numbered = scratch.write(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "documents")
    plain = numbered.select("row", F.col("doc")[id_column].alias("id"), F.col("doc")[text_column].alias("text"))
    signed = scratch.write(_sign(plain, width), "signatures")
    rooted = _rooted(plain, signed, scratch, width, percent, coordinates, matches).select("set_key", "root")
    placed = signed.select("row", "id", "set_key").join(met(rooted), "set_key", "left")
    group = F.struct(F.col("set_key").isNull().alias("empty"), F.coalesce("root", "row").alias("root"))
    kept = placed.groupBy(group.alias("group")).agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "row")).alias("first")).select("first.row")
    # the kept rows follow a join of tables, which Spark does not size too low; they stay in the order they had
    return numbered.join(kept, "row", "left_semi").select("doc.*")


def _rooted(plain: DataFrame, signed: DataFrame, scratch: Scratch, width: int, percent: int, coordinates: int, matches: int) -> DataFrame:
    """(set_key, least_id, root): the component of each distinct set, and its smallest id."""
    nodes = scratch.write(
        signed.filter("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("row").alias("node"), F.min("id").alias("least_id"), *(F.first(c).alias(c) for c in ("coordinates", "sketch"))),
        "nodes",
    )
    prefixes = _prefixes(nodes, scratch, coordinates, matches)
    probes = scratch.write(_probes(prefixes, coordinates, matches), "probes")
    first = probes.select("a", "b")
    links = scratch.write(_verified(first, scratch.write(_sets(plain, _ends(first, scratch), width), "sets"), percent), "links")
    roots = components(links, scratch)

    tried = probes.select(F.explode(F.array("a", "low")).alias("a"), "b")
    clusters = components(tried, scratch).withColumnRenamed("root", "cluster")
    inner = _within_clusters(clusters, roots, lambda wanted: _sets(plain, wanted, width), scratch, percent)

    mixed = scratch.write(_mixed(prefixes, clusters).join(met(roots), "node", "left").withColumn("root", F.coalesce("root", "node")), "mixed-lists")
    names = ("node", "root", "cluster", "sketch")
    left = mixed.filter("NOT inside").select("key", *(F.col(c).alias(f"{c}_a") for c in names))
    right = mixed.select("key", "inside", *(F.col(c).alias(f"{c}_b") for c in names))
    apart = (F.col("cluster_a") != F.col("cluster_b")) & (F.col("root_a") != F.col("root_b")) & (F.col("inside") | (F.col("node_a") < F.col("node_b")))
    alike = _collisions(F.col("sketch_a"), F.col("sketch_b"), coordinates) >= matches
    rest = scratch.write(left.join(met(right), "key").filter(apart & alike).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct(), "rest")
    outer = _verified(rest, scratch.write(_sets(plain, _ends(rest, scratch), width), "sets"), percent)
    grouped = components(links.unionByName(inner).unionByName(outer), scratch)

    return nodes.join(met(grouped), "node", "left").select("set_key", "least_id", F.coalesce("root", "node").alias("root"))


def _probes(prefixes: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """(a, b, low): for each node b the pivot of its lists most like it, and the smallest one, if alike enough.

    A list's pivot is chosen by a hash of node and list, so a node in many lists of one
    group meets many of the group's nodes.
    """
    pivots = prefixes.groupBy("key").agg(F.min_by(F.struct("node", "sketch"), F.xxhash64("node", "key")).alias("pivot"))
    matched = prefixes.join(met(pivots), "key").filter(F.col("node") != F.col("pivot.node"))
    alike = _collisions(F.col("sketch"), F.col("pivot.sketch"), coordinates)
    scored = matched.select(F.col("pivot.node").alias("a"), F.col("node").alias("b"), alike.alias("alike")).filter(F.col("alike") >= matches)
    return scored.groupBy("b").agg(F.max_by("a", F.struct("alike", "a")).alias("a"), F.min("a").alias("low"))


def _ends(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.write(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends")


def _within_clusters(clusters: DataFrame, roots: DataFrame, sets_of: Callable[[DataFrame], DataFrame], scratch: Scratch, percent: int) -> DataFrame:
    """(a, b): links between different components of one cluster of alike nodes.

    Nodes outside a cluster's main component are compared with all of the cluster, block
    by block: a task holds two blocks, counts common shingles by a matrix product, and
    returns one link for each node and component it meets. Pairs are never written.
    """
    placed = clusters.join(met(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    shares = placed.groupBy("cluster", "root").count().groupBy("cluster").agg(
        F.max_by("root", F.struct("count", "root")).alias("main"), F.sum("count").alias("n"), F.count("*").alias("roots")
    )
    undecided = placed.join(met(shares.filter("roots > 1")), "cluster").select(
        "cluster", "node", "root", (F.col("root") == F.col("main")).alias("inside"), F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK)).alias("block")
    )
    undecided = scratch.write(undecided, "undecided")
    n = undecided.count()
    held = scratch.write(met(undecided, n).join(sets_of(undecided.select("node")), "node"), "held")
    asked = held.filter("NOT inside")
    left = asked.join(met(undecided.select("cluster", F.col("block").alias("against")).distinct(), n), "cluster").withColumn("asking", F.col("block"))
    right = held.join(met(undecided.filter("NOT inside").select("cluster", F.col("block").alias("asking")).distinct(), n), "cluster").withColumn("against", F.col("block"))
    columns = ["cluster", "asking", "against", "side", "node", "root", "hashes"]
    both = left.withColumn("side", F.lit(0)).select(*columns).unionByName(right.withColumn("side", F.lit(1)).select(*columns))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        sides = [frame[frame["side"] == k] for k in (0, 1)]
        sets = [[np.frombuffer(h, np.uint64) for h in side["hashes"]] for side in sides]
        both = _common(*sets)
        sizes = [np.array([len(x) for x in s]) for s in sets]
        linked = 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)
        linked &= sides[0]["root"].to_numpy()[:, None] != sides[1]["root"].to_numpy()[None, :]
        at = np.argwhere(linked)
        found = pd.DataFrame({"a": sides[0]["node"].to_numpy()[at[:, 0]], "b": sides[1]["node"].to_numpy()[at[:, 1]], "root": sides[1]["root"].to_numpy()[at[:, 1]]})
        return found.drop_duplicates(["a", "root"])[["a", "b"]]

    return scratch.write(both.groupBy("cluster", "asking", "against").applyInPandas(compare, "a long, b long"), "inner-links")


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every left with every right set."""
    flat = [np.concatenate([*s, np.zeros(0, np.uint64)]) for s in (left, right)]
    owner = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in (left, right)]
    shared = np.intersect1d(flat[0], flat[1])
    total = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(shared), 4096):
        part = shared[start : start + 4096]
        tables = []
        for values, rows, count in ((flat[0], owner[0], len(left)), (flat[1], owner[1], len(right))):
            at = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[at] == values
            table = np.zeros((count, len(part)), np.float32)
            table[rows[hit], at[hit]] = 1
            tables.append(table)
        total += tables[0] @ tables[1].T
    return total.astype(np.int64)


def _mixed(prefixes: DataFrame, clusters: DataFrame) -> DataFrame:
    """Posting lists with several clusters; ``inside`` marks nodes of a list's main one."""
    labelled = prefixes.join(met(clusters), "node", "left").withColumn("cluster", F.coalesce("cluster", "node"))
    shares = labelled.groupBy("key", "cluster").count().groupBy("key").agg(F.max_by("cluster", F.struct("count", "cluster")).alias("main"), F.count("*").alias("clusters"))
    return labelled.join(met(shares.filter("clusters > 1")), "key").select("key", "node", "sketch", "cluster", (F.col("cluster") == F.col("main")).alias("inside"))


def _sets(plain: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, hashes): full shingle sets of the wanted nodes, a written table, made anew from their texts.

    A node's number is the number of a row with its set, so each node meets one text.
    """
    joined = plain.join(met(wanted.select("node"), wanted.count()), F.col("row") == F.col("node")).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, most=SLICE_BYTES):
            sets = shingle_sets(texts_of(batch), width)
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "hashes"])

    return joined.mapInArrow(run, "node long, hashes binary")
