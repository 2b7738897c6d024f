"""Ranked lexical search over hashed max-sketches of documents.

A document's sketch is a byte array several times as large as its vocabulary. Each term
falls on two coordinates, and a coordinate keeps the largest term frequency that falls on
it, up to 255. For one document a term's impact only grows with its frequency, so the
smaller of a term's two coordinates bounds its impact from above, and the weighted sum
over a query's terms bounds the document's score.

A search looks up all terms of a block of queries in all sketches, scores the documents of
the highest bounds exactly and so gets a threshold for each query. Every task then goes
down its own documents by bound and scores them exactly until the bound is below it.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prodseq.llm.batches import over_texts, sliced, texts_of
from prodseq.llm.scratch import Scratch
from prodseq.llm.shingles import hashes_of_runs
from prodseq.llm.shipping import send_package

#: Fixed: letters A-Z become small, digits, letters and all bytes from 128 on make terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: Coordinates for each distinct term, least coordinates, and the largest frequency kept.
SPREAD, LEAST, FULL = 8, 64, 255
#: Fixed: scale of an impact, and the parts of the length norm.
SCALE, NORM, BASE_NORM, LENGTH_NORM = 1_000_000_000, 12, 75, 25
#: Bytes of sketches that are looked up at once.
LOOKUP_BYTES = 2 << 20


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8; a missing text has none."""
    return (text or "").encode().translate(_TERM_BYTES).split()


def _impacts(frequency: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What an occurrence count adds for a term of weight 1, in whole numbers."""
    frequency = frequency.astype(np.int64)
    return SCALE * frequency // (1000 * frequency + NORM * norm)


def _places(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two coordinates of each term in a sketch of ``size``, a power of two."""
    mask = np.uint64(size - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def sketch(hashes: np.ndarray, frequency: np.ndarray) -> bytes:
    """Coordinatewise maxima of the frequencies of distinct terms."""
    size = max(LEAST, 1 << (SPREAD * len(hashes) - 1).bit_length()) if len(hashes) else LEAST
    folded = np.zeros(size, np.uint8)
    held = np.minimum(frequency, FULL).astype(np.uint8)
    for at in _places(hashes, size):
        np.maximum.at(folded, at, held)
    return folded.tobytes()


def build_index(docs: DataFrame, scratch: Scratch, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, id, n_terms, sketch, text), written once; searches read the columns they need."""

    def run(batch: pa.RecordBatch) -> dict:
        texts = texts_of(batch)
        hashes, counts = hashes_of_runs([t.encode().translate(_TERM_BYTES) for t in texts])
        sketches, start = [], 0
        for n in counts.tolist():
            sketches.append(sketch(*np.unique(hashes[start : start + n], return_counts=True)))
            start += n
        return {"n_terms": pa.array(counts), "sketch": pa.array(sketches, pa.binary()), "text": batch.column("text")}

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return scratch.write(over_texts(numbered, ["row", "id", "text"], run, "n_terms long, sketch binary, text string"), "index")


@dataclass
class Queries:
    """A block of queries: their terms, how often each query holds a term, and term weights."""

    words: list[bytes]
    hashes: np.ndarray
    counts: np.ndarray  # queries x terms
    weights: np.ndarray  # of each term; zero until the statistics are known
    documents: int = 0
    length: int = 0

    @classmethod
    def of(cls, texts: list[str | None]) -> Queries:
        held = [Counter(terms(t)) for t in texts]
        words = sorted(set().union(*held))
        place = {w: i for i, w in enumerate(words)}
        counts = np.zeros((len(texts), len(words)), np.int64)
        for i, c in enumerate(held):
            for word, n in c.items():
                counts[i, place[word]] = n
        return cls(words, hashes_of_runs([b" ".join(words)])[0], counts, np.zeros(len(words), np.int64))

    def weigh(self, frequency: np.ndarray, documents: int, length: int) -> None:
        """Term weights from the number of documents that hold each term."""
        self.documents, self.length = documents, length
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * f + 1))) for f in frequency.tolist()], np.int64)

    def norms(self, n_terms: np.ndarray) -> np.ndarray:
        return BASE_NORM + (LENGTH_NORM * n_terms.astype(np.int64) * self.documents) // max(1, self.length)

    def bounds(self, n_terms: np.ndarray, sketches: list[bytes]) -> np.ndarray:
        """Upper bounds of all scores, documents x queries. Sums stay below 2^53, so doubles hold them exactly."""
        weighted = (self.counts * self.weights).T.astype(float)
        out = np.zeros((len(sketches), len(self.counts)))
        sizes, norms = np.array([len(s) for s in sketches]), self.norms(n_terms)
        for size in np.unique(sizes[n_terms > 0]).tolist():
            rows = np.flatnonzero((sizes == size) & (n_terms > 0))
            first, second = _places(self.hashes, size)
            step = max(1, LOOKUP_BYTES // max(size, 8 * len(self.words)))
            for start in range(0, len(rows), step):
                some = rows[start : start + step]
                folded = np.frombuffer(b"".join(sketches[i] for i in some), np.uint8).reshape(len(some), size)
                most = np.minimum(folded[:, first], folded[:, second])
                at = np.nonzero(most)
                impact = np.zeros(most.shape)
                found = most[at]
                impact[at] = np.where(found == FULL, SCALE // 1000, _impacts(found, norms[some][at[0]]))
                out[some] = impact @ weighted
        return out

    def exact(self, document: tuple[Counter, int], query: int) -> int:
        """Score of a document, given as its term frequencies and number of terms."""
        frequency, n_terms = document
        norm = NORM * int(self.norms(np.array([n_terms]))[0])
        total = 0
        for i in np.flatnonzero(self.counts[query]).tolist():
            tf = frequency.get(self.words[i], 0)
            total += int(self.counts[query, i]) * int(self.weights[i]) * (SCALE * tf // (1000 * tf + norm))
        return total


def _counted(text: str | None) -> tuple[Counter, int]:
    found = terms(text)
    return Counter(found), len(found)


class _Best:
    """The k best rows of each query: highest value, then smallest id (missing last), then first row."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.heaps: list[list[tuple]] = [[] for _ in range(queries)]

    def add(self, query: int, value: int, key: int | None, row: int) -> None:
        entry = (value, key is not None, -(key or 0), -row)
        heap = self.heaps[query]
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        elif entry > heap[0]:
            heapq.heapreplace(heap, entry)

    def least(self, query: int) -> int:
        """What a value must reach to matter."""
        heap = self.heaps[query]
        return heap[0][0] if len(heap) == self.k else 1

    def table(self) -> pa.RecordBatch:
        rows = [(q, value, -key if known else None, -row) for q, heap in enumerate(self.heaps) for value, known, key, row in heap]
        query, value, key, row = zip(*rows, strict=True) if rows else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(value, pa.int64()), pa.array(key, pa.int64()), pa.array(row, pa.int64())], names=["query", "value", "id", "row"])


_BEST = "query int, value long, id long, row long"


def document_frequencies(index: DataFrame, queries: Queries) -> np.ndarray:
    """In how many documents of the index each query term stands; tasks send one count for a term."""
    words = frozenset(queries.words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in sliced(batches):
            for text in texts_of(batch):
                held.update(words.intersection(terms(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["term", "n"])

    counted = index.select("text").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {bytes(r["term"]): r["n"] for r in counted.collect()}  # at most one row for a query term
    return np.array([found.get(w, 0) for w in queries.words], np.int64)


def _highest_bounds(index: DataFrame, queries: Queries, k: int) -> DataFrame:
    """(query, value, id, row): of each query the k documents of the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(queries.counts), k)
        for batch in sliced(batches, "sketch"):
            bounds = queries.bounds(batch.column("n_terms").to_numpy(), batch.column("sketch").to_pylist())
            ids, rows = batch.column("id").to_pylist(), batch.column("row").to_pylist()
            for q in range(bounds.shape[1]):
                column = bounds[:, q]
                for i in np.flatnonzero(column >= best.least(q)).tolist():
                    best.add(q, int(column[i]), ids[i], rows[i])
        yield best.table()

    return _top(index.select("row", F.col("id").cast("long").alias("id"), "n_terms", "sketch").mapInArrow(run, _BEST), k)


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.col("value").desc(), F.col("id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _descend(index: DataFrame, queries: Queries, k: int, threshold: np.ndarray) -> DataFrame:
    """(query, value, id, row) with exact scores: of each task the k best that reach the threshold.

    A task takes its documents slice by slice. In a slice it goes down the bounds of a query
    and stops where they fall below the threshold or below its own k-th score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(queries.counts), k)
        for batch in sliced(batches, "sketch"):
            bounds = queries.bounds(batch.column("n_terms").to_numpy(), batch.column("sketch").to_pylist())
            ids, rows, texts = (batch.column(c).to_pylist() for c in ("id", "row", "text"))
            low = np.maximum(threshold, [best.least(q) for q in range(bounds.shape[1])])
            counted: dict[int, tuple[Counter, int]] = {}  # documents of the slice that were scored
            for q in np.flatnonzero((bounds >= low).any(axis=0)).tolist():
                column = bounds[:, q]
                some = np.flatnonzero(column >= low[q])
                for i in some[np.argsort(-column[some], kind="stable")].tolist():
                    if column[i] < best.least(q):
                        break
                    if i not in counted:
                        counted[i] = _counted(texts[i])
                    score = queries.exact(counted[i], q)
                    if score >= threshold[q]:
                        best.add(q, score, ids[i], rows[i])
        yield best.table()

    return index.select("row", F.col("id").cast("long").alias("id"), "n_terms", "sketch", "text").mapInArrow(run, _BEST)


def _exact_scores(candidates: DataFrame, index: DataFrame, queries: Queries) -> DataFrame:
    """(query, value) of a few candidates, scored on their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            query = batch.column("query").to_pylist()
            scores = [queries.exact(_counted(t), q) for q, t in zip(query, texts_of(batch), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("query"), pa.array(scores, pa.int64())], names=["query", "value"])

    return index.select("row", "text").join(F.broadcast(candidates.select("row", "query")), "row").select("query", "text").mapInArrow(run, "query int, value long")


def _blocks(items: DataFrame, most: int) -> Iterator[list]:
    """Queries in blocks of at most ``most``; only one block is held at a time."""
    block = []
    for row in items.toLocalIterator():
        block.append(row)
        if len(block) == most:
            yield block
            block = []
    if block:
        yield block


def search_block(index: DataFrame, texts: list[str | None], scratch: Scratch, k: int) -> DataFrame:
    """(query, value, id, row, rank) of the k best documents of each of a block of queries."""
    queries = Queries.of(texts)
    totals = index.filter("n_terms > 0").agg(F.count("*").alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("length")).first()
    queries.weigh(document_frequencies(index, queries), totals["n"], totals["length"])
    # k rows for a query at most
    first = scratch.write(_highest_bounds(index, queries, k), "highest-bounds")
    scored = _exact_scores(first, index, queries).filter("value > 0").groupBy("query").agg(F.count("*").alias("n"), F.min("value").alias("least")).collect()
    threshold = np.ones(len(texts))
    for row in scored:
        if row["n"] >= k:
            threshold[row["query"]] = row["least"]
    return scratch.write(_top(_descend(index, queries, k, threshold), k), "best")


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = 20, block: int = 256, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", query_column: str = "text"
) -> DataFrame:
    """The k documents of the highest scores above 0 for each item, all of them if fewer.

    Bounds hold for every document, so no document that belongs to the result is passed
    over. The index is built once; items are searched in blocks of ``block``. Within a task
    memory holds one slice of documents, the block's terms and k rows for a query.

    A missing or empty text has no term: as a document it is not found and does not count,
    as an item it has no result. Equal scores go by ascending id, missing ids last, then in
    the order of rows. Rows that repeat an id or text are documents, or items, of their own.
    A very long text has a sketch of its own size and is scored whole. Without documents or
    items the result is empty. Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    send_package(spark)
    scratch = Scratch(spark, "search")
    kind = items.schema[item_column].dataType.simpleString()
    index = None
    results = []
    for rows in _blocks(items.select(F.col(item_column).alias("item"), F.col(query_column).alias("text")), block):
        index = index if index is not None else build_index(docs, scratch, id_column, text_column)
        found = search_block(index, [r["text"] for r in rows], scratch, k)
        # one row for each item of the block
        names = spark.createDataFrame(pd.DataFrame({"query": np.arange(len(rows), dtype=np.int32), "item": pd.Series([r["item"] for r in rows], dtype=object)}), f"query int, item {kind}")
        results.append(found.join(F.broadcast(names), "query"))
    if not results:
        return spark.createDataFrame([], f"`{item_column}` {kind}, rank int, `{id_column}` long, score long")
    every = results[0]
    for more in results[1:]:
        every = every.unionByName(more)
    return every.select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), F.col("value").alias("score"))


#: The same by joins of all words (DuckDB).
RANKED_SQL = """
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM lengths),
held AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, totals GROUP BY term, docs),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9a-z\\x{80}-\\x{10FFFF}]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (doc_id), totals
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
