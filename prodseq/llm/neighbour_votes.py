"""Quality by votes of the nearest labelled documents in a latent-semantic space.

A text is three groups of counts: its words, the shapes of its words (letter case, digits
and marks), and how much of it is said again. Slots of a group are hashed; the groups are
scaled to one length each and laid side by side. The strongest directions of the labelled
sample's matrix make the latent space. Every document is compared with all labelled vectors
in blocks, and its nearest ones vote by similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.llm.batches import over_texts, sliced, texts_of
from prodseq.llm.shingles import hashes_of_runs, mixed
from prodseq.llm.shipping import send_package

#: Slots of words and of shapes, and counts of repeated and fresh words, phrases and lines.
WORD_SLOTS, SHAPE_SLOTS, ECHOES = 1 << 15, 1 << 12, 6
SLOTS = WORD_SLOTS + SHAPE_SLOTS + ECHOES
#: Weight of each group.
WORDS, SHAPES, REPEATS = 0.6, 1.0, 0.6
#: Documents compared with all labelled ones at once.
BLOCK = 256

_SHAPE_BYTES = bytes(97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


def _shape(raw: bytes) -> bytes:
    """Letters, capitals and digits as one mark each; equal neighbours count once."""
    marks = np.frombuffer(raw.translate(_SHAPE_BYTES), np.uint8)
    return marks[np.concatenate([[True], marks[1:] != marks[:-1]])].tobytes() if len(marks) else b""


def _slots(hashes: np.ndarray, slots: int, first: int, weight: float) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.unique((hashes >> np.uint64(40)).astype(np.int64) % slots, return_counts=True)
    value = 1 + np.log(n)
    return at + first, value * (weight / np.sqrt((value * value).sum())) if len(value) else value


def _echoes(words: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeated and fresh neighbours, phrases of three words, and lines, each pair as shares."""
    phrases = mixed(words[:-2] + mixed(words[1:-1] + mixed(words[2:]))) if len(words) > 2 else words[:0]
    same = int((words[1:] == words[:-1]).sum())
    counts = [same, max(0, len(words) - 1 - same)]
    for many in (phrases, lines):
        fresh = len(np.unique(many))
        counts += [len(many) - fresh, fresh]
    pairs = np.sqrt(np.array(counts, float).reshape(3, 2))
    size = np.maximum(np.sqrt((pairs * pairs).sum(axis=1, keepdims=True)), 1e-12)
    return np.arange(ECHOES) + WORD_SLOTS + SHAPE_SLOTS, (REPEATS / np.sqrt(3) * pairs / size).ravel()


def vectors(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and values of all texts end to end, and how many each text has; a text without words has none."""
    raw = [t.encode() for t in texts]
    groups = [hashes_of_runs(x) for x in ([r.lower() for r in raw], [_shape(r) for r in raw], [r.replace(b" ", b"\0").replace(b"\t", b"\0") for r in raw])]
    slots, values, lengths, at = [], [], [], [0, 0, 0]
    for i in range(len(raw)):
        words, shapes, lines = (h[a : a + n[i]] for (h, n), a in zip(groups, at, strict=True))
        at = [a + n[i] for (_, n), a in zip(groups, at, strict=True)]
        parts = [_slots(words, WORD_SLOTS, 0, WORDS), _slots(shapes, SHAPE_SLOTS, WORD_SLOTS, SHAPES), _echoes(words, lines)] if len(words) else []
        slots += [p[0] for p in parts]
        values += [p[1] for p in parts]
        lengths.append(sum(len(p[0]) for p in parts))
    return np.concatenate([*slots, np.zeros(0, np.int64)]), np.concatenate([*values, np.zeros(0)]), np.array(lengths, np.int64)


def _projected(slots: np.ndarray, values: np.ndarray, lengths: np.ndarray, directions: np.ndarray, most: int = 1 << 16) -> np.ndarray:
    """The sparse rows times ``directions``, about ``most`` entries at a time."""
    out = np.zeros((len(lengths), directions.shape[1]), directions.dtype)
    ends = np.cumsum(lengths)
    start = 0
    while start < len(lengths):
        first = int(ends[start] - lengths[start])
        stop = max(start + 1, int(np.searchsorted(ends, first + most, side="right")))
        last, n = int(ends[stop - 1]), lengths[start:stop]
        held = n > 0
        if last > first:
            rows = directions[slots[first:last]] * values[first:last, None].astype(directions.dtype)
            out[start:stop][held] = np.add.reduceat(rows, (np.cumsum(n) - n)[held], axis=0)
        start = stop
    return out


def _back(slots: np.ndarray, values: np.ndarray, lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The transposed sparse rows times ``rows``."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    return np.stack([np.bincount(slots, weights=values * column[owner], minlength=SLOTS) for column in rows.T], axis=1)


def latent_directions(slots: np.ndarray, values: np.ndarray, lengths: np.ndarray, dimensions: int, rounds: int = 3, seed: int = 13) -> np.ndarray:
    """The strongest right singular directions of a sparse matrix, by a random start and repeated multiplication."""
    basis = np.random.default_rng(seed).standard_normal((SLOTS, dimensions + 8))
    for _ in range(rounds):
        left, _ = np.linalg.qr(_projected(slots, values, lengths, basis))
        basis, _ = np.linalg.qr(_back(slots, values, lengths, left))
    small = _projected(slots, values, lengths, basis)
    _, _, turn = np.linalg.svd(small, full_matrices=False)
    return basis @ turn[:dimensions].T


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-12)


@dataclass
class Voters:
    """Latent directions, the labelled vectors of length 1, their labels, and the share of label 1."""

    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float
    neighbours: int
    sharpness: float

    def votes(self, texts: list[str]) -> np.ndarray:
        """Share of label 1 among the nearest labelled documents of each text, weighted by similarity.

        The cosine to every labelled document is computed. A few votes of the overall share
        are added, so that a text without words, or with nothing alike, gets that share.
        """
        slots, values, lengths = vectors(texts)
        latent = _unit(_projected(slots, values, lengths, self.directions))
        out = np.full(len(texts), self.share)
        if not len(self.labels):
            return out
        k = min(self.neighbours, len(self.labels))
        for start in range(0, len(texts), BLOCK):
            cosine = latent[start : start + BLOCK] @ self.vectors.T
            nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, nearest, axis=1), 0).astype(float) ** self.sharpness
            out[start : start + BLOCK] = ((weight * self.labels[nearest]).sum(axis=1) + 0.25 * self.share) / (weight.sum(axis=1) + 0.25)
        return np.clip(out, 0, 1)


def held_out(id_column: str) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4; rows without id too."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def learn(
    docs: DataFrame, labels: DataFrame, most_rows: int = 8_000, dimensions: int = 64, neighbours: int = 15, sharpness: float = 4.0,
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality",
) -> Voters:
    """Latent space and voters from up to about ``most_rows`` labelled rows, taken by a hash of their id.

    The bound is on the sample of the classifier only; its rows are used with their whole
    texts and in a fixed order, also where ids repeat. Labels of one id that disagree count
    as 0; rows without label or id are not used. Without any labelled row every score is one half.
    """
    send_package(docs.sparkSession)
    marked = labels.filter(~held_out(id_column)).groupBy(F.col(id_column).alias("id")).agg(F.min(F.col(label_column).cast("int")).alias("label")).filter("label IS NOT NULL")
    texts = docs.filter(~held_out(id_column)).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # labels grow with the documents, so both sides are shuffled at every size
    n = texts.select("id").join(marked.hint("merge"), "id").count()
    million = 1_000_000
    share = min(million, million * most_rows // max(1, n) + 1)
    sampled = lambda rows: rows.filter(F.pmod(F.xxhash64("id"), F.lit(million)) < share)
    joined = sampled(texts).join(sampled(marked).hint("merge"), "id")

    def run(batch: pa.RecordBatch) -> dict:
        slots, values, lengths = vectors(texts_of(batch))
        ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
        return {"slots": pa.ListArray.from_arrays(ends, pa.array(slots.astype(np.int32))), "weights": pa.ListArray.from_arrays(ends, pa.array(values))}

    rows = over_texts(joined.withColumn("key", F.xxhash64("text")), ["id", "key", "label", "text"], run, "slots array<int>, weights array<double>").toArrow()
    rows = rows.sort_by([("id", "ascending"), ("key", "ascending")])
    slots = rows["slots"].combine_chunks()
    lengths = slots.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat, weights = slots.flatten().to_numpy().astype(np.int64), rows["weights"].combine_chunks().flatten().to_numpy()
    voting = rows["label"].to_numpy().astype(float)
    if not len(voting):
        return Voters(np.zeros((SLOTS, 1), np.float32), np.zeros((0, 1), np.float32), voting, 0.5, neighbours, sharpness)
    directions = latent_directions(flat, weights, lengths, dimensions).astype(np.float32)
    known = lengths > 0
    placed = _unit(_projected(flat, weights, lengths, directions))[known]
    return Voters(directions, placed, voting[known], float(voting.mean()), neighbours, sharpness)


def score(docs: DataFrame, voters: Voters, least: float = 0.7, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Votes for label 1 for each document row, over the whole text; predicted from ``least`` on.

    A missing text, or one without words, gets the overall share. Rows are judged each by
    themselves, also with missing or repeated ids; a very long text is one sparse row of at
    most as many slots as there are. Other columns are not read; an empty table gives an
    empty result. What goes to the tasks is bounded by the sample and the dimensions.
    """
    send_package(docs.sparkSession)
    frame = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            votes = voters.votes(texts_of(batch))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(votes), pa.array((votes >= least).astype(np.int32))], names=["id", "score", "predicted"])

    made = frame.mapInArrow(run, f"id {frame.schema['id'].dataType.simpleString()}, score double, predicted int")
    return made.select(F.col("id").alias(id_column), held_out("id").alias("held_out"), "score", "predicted")
