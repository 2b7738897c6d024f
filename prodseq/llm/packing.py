"""Packing of token sequences into windows by non-negative least squares over a histogram."""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prodseq.llm.batches import over_texts, texts_of
from prodseq.llm.scratch import Scratch, met
from prodseq.llm.token_counts import _byte_letters

#: White space in a row from which a text goes to the library that names the vocabulary: the
#: faster one gives up on about a million.
LONG_BLANKS = 100_000

#: Fixed: how the byte-level vocabulary cuts a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def byte_encoder(path: str):
    """An encoder with the vocabulary of a byte-level BPE file, and its special strings."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    special = {t["content"]: t["id"] for t in whole["added_tokens"]}
    byte_of = {letter: b for b, letter in enumerate(_byte_letters())}
    ranks = {bytes(byte_of[x] for x in piece): i for piece, i in whole["model"]["vocab"].items() if piece not in special}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special), tuple(special)


@lru_cache(maxsize=2)
def _named_encoder(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _has_long_blanks(text: str) -> bool:
    return len(text) >= LONG_BLANKS and re.search(r"\s{%d}" % LONG_BLANKS, text) is not None


def token_ids(text: str, path: str) -> list[int]:
    """Ids of a text without begin or end, its special strings as special tokens."""
    if _has_long_blanks(text):
        return _named_encoder(path).encode(text, add_special_tokens=False).ids
    encoder, special = byte_encoder(path)
    return encoder.encode(text, allowed_special="all") if any(s in text for s in special) else encoder.encode_ordinary(text)


def tokenize(frame: DataFrame, path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, id, n_tokens, ids): ids as little-endian 16-bit numbers with ``end_id`` at the end."""

    def run(batch: pa.RecordBatch) -> dict:
        raw = [np.array([*token_ids(text, path), end_id], "<u2").tobytes() for text in texts_of(batch, text_column)]
        return {"n_tokens": np.array([len(r) // 2 for r in raw], np.int64), "ids": pa.array(raw, pa.binary())}

    numbered = frame.select(F.monotonically_increasing_id().alias("row"), F.col(id_column), F.col(text_column))
    return over_texts(numbered, ["row", id_column, text_column], run, "n_tokens long, ids binary")


@dataclass(frozen=True)
class Plan:
    """Where the n-th rest of a length goes.

    ``keys`` are length and first rank of an interval in one number, ascending; ranks of
    the interval go to sequences from ``sequences`` on, at ``offsets``. Ranks from
    ``used[length]`` on are laid end to end from token ``laid[length]`` of a stream of
    residuals, which is cut at window borders into sequences from ``stream`` on.
    """

    keys: np.ndarray
    sequences: np.ndarray
    offsets: np.ndarray
    used: np.ndarray
    laid: np.ndarray
    stream: int
    total: int


RANK_BITS = 44


def combinations(histogram: np.ndarray, window: int) -> np.ndarray:
    """Rows of up to three lengths that fill a window exactly: every pair and triple of lengths that occur.

    A row is ascending from the left, with 0 in front of a pair. There are about a twelfth
    of the square of ``window`` at most.
    """
    held = np.zeros(window + 1, bool)
    held[1:window] = histogram[1:window] > 0
    present = np.flatnonzero(held)
    found = [np.zeros((0, 3), np.int64)]
    for least in [0, *present[present <= window // 3].tolist()]:
        middle = present[(present >= least) & (2 * present <= window - least)]
        middle = middle[held[window - least - middle]]
        found.append(np.stack([np.full(len(middle), least), middle, window - least - middle], axis=1))
    return np.concatenate(found)


def fit(combos: np.ndarray, histogram: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that minimise the squared distance of the lengths used to the histogram.

    Accelerated projected gradient descent on the sparse incidence of lengths.
    """
    if not len(combos):
        return np.zeros(0)
    mask = combos > 0
    target = histogram.astype(float).copy()
    target[0] = 0
    use = lambda x: np.bincount(combos[mask], weights=np.repeat(x, mask.sum(axis=1)), minlength=len(target))
    back = lambda r: (r[combos] * mask).sum(axis=1)
    probe = np.ones(len(combos))
    for _ in range(20):
        probe = back(use(probe))
        probe /= np.linalg.norm(probe)
    step = 1 / (1.1 * np.linalg.norm(back(use(probe))))
    x = previous = np.zeros(len(combos))
    momentum = 1.0
    for _ in range(rounds):
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = x + (momentum - 1) / following * (x - previous)
        previous, momentum = x, following
        x = np.maximum(0, ahead - step * back(use(ahead) - target))
    return x


def _repeats(combos: np.ndarray, wanted: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whole repeat counts: the wanted ones rounded down, then as many more as lengths are left for.

    Combinations go by their wanted count, largest first. ``left`` is changed to what remains.
    """
    repeats = np.zeros(len(combos), np.int64)
    order = np.argsort(-wanted, kind="stable")
    for greedy in (False, True):
        for start in range(0, len(order), 4096):
            some = order[start : start + 4096]
            if not greedy:
                some = some[wanted[some] >= 1]
            # most rows of a block have run out of some length
            some = some[((left[combos[some]] > 0) | (combos[some] == 0)).all(axis=1)]
            for c, row in zip(some.tolist(), combos[some].tolist(), strict=True):
                times = Counter(x for x in row if x)
                n = min(int(left[x]) // k for x, k in times.items())
                n = n if greedy else min(n, int(wanted[c]))
                if n > 0:
                    repeats[c] += n
                    for x, k in times.items():
                        left[x] -= n * k
    return repeats


def make_plan(histogram: np.ndarray, window: int) -> Plan:
    """Fit, round down, fill up greedily, and lay what is left end to end. Works on counts only."""
    histogram = histogram.astype(np.int64)
    left = histogram.copy()
    left[0] = 0
    combos = combinations(histogram, window)
    repeats = _repeats(combos, fit(combos, histogram), left)
    used = np.zeros(window, np.int64)
    rows, sequence = [], 0
    for c in np.flatnonzero(repeats).tolist():
        offset = 0
        for length in combos[c][combos[c] > 0].tolist():
            rows.append(((length << RANK_BITS) + int(used[length]), sequence, offset))
            used[length] += repeats[c]
            offset += length
        sequence += int(repeats[c])
    rows.sort()
    tokens = left[:window] * np.arange(window)
    laid = np.cumsum(tokens) - tokens
    keys, sequences, offsets = (np.array(x, np.int64) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
    return Plan(keys, sequences, offsets, used, laid, sequence, sequence + -(-int(tokens.sum()) // window))


def _pieces(plan: Plan, window: int, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Pieces of the documents of a batch: full windows, then the rest at its planned place."""
    tokens = batch.column("n_tokens").to_numpy()
    rank, before = batch.column("rank").to_numpy(), batch.column("before").to_numpy()
    whole, rest = tokens // window, tokens % window
    index = np.repeat(np.arange(len(tokens)), whole)
    turn = np.arange(len(index)) - np.repeat(np.cumsum(whole) - whole, whole)
    zeros = np.zeros(len(index), np.int64)
    parts = [(index, turn * window, zeros + window, plan.total + before[index] + turn, zeros)]
    fitted = np.flatnonzero((rest > 0) & (rank < plan.used[rest]))
    if len(fitted):
        at = np.searchsorted(plan.keys, (rest[fitted] << RANK_BITS) + rank[fitted], side="right") - 1
        first = plan.keys[at] & ((1 << RANK_BITS) - 1)
        parts.append((fitted, (whole * window)[fitted], rest[fitted], plan.sequences[at] + rank[fitted] - first, plan.offsets[at]))
    loose = np.flatnonzero((rest > 0) & (rank >= plan.used[rest]))
    if len(loose):
        place = plan.laid[rest[loose]] + (rank[loose] - plan.used[rest[loose]]) * rest[loose]
        offset, start = place % window, (whole * window)[loose]
        here = np.minimum(rest[loose], window - offset)
        parts.append((loose, start, here, plan.stream + place // window, offset))
        cut = here < rest[loose]
        parts.append((loose[cut], (start + here)[cut], (rest[loose] - here)[cut], (plan.stream + place // window + 1)[cut], np.zeros(int(cut.sum()), np.int64)))
    index, start, length, sequence, offset = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))
    ids = [np.frombuffer(x, "<u2") for x in batch.column("ids").to_pylist()]
    crc = [zlib.crc32(ids[i][a : a + n].astype("<u4").tobytes()) for i, a, n in zip(index.tolist(), start.tolist(), length.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [batch.column("id").take(pa.array(index)), *map(pa.array, (start, length)), pa.array(crc, pa.int64()), *map(pa.array, (tokens[index], sequence, offset))],
        names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens, one row per piece.

    Whole windows of a document are sequences of their own. For the rests one histogram of
    lengths is counted over all documents; the fit on it gives how often each combination
    of lengths is used, and what rounding leaves is cut to fill windows end to end, so at
    most one sequence is short. A rest finds its place by its number among the rests of
    its length; rests of one length are numbered in salted groups, so that a frequent
    length is split over tasks. Sequence ids count up from 0.

    A missing or empty text is a document of the end id alone; a very long one, also of
    nothing but blanks, is encoded whole in its task. Rows with missing or repeated
    ids are packed each; an empty table gives no pieces. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    ids = scratch.write(tokenize(docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")), path, end_id, "id"), "ids")
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    small = ids.select("row", (F.col("n_tokens") % window).alias("rest"), F.floor(F.col("n_tokens") / window).alias("whole"), F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt"))
    groups = small.groupBy("rest", "salt").agg(F.count("*").alias("n"), F.sum("whole").alias("whole"))
    # at most `window` rows: the histogram, and the full windows of the documents of each length
    totals = groups.groupBy("rest").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole")).toPandas().sort_values("rest")
    histogram, full = np.zeros(window, np.int64), np.zeros(window, np.int64)
    histogram[totals["rest"]], full[totals["rest"]] = totals["n"], totals["whole"]
    plan = make_plan(histogram, window)
    first_full = F.array(*(F.lit(int(x)) for x in np.cumsum(full) - full))
    earlier = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.select(
        "rest", "salt",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        (F.coalesce(F.sum("whole").over(earlier), F.lit(0)) + F.element_at(first_full, (F.col("rest") + 1).cast("int"))).alias("whole_before"),
    )
    within = Window.partitionBy("rest", "salt").orderBy("row")
    numbered = small.select(
        "row", "rest", "salt",
        (F.row_number().over(within) - 1).alias("n_here"),
        (F.sum("whole").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("whole")).alias("whole_here"),
    )
    ranked = numbered.join(met(offsets), ["rest", "salt"]).select(
        "row", (F.col("n_before") + F.col("n_here")).alias("rank"), (F.col("whole_before") + F.col("whole_here")).alias("before")
    )
    placed = ids.join(met(ranked), "row").select("id", "n_tokens", "ids", "rank", "before")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                yield _pieces(plan, window, batch.slice(start, 1024))

    kind = ids.schema["id"].dataType.simpleString()
    made = placed.mapInArrow(run, f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return made.withColumnRenamed("id", id_column)
