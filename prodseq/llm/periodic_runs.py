"""Stretches of words that repeat with a period, found by block convolution.

At each dyadic scale B the words are cut into aligned blocks of B. A run of period q in
[B, 2B) that holds three periods holds a whole block whose copy stands q words further. The
squared differences of a block's word numbers to every position of the window after it come
from one number-theoretic transform; where their sum is zero the block occurs again. Each
such distance seeds an extension to both sides. Scale 8 also takes the periods below 8,
since a run has 24 words at least.

Sums are exact modulo a prime, so no occurrence is missed; a run is compared word by word
before it is returned.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.llm.batches import over_texts, texts_of
from prodseq.llm.shingles import _powers_to, mixed

#: Fixed: prime with roots of unity of every order up to 2^23, and a root of its group.
PRIME, ROOT = 998244353, 3
_P = np.uint64(PRIME)

#: Smallest scale, and the least length a run may be asked to have at it.
FIRST_SCALE, LEAST_WORDS = 8, 24
#: Numbers transformed at once.
CHUNK = 1 << 19


@lru_cache(maxsize=None)
def _roots(size: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``."""
    root = pow(ROOT, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    powers = np.ones(max(1, size // 2), np.uint64)
    step = 1
    while step < len(powers):
        powers[step : 2 * step] = powers[:step] * np.uint64(pow(root, step, PRIME)) % _P
        step *= 2
    return powers


def transform(rows: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order."""
    n, size = rows.shape
    half = size // 2
    while half:
        parts = rows.reshape(n, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1]
        rows = np.stack([(low + high) % _P, (low + _P - high) * _roots(2 * half, False) % _P], axis=2)
        half //= 2
    return rows.reshape(n, size)


def inverse_transform(rows: np.ndarray) -> np.ndarray:
    """The rows whose transforms, in bit-reversed order, are given."""
    n, size = rows.shape
    half = 1
    while half < size:
        parts = rows.reshape(n, -1, 2, half)
        low, high = parts[:, :, 0], parts[:, :, 1] * _roots(2 * half, True) % _P
        rows = np.stack([(low + high) % _P, (low + _P - high) % _P], axis=2)
        half *= 2
    return rows.reshape(n, size) * np.uint64(pow(size, -1, PRIME)) % _P


def occurrences(numbers: np.ndarray, blocks: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, distance) of every occurrence of the blocks that start at ``blocks`` in the window after each.

    Distances are those of the scale: below twice its length, and not below its length
    except at the smallest scale. ``numbers`` are positive and less than the prime.
    """
    first = 1 if scale == FIRST_SCALE else scale
    lags = 2 * scale - first
    size = 1 << (scale + lags - 2).bit_length()
    padded = np.concatenate([numbers, np.zeros(first + size, np.int64)]).astype(np.uint64)
    squares = np.concatenate([[np.uint64(0)], np.cumsum(padded * padded % _P)])
    back = -np.arange(scale) % size
    starts, distances = [], []
    for at in range(0, len(blocks), max(1, CHUNK // size)):
        some = blocks[at : at + max(1, CHUNK // size)]
        pattern = np.zeros((len(some), size), np.uint64)
        pattern[:, back] = padded[some[:, None] + np.arange(scale)]
        window = padded[some[:, None] + first + np.arange(size)]
        product = inverse_transform(transform(pattern) * transform(window) % _P)[:, :lags]
        moved = some[:, None] + first + np.arange(lags)
        own = squares[some + scale] - squares[some]
        there = squares[moved + scale] - squares[moved]
        differ = (own[:, None] + there + np.uint64(2) * (_P - product)) % _P
        row, lag = np.nonzero(differ == 0)
        starts.append(some[row])
        distances.append(lag + first)
    return tuple(np.concatenate([*x, np.zeros(0, np.int64)]) for x in (starts, distances))


class _Stretches:
    """How far two places of a sequence agree, by sums of hashes and halving."""

    def __init__(self, numbers: np.ndarray):
        self.numbers, self.n = numbers, len(numbers)
        power, self.inverse = _powers_to(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(mixed(numbers.astype(np.uint64)) * power[: self.n], out=self.sums[1:])

    def _same(self, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> np.ndarray:
        one = (self.sums[x + length] - self.sums[x]) * self.inverse[x]
        return one == (self.sums[y + length] - self.sums[y]) * self.inverse[y]

    def around(self, start: np.ndarray, end: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The widest stretch around [start, end) whose words equal those ``distance`` further."""
        right = _halved(self.n - end - distance, lambda m: self._same(end, end + distance, m))
        left = _halved(start.copy(), lambda m: self._same(start - m, start + distance - m, m))
        return start - left, end + right

    def checked(self, start: int, end: int, distance: int) -> tuple[int, int]:
        """The same stretch, compared word by word; ``end`` counts the last period."""
        x = self.numbers
        same = bool((x[start : end - distance] == x[start + distance : end]).all())
        before = start == 0 or x[start - 1] != x[start - 1 + distance]
        after = end == self.n or x[end - distance] != x[end]
        if same and before and after:
            return start, end
        # two sums agreed by chance: look for the words that differ
        bad = np.flatnonzero(x[:-distance] != x[distance:])
        middle = (start + end - distance) // 2
        at = int(np.searchsorted(bad, middle))
        return (int(bad[at - 1]) + 1 if at else 0), (int(bad[at]) if at < len(bad) else self.n - distance) + distance


def _halved(most: np.ndarray, holds) -> np.ndarray:
    """The largest numbers up to ``most`` for which ``holds`` is true; it is true for 0 and up to one point."""
    low, high = np.zeros_like(most), most
    while (low < high).any():
        middle = (low + high + 1) // 2
        good = holds(middle)
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return low


def _gaps(numbers: np.ndarray) -> np.ndarray:
    """Words until the same word comes again."""
    order = np.argsort(numbers, kind="stable")
    gap = np.full(len(numbers), 2 * len(numbers) + 1)
    same = numbers[order[1:]] == numbers[order[:-1]]
    gap[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gap


def find_runs(numbers: np.ndarray, longest: int, least: int = LEAST_WORDS) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least three periods and ``least`` words, by start and period.

    ``numbers`` may hold many texts end to end, of up to ``longest`` words, if they share no
    number. A block that holds a word which does not come again within the window cannot
    occur there and is not transformed. A seed inside a run of a smaller scale has a
    multiple of that run's period, so it is the same run.
    """
    if longest < least:
        return []
    gap, stretches = _gaps(numbers), _Stretches(numbers)
    found: dict[tuple[int, int], int] = {}
    scale = FIRST_SCALE
    while 3 * scale <= max(longest, least):
        count = len(numbers) // scale
        again = (gap[: count * scale] < 2 * scale).reshape(count, scale).all(axis=1)
        start, distance = occurrences(numbers, np.flatnonzero(again) * scale, scale)
        if found and len(start):
            spans = np.array(sorted(found))
            reach = np.maximum.accumulate(spans[:, 1])
            at = np.searchsorted(spans[:, 0], start, side="right") - 1
            known = (at >= 0) & (reach[np.maximum(at, 0)] >= start + scale + distance)
            start, distance = start[~known], distance[~known]
        # neighbouring blocks at one distance belong to one stretch
        order = np.lexsort((start, distance))
        start, distance = start[order], distance[order]
        if len(start):
            fresh = np.concatenate([[True], (np.diff(start) != scale) | (np.diff(distance) != 0)])
            start, distance = start[fresh], distance[fresh]
        first, last = stretches.around(start, start + scale, distance)
        good = last + distance - first >= np.maximum(least, 3 * distance)
        candidates = np.unique(np.stack([first, last + distance, distance], axis=1)[good], axis=0)
        for a, b, d in candidates.tolist():
            a, b = stretches.checked(a, b, d)
            if b - a >= max(least, 3 * d):
                found[a, b] = min(d, found.get((a, b), d))
        scale *= 2
    return sorted((a, b - a, d) for (a, b), d in found.items())


def _read(batch: pa.RecordBatch, least: int) -> dict:
    """Runs and the collapsed text of each text of a batch; all texts are searched as one sequence."""
    words = [t.encode().split() for t in texts_of(batch)]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    numbers, base = [], 1
    for w in words:
        place = {word: base + i for i, word in enumerate(dict.fromkeys(w))}
        numbers.append(list(map(place.__getitem__, w)))
        base += len(place)
    flat = np.fromiter(chain.from_iterable(numbers), np.int64, int(sizes.sum()))
    runs: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for start, length, period in find_runs(flat, int(sizes.max(initial=0)), least):
        owner = int(np.searchsorted(starts, start, side="right")) - 1
        runs[owner].append((start - int(starts[owner]), length, period))
    collapsed = []
    for w, some in zip(words, runs, strict=True):
        if some:
            edge = np.zeros(len(w) + 1, np.int64)
            for start, length, period in some:
                edge[start + period] += 1
                edge[start + length] -= 1
            w = [w[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
        collapsed.append(b" ".join(w).decode())
    shape = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
    told = [[{"start": a, "length": n, "period": d} for a, n, d in some] for some in runs]
    return {"n_words": pa.array(sizes), "runs": pa.array(told, shape), "collapsed": pa.array(collapsed)}


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed): runs as (start, length, period) by start and period, and the text
    without the words that repeat what stands a period before them, joined by single spaces.

    Words are runs of bytes other than space and bytes 9 to 13. A run is as long as its
    smallest period holds, has ``least`` words (24 or more) and three periods. A missing or
    empty text has no word and no run; its collapsed text is empty. Rows are searched each
    by themselves, also with missing or repeated ids. A very long text is searched whole, in
    one task, with memory in proportion to its words. Other columns are not read; an empty
    table gives an empty result.
    """
    if least < LEAST_WORDS:
        raise ValueError(f"runs of fewer than {LEAST_WORDS} words are not found")
    frame = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    shape = "n_words long, runs array<struct<start:long, length:long, period:long>>, collapsed string"
    return over_texts(frame, [id_column, "text"], lambda batch: _read(batch, least), shape)


def with_planted_period(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, text) where one document in ten repeats a part of itself from some word on.

    With h the crc32 of the id as text and g = h div 10, a document with h mod 10 = 0 and n
    words repeats the p words from word a on, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    A row without id or words stays as it is.
    """
    text = F.col(text_column)
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    g, n = F.floor(h / 10), F.size("_words").cast("long")
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))

    def word(i: Column) -> Column:
        place = F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
        return F.get("_words", place.cast("int"))

    chosen = docs.select(F.col(id_column), text.alias("text"), F.when(h % 10 == 0, words).alias("_words"))
    filled = F.when(n > 0, F.struct(a.alias("a"), p.alias("p")))
    numbered = chosen.withColumn("_plan", filled).select("*", F.col("_plan.a").alias("_a"), F.col("_plan.p").alias("_p"))
    planted = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.size("_words").cast("long") - 1), word), " ")
    return numbered.select(id_column, F.when(F.col("_plan").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def run_digest(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Counts, the run of the greatest exponent and digests, from ``periodic_runs`` over planted documents.

    Of equal exponents the smallest start, then period, is taken; a document without runs
    has four missing values there.
    """
    found = periodic_runs(with_planted_period(docs, id_column, text_column), id_column=id_column)
    best = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda x, y: F.when(y["length"] * x["period"] > x["length"] * y["period"], y).otherwise(x),
    )
    told = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    made = found.select(id_column, "collapsed", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"), told.alias("told"))
    return made.select(
        id_column, "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.col("told").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
