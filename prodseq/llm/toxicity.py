"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.llm.language import held_out
from prodseq.llm.shipping import send_package

#: Slots that terms are hashed to.
SLOTS = 1 << 18


@dataclass
class Machine:
    """A weight and a row of factors for every slot, and the bias.

    The score of a set of slots is the bias, their weights and, for every pair, the
    product of their factor rows; a logistic curve makes it a chance.
    """

    weights: np.ndarray
    factors: np.ndarray
    bias: float

    def logits(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Scores of many feature lists laid end to end."""
        owner = np.repeat(np.arange(len(lengths)), lengths)
        return self.bias + _raised(self.weights[features], self.factors[features], owner, len(lengths))[0]


def _raised(weights: np.ndarray, factors: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """What the features of each owner add to its score, and the sums of their factors."""
    sums = np.stack([np.bincount(owner, weights=v, minlength=n) for v in factors.T], axis=1)
    own = np.bincount(owner, weights=weights - 0.5 * (factors * factors).sum(axis=1), minlength=n)
    return own + 0.5 * (sums * sums).sum(axis=1), sums


def train(
    features: np.ndarray, lengths: np.ndarray, labels: np.ndarray, n_features: int, place: np.ndarray | None = None, factors: int = 4, rounds: int = 24, batch: int = 256,
    rate: float = 0.5, pressure: float = 0.8, shrink: float = 2.0, start_size: float = 0.2, decay: float = 1e-4, seed: int = 5,
) -> Machine:
    """Fit every feature's weight and factors, and the bias, on the mean logistic loss.

    Weights follow the regularised leader: a weight leaves zero once the mean gradient exceeds
    ``pressure`` times what chance would give a feature that is seen as often. After four
    tenths of the rounds those that left are no longer held back. A row of factors shrinks by
    ``shrink`` times the gradient that chance would give it; it needs no weight of its own.
    Rows are seen in as many rounds at every size. Each step sees a random three quarters of
    the features, so that each of them has to count alone as well as with the others.
    """
    random = np.random.default_rng(seed)
    n = len(labels)
    share = np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    used = np.bincount(features, minlength=n_features) if n else np.zeros(n_features)
    weights, bias = np.zeros(n_features), float(np.log(share / (1 - share)))
    # longer texts hold more pairs, so that their sum starts alike
    small = start_size / np.sqrt(factors * max(1.0, len(features) / max(n, 1)))
    rows = random.standard_normal((n_features, factors)) * small * (used > 0)[:, None]
    chance = pressure * (np.sqrt(used * share * (1 - share)) + 1) / max(n, 1)
    pulled, squares, row_squares, bias_squares = np.zeros(n_features), np.zeros(n_features), np.full(n_features, 1e-8), 1.0
    held, kept_back, step = np.ones(n_features, bool), 0, 0
    starts = np.concatenate([[0], np.cumsum(lengths)])

    def leader(u: np.ndarray) -> np.ndarray:
        over = np.abs(pulled[u]) - chance[u] * np.where(held[u], step, kept_back)
        return np.where(over > 0, -np.sign(pulled[u]) * over / (np.sqrt(squares[u]) / rate + 0.1), 0)

    for number in range(rounds if n else 0):
        if number == rounds * 4 // 10:
            kept_back = step
            held = np.abs(pulled) <= chance * step
        order = random.permutation(n)
        for start in range(0, n, batch):
            picked = order[start : start + batch]
            owner = np.repeat(np.arange(len(picked)), lengths[picked])
            flat = np.concatenate([features[starts[i] : starts[i + 1]] for i in picked])
            seen = random.random(len(flat)) < 0.75
            owner = owner[seen]
            u, at = np.unique(flat[seen], return_inverse=True)
            step += 1
            w, v = leader(u), rows[u]
            added, sums = _raised(w[at], v[at], owner, len(picked))
            error = (1 / (1 + np.exp(-np.clip(bias + added, -30, 30))) - labels[picked]) / len(picked)
            by_place = error[owner]
            d_w = np.bincount(at, weights=by_place, minlength=len(u))
            d_v = np.stack([np.bincount(at, weights=by_place * s[owner], minlength=len(u)) for s in sums.T], axis=1) - d_w[:, None] * v + decay * v
            more = squares[u] + d_w**2
            pulled[u] += d_w - (np.sqrt(more) - np.sqrt(squares[u])) / rate * w
            squares[u] = more
            row_squares[u] += (d_v**2).sum(axis=1)
            pace = 0.6 * small / np.sqrt(row_squares[u])
            v = v - pace[:, None] * d_v
            size = np.maximum(np.sqrt((v * v).sum(axis=1)), 1e-12)
            around = np.sqrt((sums * sums).sum(axis=1).mean())
            rows[u] = v * np.maximum(0, 1 - shrink * chance[u] * around * pace / size)[:, None]
            bias_squares += error.sum() ** 2
            bias -= 0.1 * float(error.sum()) / np.sqrt(bias_squares)
    weights = leader(np.arange(n_features))
    return Machine(weights, rows, bias)


def terms(text: Column) -> Column:
    """Distinct slots of a text's lower-cased runs of letters and digits."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(SLOTS)).cast("int")))


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = 20_000, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic") -> Machine:
    """Fit a weight and factors for every slot on up to about ``most_rows`` labelled rows.

    The fit takes rows by a hash of their id: the bound is on this sample only, and no term
    of a sampled row is left out. Labels that disagree count as toxic; rows without label or
    id are not used; rows that repeat an id each count, in the order of their texts. Without any labelled row every score is one half.
    """
    send_package(docs.sparkSession)
    marked = labels.filter(~held_out(id_column)).groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label_column).cast("int")).alias("toxic")).filter("toxic IS NOT NULL")
    texts = docs.filter(~held_out(id_column)).select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    # labels grow with the documents, so both sides are shuffled at every size
    n = texts.select("id").join(marked.hint("merge"), "id").count()
    million = 1_000_000
    share = min(million, million * most_rows // max(1, n) + 1)
    sampled = lambda rows: rows.filter(F.pmod(F.xxhash64("id"), F.lit(million)) < share)
    joined = sampled(texts).join(sampled(marked).hint("merge"), "id")
    sample = joined.select("id", "toxic", F.sha2("text", 256).alias("order"), terms(F.col("text")).alias("terms")).toArrow()
    sample = sample.sort_by([("id", "ascending"), ("order", "ascending")])
    lists = sample["terms"].combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return train(lists.flatten().to_numpy(), lengths, sample["toxic"].to_numpy().astype(float), SLOTS)


def _short(batches: Iterator[pa.RecordBatch], rows: int = 512, slots: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of up to so many rows and slots; a row with more stands alone."""
    for batch in batches:
        ends = np.cumsum(batch.column("terms").value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = min(start + rows, max(start + 1, int(np.searchsorted(ends, before + slots, side="right"))))
            yield batch.slice(start, end - start)
            start = end


def score(docs: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Chance of being toxic for each document row, over the whole text.

    A missing or empty text has no terms and gets the chance of the bias alone. Rows are
    judged each by themselves, also with missing or repeated ids; other columns are not read.
    The machine is as large as its slots, whatever the data.
    """
    send_package(docs.sparkSession)
    sets = docs.select(F.col(id_column).alias("id"), terms(F.col(text_column)).alias("terms"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _short(batches):
            column = batch.column("terms")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            chance = 1 / (1 + np.exp(-machine.logits(column.flatten().to_numpy(), lengths)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(chance), pa.array((chance >= 0.5).astype(np.int32))], names=["id", "score", "predicted"])

    made = sets.mapInArrow(run, f"id {sets.schema['id'].dataType.simpleString()}, score double, predicted int")
    return made.select(F.col("id").alias(id_column), held_out("id").alias("held_out"), "score", "predicted")
