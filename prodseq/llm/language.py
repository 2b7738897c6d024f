"""Language identification by a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodseq.llm.batches import over_texts, sliced, texts_of

#: Letters of a piece that the network learns from.
PIECE = 64
#: Bytes in a window; windows of a text are run side by side, with states carried over their edges.
#: Most texts have one or two, so that few bytes are run for a guess or again.
WINDOW = 2048
#: Bytes beyond a window's edge from which the state carried into it is first guessed.
RUN_IN = 256
#: How far a carried state may be from the one that the neighbouring window ends in.
EDGE = 0.01
#: Units of each direction.
UNITS = 8
#: Windows that are worked on at once.
BLOCK = 1024
#: Positions of a block whose chances are taken at once.
SOME = 16
#: Bytes of all windows whose inputs are looked up at once.
LOOKED_UP = 2048
#: Text bytes worked on at once in a task: the longest row of windows that run again one after
#: another costs its time once for all texts of a slice.
SLICE_BYTES = 16 << 20

UNKNOWN = "und"


@dataclass
class Network:
    """Weights by direction (0 forward, 1 backward), features first.

    ``inputs`` (2, 3 units, 256) are the gates' input weights of each byte with their bias,
    ``states`` (2, 3 units, units) the recurrent ones, ``head`` (labels, 2 units) and
    ``bias`` (labels, 1) read a position's label from both states.
    """

    labels: list[str]
    inputs: np.ndarray
    states: np.ndarray
    head: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(labels: list[str], units: int = UNITS, seed: int = 7) -> Network:
        random = np.random.default_rng(seed)
        draw = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
        return Network(
            labels,
            draw(2, 3 * units, 256, scale=0.3),
            draw(2, 3 * units, units, scale=0.3),
            draw(len(labels), 2 * units, scale=0.3),
            np.zeros((len(labels), 1), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.inputs, self.states, self.head, self.bias]

    def walk(self, side: int, windows: np.ndarray, state: np.ndarray, left: np.ndarray | None = None, out: np.ndarray | None = None, kept: list | None = None) -> np.ndarray:
        """The state after all positions of a direction, from the given one (units, windows).

        ``left`` counts each window's valid positions; at others the state is zero, so that
        the backward direction starts at a text's end. States are written to ``out``.
        Gates are written with tanh: a gate is (1 + tanh) / 2, update first, then reset.
        """
        steps, units = len(windows), self.states.shape[2]
        least = steps if left is None else int(left.min(initial=steps))
        # the inputs of some positions are looked up at once, of more where windows are few
        some = max(1, LOOKED_UP // max(1, windows.shape[1]))
        for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
            at = t % some
            if at == (0 if side == 0 else some - 1) or t == steps - 1 and side == 1:
                looked_up = np.take(self.inputs[side], windows[t - at : t - at + some], axis=1, mode="clip")
            given = looked_up[:, at]
            carried = self.states[side] @ state
            gates = carried[: 2 * units]
            gates += given[: 2 * units]
            np.tanh(gates, out=gates)
            new = gates[units:] * carried[2 * units :]
            new += carried[2 * units :]
            new += given[2 * units :]
            np.tanh(new, out=new)
            move = state - new
            following = np.multiply(gates[:units], move, out=None if out is None else out[t])
            following += move
            following *= 0.5
            following += new
            if t >= least:
                following *= left > t
            if kept is not None:
                kept.append((t, state, carried[2 * units :], gates, new))
            state = following
        return state

    def run(self, windows: np.ndarray, keep: list | None = None, left: np.ndarray | None = None, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """States of all positions, (positions, 2 units, windows), for (positions, windows) bytes.

        Each direction begins with its ``starts`` (2, units, windows) or zero; the states it
        ends in are written to ``ends``. With ``keep`` the values the gradient needs are
        added to it, by direction.
        """
        steps, count = windows.shape
        units = self.states.shape[2]
        out = np.empty((steps, 2 * units, count), self.states.dtype)
        for side in range(2):
            kept: list | None = None if keep is None else []
            start = np.zeros((units, count), np.float32) if starts is None else starts[side]
            end = self.walk(side, windows, start, left, out[:, side * units : (side + 1) * units], kept)
            if ends is not None:
                ends[side] = end
            if keep is not None:
                keep.append(kept)
        return out

    def chances(self, states: np.ndarray) -> np.ndarray:
        """(positions, labels, windows): each position's chance of each label."""
        scores = np.matmul(self.head, states)
        scores += self.bias
        # label by label, since labels are few and positions many
        scores -= reduce(np.maximum, scores.swapaxes(0, 1))[:, None]
        np.exp(scores, out=scores)
        scores /= reduce(np.add, scores.swapaxes(0, 1))[:, None]
        return scores

    def gradient(self, windows: np.ndarray, weight: np.ndarray, label: np.ndarray, left: np.ndarray | None = None) -> list[np.ndarray]:
        """Gradient of the mean cross-entropy of all positions, by backpropagation through time."""
        units = self.states.shape[2]
        keep: list = []
        states = self.run(windows, keep, left)
        error = self.chances(states)
        error[:, label, np.arange(len(label))] -= 1
        error *= (weight / weight.sum())[:, None, :]
        head = np.einsum("tcb,tub->cu", error, states, optimize=True)
        bias = error.sum(axis=(0, 2))[:, None]
        into = np.matmul(self.head.T, error)
        inputs, recurrent = np.zeros_like(self.inputs), np.zeros_like(self.states)
        for side in range(2):
            back = np.zeros((units, windows.shape[1]), np.float32)
            pieces, order = [], []
            for t, state, candidate, gates, new in reversed(keep[side]):
                back = back + into[t, side * units : (side + 1) * units]
                if left is not None:
                    back *= left > t
                update, reset = (gates[:units] + 1) * 0.5, gates[units:] + 1
                d_new = back * (1 - update) * (1 - new * new)
                d_update = back * (state - new) * 0.5 * (1 - gates[:units] ** 2)
                d_reset = d_new * candidate * (1 - gates[units:] ** 2)
                d_carried = np.concatenate([d_update, d_reset, d_new * reset])
                recurrent[side] += d_carried @ state.T
                pieces.append(np.concatenate([d_update, d_reset, d_new]))
                order.append(windows[t])
                back = back * update + self.states[side].T @ d_carried
            flat, at = np.concatenate(pieces, axis=1), np.concatenate(order)
            for row in range(3 * units):
                inputs[side, row] = np.bincount(at, weights=flat[row], minlength=256)
        return [inputs, recurrent, head, bias]


def train(windows: np.ndarray, left: np.ndarray, label: np.ndarray, labels: list[str], rounds: int = 160, batch: int = 256, rate: float = 0.03, seed: int = 7) -> Network:
    """Fit a network to (windows, positions) bytes, ``left`` of each valid, by Adam steps on random batches."""
    weight = (np.arange(windows.shape[1])[None, :] < left[:, None]).astype(np.float32)
    network = Network.start(labels, seed=seed)
    random = np.random.default_rng(seed)
    first = [np.zeros_like(w) for w in network.weights()]
    second = [np.zeros_like(w) for w in network.weights()]
    for step in range(1, rounds + 1):
        chosen = random.integers(0, len(windows), min(batch, len(windows)))
        slow = rate * 0.5 * (1 + np.cos(np.pi * step / rounds))
        for w, g, m, v in zip(network.weights(), network.gradient(windows[chosen].T, weight[chosen].T, label[chosen], left[chosen]), first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= (slow * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return network


def cut(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts end to end as (windows, positions), valid positions, windows by text."""
    counts = np.array([-(-len(t) // window) for t in texts], np.int64)
    flat = np.frombuffer(b"".join(t.ljust(int(n) * window, b"\0") for t, n in zip(texts, counts, strict=True)), np.uint8)
    left = np.full(int(counts.sum()), window)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(counts)[counts > 0] - 1
    left[ends] = (sizes - (counts - 1) * window)[counts > 0]
    return flat.reshape(-1, window), left, counts


def _has_letter(text: str) -> bool:
    return re.search("[A-Za-z]", text) is not None or any(map(str.isalpha, text))


def held_out(id_column: str) -> Column:
    """Rows never learned from: crc32 of the id as text divides by 5; rows without id too."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", per_label: int = 500, parts: int = 4) -> Network | None:
    """Train on up to about ``per_label`` documents of each label, ``parts`` pieces of each.

    Pieces of 64 letters begin at places hashed from the id, over the whole text; all their bytes are used.
    The bound is on the training sample only: documents are taken by a hash of their id and text, at
    a rate set by the label's count over all documents, so that rare labels count as much. Equal rows
    count once; rows without id, without label or without a letter are not learned from.
    Returns None if there is no label to learn.
    """
    usable = docs.filter(~held_out(id_column)).filter(F.col(label_column).isNotNull() & F.col(text_column).rlike("\\p{L}"))
    usable = usable.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), F.col(label_column).alias("label"))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    if not counts:
        return None
    million = 1_000_000
    share = F.create_map(*(F.lit(x) for label, n in counts.items() for x in (label, min(million, million * per_label // n + 1))))
    spots = [F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(F.length("text") - PIECE + 1, F.lit(1))) + 1 for k in range(parts)]
    pieces = [F.col("text").substr(p.cast("int"), F.lit(PIECE)) for p in spots]
    sample = usable.filter(F.pmod(F.xxhash64("id", "text"), F.lit(million)) < share[F.col("label")]).select("id", "label", F.array(*pieces).alias("pieces")).distinct().toPandas()
    # in the order of id, label and pieces the fit does not depend on the order of rows
    sample = sample.assign(order=["\0".join(row) for row in sample["pieces"]]).sort_values(["id", "label", "order"])
    labels = sorted(counts)
    texts = [p.encode() for row in sample["pieces"] for p in row]
    windows, left, _ = cut(texts, max(map(len, texts), default=PIECE))
    label = np.repeat(np.searchsorted(labels, sample["label"]), parts)
    return train(windows, left, label, labels)


def text_chances(network: Network, windows: np.ndarray, left: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each window's sum of its positions' chances, as if every text were run in one piece.

    States carried into windows are first guessed from the bytes beyond their edge. Where a
    guess is more than ``EDGE`` from what the neighbour ends in, that direction of the window
    runs again from there: twice all such windows at once, then the outermost one of each text
    in turn, so that a direction that forgets nothing takes one more walk in all. The chances of
    these windows are then taken together.
    """
    n, units = len(windows), network.states.shape[2]
    owner = np.repeat(np.arange(len(counts)), counts)
    inner = np.flatnonzero(owner[1:] == owner[:-1])  # windows with a next one in their text
    into, source = [inner + 1, inner], [inner, inner + 1]
    starts, ends = np.zeros((2, units, n), np.float32), np.empty((2, units, n), np.float32)
    for at in range(0, len(inner), 4 * BLOCK):
        for side in range(2):
            w = source[side][at : at + 4 * BLOCK]
            near = windows[w, -RUN_IN:].T if side == 0 else windows[w, :RUN_IN].T
            zero = np.zeros((units, len(w)), np.float32)
            starts[side][:, into[side][at : at + 4 * BLOCK]] = network.walk(side, np.ascontiguousarray(near), zero, None if side == 0 else left[w])
    totals = np.empty((n, len(network.labels)))

    def positions(w: np.ndarray, longest: int) -> np.ndarray:
        return np.ascontiguousarray(windows[w, :longest].T)

    def work(chosen: np.ndarray) -> None:
        # windows of like length share a block, which ends with its longest one
        chosen = chosen[np.argsort(-left[chosen], kind="stable")]
        for at in range(0, len(chosen), BLOCK):
            w = chosen[at : at + BLOCK]
            longest, valid = left[w[0]], left[w]
            bytes_ = positions(w, longest)
            forward = np.empty((longest, units, len(w)), np.float32)
            ends[0][:, w] = network.walk(0, bytes_, starts[0][:, w], valid, forward)
            # states of the backward direction are kept for some positions only
            back, total = starts[1][:, w], np.zeros((len(network.labels), len(w)))
            for low in range((longest - 1) // SOME * SOME, -1, -SOME):
                part = bytes_[low : low + SOME]
                states = np.empty((len(part), 2 * units, len(w)), np.float32)
                states[:, :units] = forward[low : low + SOME]
                back = network.walk(1, part, back, valid - low, states[:, units:])
                chances = network.chances(states)
                if low + len(part) > valid[-1]:
                    chances *= (np.arange(low, low + len(part))[:, None] < valid)[:, None]
                total += chances.sum(axis=0)
            ends[1][:, w], totals[w] = back, total.T

    def far(side: int, pairs: np.ndarray) -> np.ndarray:
        return np.abs(ends[side][:, source[side][pairs]] - starts[side][:, into[side][pairs]]).max(axis=0, initial=0) > EDGE

    work(np.arange(n))
    every = np.arange(len(inner))
    off, below = [far(0, every), far(1, every)], np.full((2, n), -1)
    for side in range(2):
        below[side, source[side]] = every  # the pair that a window ends in
    sweep, again = 0, np.zeros(n, bool)
    while off[0].any() or off[1].any():
        for side in range(2):
            pairs = np.flatnonzero(off[side])
            if sweep >= 2:
                texts = owner[into[side][pairs]]
                outermost = np.unique(texts, return_index=True)[1] if side == 0 else len(pairs) - 1 - np.unique(texts[::-1], return_index=True)[1]
                pairs = pairs[outermost]
            w = into[side][pairs]
            starts[side][:, w] = ends[side][:, source[side][pairs]]
            for at in range(0, len(w), BLOCK):
                v = w[at : at + BLOCK]
                ends[side][:, v] = network.walk(side, positions(v, left[v].max()), starts[side][:, v], left[v])
            off[side][pairs] = False
            changed = below[side, w]
            changed = changed[changed >= 0]
            off[side][changed] = far(side, changed)
            again[w] = True
        sweep += 1
    work(np.flatnonzero(again))
    return totals


def label_texts(network: Network | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """The most likely label of each text and its chance, averaged over all positions."""
    names = [UNKNOWN] * len(texts)
    scores = np.zeros(len(texts))
    able = [i for i, t in enumerate(texts) if network is not None and _has_letter(t)]
    if not able:
        return names, scores
    raw = [texts[i].encode() for i in able]
    windows, left, counts = cut(raw)
    totals = text_chances(network, windows, left, counts)
    means = np.add.reduceat(totals, np.cumsum(counts) - counts) / np.array([len(r) for r in raw])[:, None]
    best = means.argmax(axis=1)
    for i, b in zip(able, best.tolist(), strict=True):
        names[i] = network.labels[b]
    scores[able] = np.clip(means[np.arange(len(best)), best], 0, 1)
    return names, scores


def predict(docs: DataFrame, network: Network | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Language and its chance for each document row, over the whole text.

    A text that is missing or has no letter is ``und`` with score 0; so is every text if
    nothing could be learned. Rows are judged each by themselves, also with missing or
    repeated ids; other columns are not read. Equal chances go to the first label in order.
    """

    def run(batch: pa.RecordBatch) -> dict:
        names, scores = label_texts(network, texts_of(batch, text_column))
        return {"lang_pred": names, "score": pa.array(scores)}

    made = over_texts(docs.select(id_column, text_column), [id_column, text_column], run, "lang_pred string, score double", SLICE_BYTES)
    return made.select(id_column, held_out(id_column).alias("held_out"), "lang_pred", "score")


def keep_known_language(docs: DataFrame, least_score: float = 0.4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The input rows whose language is told with a chance of ``least_score`` or more.

    The network is learned from the rows given. Texts that are missing or have no letter go.
    If nothing can be learned (no labelled row), texts with a letter stay.
    """
    network = learn(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # whole rows go through once, a slice at a time
        for part in sliced(batches, text_column, SLICE_BYTES):
            texts = texts_of(part, text_column)
            names, scores = label_texts(network, texts)
            if network is None:
                known = [_has_letter(t) for t in texts]
            else:
                known = [n != UNKNOWN and s >= least_score for n, s in zip(names, scores.tolist(), strict=True)]
            yield part.filter(pa.array(known, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
