"""Pair merging of many symbol sequences at once, on flat numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NEVER = np.int32(2**31 - 1)


@dataclass(frozen=True)
class PairTable:
    """Merges as sorted pair keys with their rank and product.

    ``one_by_one[x]`` marks products that some pair of no higher rank can follow: their
    occurrences in one sequence are merged one at a time, all others together.
    """

    keys: np.ndarray
    ranks: np.ndarray
    products: np.ndarray
    one_by_one: np.ndarray

    @staticmethod
    def build(left: np.ndarray, right: np.ndarray, rank: np.ndarray, product: np.ndarray, n_symbols: int) -> PairTable:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        order = np.argsort(keys, kind="stable")
        made_at = np.full(n_symbols, -1, np.int64)
        np.maximum.at(made_at, product, rank)
        careful = np.zeros(n_symbols, bool)
        for part in (left, right):
            careful[part[made_at[part] >= rank]] = True
        return PairTable(keys[order], rank[order].astype(np.int32), product[order].astype(np.int32), careful)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER if there is none) and product of each pair."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        return np.where(found, self.ranks[at], NEVER), np.where(found, self.products[at], -1).astype(np.int32)


def merge(symbols: np.ndarray, lengths: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every sequence until no pair remains; returns flat symbols and lengths.

    In a round each sequence takes its pair of lowest rank, leftmost first. Occurrences
    that do not overlap are merged together where that gives the same as one by one.
    Finished sequences leave the arrays after each round.
    """
    count = len(lengths)
    out_lengths = np.zeros(count, np.int64)
    done_words, done_symbols = [], []
    words = np.flatnonzero(lengths > 0)
    symbols, lengths = symbols.astype(np.int32), lengths[words].astype(np.int64)
    ranks = np.full(len(symbols), NEVER, np.int32)
    products = np.full(len(symbols), -1, np.int32)
    if len(symbols) > 1:
        ranks[:-1], products[:-1] = table.look_up(symbols[:-1], symbols[1:])
    if len(words):
        ranks[np.cumsum(lengths) - 1] = NEVER
    while len(words):
        starts = np.cumsum(lengths) - lengths
        lowest = np.minimum.reduceat(ranks, starts)
        going = lowest < NEVER
        if not going.all():
            stay = np.repeat(going, lengths)
            done_words.append(words[~going])
            out_lengths[words[~going]] = lengths[~going]
            done_symbols.append(symbols[~stay])
            words, lengths, lowest = words[going], lengths[going], lowest[going]
            symbols, ranks, products = symbols[stay], ranks[stay], products[stay]
            if not len(words):
                break
        owner = np.repeat(np.arange(len(words)), lengths)
        hits = np.flatnonzero(ranks == lowest[owner])
        # of hits that overlap, every second one counts from the left
        fresh = np.ones(len(hits), bool)
        fresh[1:] = np.diff(hits) > 1
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
        take = (np.arange(len(hits)) - run_start) % 2 == 0
        first = np.ones(len(hits), bool)
        first[1:] = np.diff(owner[hits]) > 0
        take &= first | ~table.one_by_one[products[hits]]
        hits = hits[take]
        symbols[hits] = products[hits]
        keep = np.ones(len(symbols), bool)
        keep[hits + 1] = False
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(lengths) - 1] = True
        last[hits] = last[hits + 1]
        lengths = lengths - np.bincount(owner[hits], minlength=len(words))
        moved = np.cumsum(keep) - 1
        symbols, ranks, products, last = symbols[keep], ranks[keep], products[keep], last[keep]
        at = moved[hits]
        stale = np.unique(np.concatenate([at, at[at > 0] - 1]))
        ranks[stale] = NEVER
        stale = stale[~last[stale]]
        ranks[stale], products[stale] = table.look_up(symbols[stale], symbols[stale + 1])
    if not done_words:
        return np.zeros(0, np.int32), out_lengths
    finished = np.concatenate(done_words)
    flat = np.concatenate(done_symbols)
    sizes = out_lengths[finished]
    order = np.argsort(finished, kind="stable")
    begins = (np.cumsum(sizes) - sizes)[order]
    sizes = sizes[order]
    gather = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    return flat[gather], out_lengths
