"""Hierarchical navigable small-world graphs over unit vectors, built and searched in batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Vectors that search a graph together.
TOGETHER = 256


class SmallWorld:
    """Layers of neighbour lists; a vector is in every layer up to its level.

    Vectors are inserted in batches that double the graph at most. A batch searches the
    graph as it is; its members also see each other, so close pairs of a batch are linked.
    """

    def __init__(self, vectors: np.ndarray, neighbours: int = 12, beam: int = 48, seed: int = 3):
        self.vectors = np.ascontiguousarray(vectors, np.float32)
        n = len(vectors)
        draw = np.random.default_rng(seed).random(n)
        levels = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(neighbours)).astype(int), 8)
        self.order = np.argsort(-levels, kind="stable")
        top = int(levels.max(initial=0))
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []
        for level in range(top, -1, -1):
            members = self.order[: int((levels >= level).sum())]
            self._add_layer(members, neighbours * (2 if level == 0 else 1), beam)

    def arrays(self) -> dict[str, np.ndarray]:
        """The graph without its vectors, for storage."""
        return {f"{kind}{i}": x for i, layer in enumerate(self.layers) for kind, x in zip(("members", "links"), layer, strict=True)}

    @classmethod
    def stored(cls, vectors: np.ndarray, arrays: dict[str, np.ndarray]) -> SmallWorld:
        """A graph from its vectors and what ``arrays`` gave."""
        graph = cls.__new__(cls)
        graph.vectors = np.ascontiguousarray(vectors, np.float32)
        graph.layers = [(arrays[f"members{i}"], arrays[f"links{i}"]) for i in range(sum(k.startswith("links") for k in arrays))]
        return graph

    def _add_layer(self, members: np.ndarray, width: int, beam: int) -> None:
        """A layer over the first vectors of the order; the layers above give entry points."""
        links = np.full((len(members), width), -1, np.int32)
        self.layers.append((members, links))
        done = 0
        while done < len(members):
            batch = np.arange(done, min(len(members), max(done * 2, done + 32, 1), done + 1024))
            queries = self.vectors[members[batch]]
            among = queries @ queries.T
            np.fill_diagonal(among, -2)
            keep = min(width, len(batch) - 1)
            inside = np.argsort(-among, axis=1, kind="stable")[:, :keep]
            found, sims = batch[inside], np.take_along_axis(among, inside, axis=1)
            if done:
                old, old_sims = self._search(queries, beam, layer=len(self.layers) - 1, limit=done)
                found, sims = np.concatenate([old, found], axis=1), np.concatenate([old_sims, sims], axis=1)
            self._link(links, members, batch, found, sims)
            done = int(batch[-1]) + 1

    def _link(self, links: np.ndarray, members: np.ndarray, batch: np.ndarray, found: np.ndarray, sims: np.ndarray) -> None:
        """Give each new vector a spread choice of those found, and those a link back."""
        chosen = self._spread(members, found, sims, links.shape[1] // 2)
        links[batch, : chosen.shape[1]] = chosen
        source = np.repeat(batch, chosen.shape[1])
        target = chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        for node in np.unique(target).tolist():
            known = links[node][links[node] >= 0]
            merged = np.unique(np.concatenate([known, source[target == node]]))
            if len(merged) > links.shape[1]:
                near = self.vectors[members[merged]] @ self.vectors[members[node]]
                order = np.argsort(-near, kind="stable")
                merged = self._spread(members, merged[order][None], near[order][None], links.shape[1])[0]
                merged = merged[merged >= 0]
            links[node] = -1
            links[node, : len(merged)] = merged

    def _spread(self, members: np.ndarray, found: np.ndarray, sims: np.ndarray, count: int) -> np.ndarray:
        """Up to ``count`` of each row: nearest first, passing over those nearer to one already chosen.

        Places left over are filled with the nearest that were passed over.
        """
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 4 * count]
        found, sims = np.take_along_axis(found, order, axis=1), np.take_along_axis(sims, order, axis=1)
        rows, width = found.shape
        vectors = self.vectors[members[np.maximum(found, 0)]]
        between = np.einsum("rid,rjd->rij", vectors, vectors, optimize=True)
        taken = np.zeros((rows, width), bool)
        closest = np.full((rows, width), -2.0, np.float32)
        number = np.zeros(rows, int)
        for j in range(width):
            good = (found[:, j] >= 0) & (closest[:, j] < sims[:, j]) & (number < count)
            taken[:, j] = good
            number += good
            closest = np.where(good[:, None], np.maximum(closest, between[:, j, :]), closest)
        rank = np.where(found < 0, 2, np.where(taken, 0, 1))
        best = np.argsort(rank, axis=1, kind="stable")[:, :count]
        return np.take_along_axis(found, best, axis=1)

    def _search(self, queries: np.ndarray, beam: int, layer: int | None = None, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest found in a layer for each query, as places in the layer's order."""
        layer = len(self.layers) - 1 if layer is None else layer
        entry = np.zeros((len(queries), 1), np.int32)
        for upper in range(layer):
            entry = self._walk(queries, entry, min(8, beam), upper, None)[0][:, : min(4, beam)]
        return self._walk(queries, entry, beam, layer, limit)

    def _walk(self, queries: np.ndarray, entry: np.ndarray, beam: int, layer: int, limit: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries in step, from entry places; -1 and -2 fill empty places."""
        members, links = self.layers[layer]
        size = len(members) if limit is None else limit
        results = []
        for start in range(0, len(queries), TOGETHER):
            q = queries[start : start + TOGETHER]
            rows = np.arange(len(q))
            seen = np.zeros((len(q), size), bool)
            at = np.where(entry[start : start + TOGETHER] < size, entry[start : start + TOGETHER], 0)
            ids = np.full((len(q), beam), -1, np.int64)
            sims = np.full((len(q), beam), -2.0, np.float32)
            open_ = np.zeros((len(q), beam), bool)
            fresh = at.astype(np.int64)
            while True:
                # the same place may come twice in a row: only its first counts
                ranked = np.sort(fresh, axis=1)
                ranked[:, 1:][ranked[:, 1:] == ranked[:, :-1]] = -1
                valid = ranked >= 0
                valid &= ~seen[rows[:, None], np.maximum(ranked, 0)]
                seen[np.broadcast_to(rows[:, None], ranked.shape)[valid], ranked[valid]] = True
                near = np.full(ranked.shape, -2.0, np.float32)
                row, _ = np.nonzero(valid)
                near[valid] = np.einsum("nd,nd->n", self.vectors[members[ranked[valid]]], q[row])
                ids = np.concatenate([ids, np.where(valid, ranked, -1)], axis=1)
                sims = np.concatenate([sims, near], axis=1)
                open_ = np.concatenate([open_, valid], axis=1)
                if ids.shape[1] > beam:
                    best = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
                    ids, sims, open_ = (np.take_along_axis(x, best, axis=1) for x in (ids, sims, open_))
                if not open_.any():
                    break
                # each query opens its two nearest open places
                waiting = np.where(open_, sims, -3)
                two = np.argpartition(-waiting, min(2, beam - 1), axis=1)[:, :2]
                take = np.take_along_axis(open_, two, axis=1)
                opened = np.where(take, np.take_along_axis(ids, two, axis=1), -1)
                np.put_along_axis(open_, two, False, axis=1)
                fresh = np.where(opened[:, :, None] >= 0, links[np.maximum(opened, 0)], -1).reshape(len(q), -1).astype(np.int64)
                fresh[fresh >= size] = -1
            results.append((ids, sims))
        return tuple(np.concatenate(x) for x in zip(*results, strict=True))

    def within(self, queries: np.ndarray, floor: float, beam: int, slack: float = 0.0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, vector) pairs found at a similarity of ``floor`` or more, for some queries at a time.

        The beam finds the way; from what it found, every vector at ``floor - slack`` or
        more is opened too, so that groups larger than the beam are followed to their ends.
        """
        members, links = self.layers[-1]
        for start in range(0, len(queries), TOGETHER):
            q = queries[start : start + TOGETHER]
            ids, sims = self._search(q, beam)
            seen = np.zeros((len(q), len(members)), bool)
            row, column = np.nonzero(ids >= 0)
            seen[row, ids[row, column]] = True
            row, column = np.nonzero((sims >= floor - slack) & (ids >= 0))
            place, near = ids[row, column], sims[row, column]
            while len(place):
                good = near >= floor
                yield row[good] + start, members[place[good]]
                fresh = np.zeros_like(seen)
                for k in range(links.shape[1]):
                    following = links[place, k]
                    fresh[row[following >= 0], following[following >= 0]] = True
                fresh &= ~seen
                seen |= fresh
                row, place = np.nonzero(fresh)
                near = np.concatenate(
                    [np.einsum("nd,nd->n", self.vectors[members[place[i : i + 65536]]], q[row[i : i + 65536]]) for i in range(0, len(place), 65536)] or [np.zeros(0)]
                )
                opened = near >= floor - slack
                row, place, near = row[opened], place[opened], near[opened]
