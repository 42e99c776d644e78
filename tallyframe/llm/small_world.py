"""Hierarchical navigable small-world graph over unit vectors, in numpy.

Insertions and searches run for many vectors at once, in lockstep: each step
expands the best open candidate of every query.  Neighbours are chosen by the
diversity rule (a candidate counts only if it is nearer to the new vector
than to any neighbour chosen before), so groups of near copies stay reachable.
"""

from __future__ import annotations

import numpy as np

from tallyframe.llm import arrays as A

DEGREE, BASE_DEGREE, BUILD_BEAM, LOT = 12, 24, 40, 256


class Graph:
    """``layers[0]`` holds every vector; row i of a layer's table lists neighbours (-1: none)."""

    def __init__(self, x: np.ndarray, layers: list[np.ndarray], entry: int):
        self.x, self.layers, self.entry = x, layers, entry

    @classmethod
    def build(cls, x: np.ndarray, ids: np.ndarray) -> Graph:
        n = len(x)
        u = (A.mix(ids.view(A.U64), 51) >> A.U64(11)).astype(np.float64) / 2.0**53
        level = np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(DEGREE)).astype(np.int64), 6)
        order = np.lexsort((ids, A.mix(ids.view(A.U64), 52), -level))  # upper layers first
        g = cls(x, [np.full((n, BASE_DEGREE if k == 0 else DEGREE), -1, np.int32) for k in range(int(level.max(initial=0)) + 1)], int(order[0]))
        done = 1
        while done < n:
            lot = order[done : done + min(LOT, max(1, done))]
            near = np.full((len(lot), 1), g.entry, np.int32)
            for k in range(len(g.layers) - 1, -1, -1):
                ids_k, sims = g.search(k, x[lot], near, BUILD_BEAM if k <= level[lot].max() else 1)
                near = ids_k[:, :1]
                now = np.flatnonzero(level[lot] >= k)
                if len(now):
                    g.link(k, lot[now], ids_k[now], sims[now])
            done += len(lot)
        return g

    def link(self, k: int, lot: np.ndarray, found: np.ndarray, sims: np.ndarray) -> None:
        """Join new vectors to what was found and to each other, both ways."""
        table, peers = self.layers[k], self.x[lot] @ self.x[lot].T
        np.fill_diagonal(peers, -np.inf)
        cand = np.concatenate([found, np.broadcast_to(lot.astype(np.int32), (len(lot), len(lot)))], axis=1)
        value = np.concatenate([sims, peers], axis=1)
        top = min(BUILD_BEAM, cand.shape[1])
        best = np.argpartition(-value, top - 1, axis=1)[:, :top]
        cand, value = np.take_along_axis(cand, best, 1), np.take_along_axis(value, best, 1)
        cand = np.where(np.isfinite(value), cand, -1)
        table[lot] = self.choose(self.x[lot], cand, value, table.shape[1])
        # and back: every vector named gets the new ones as candidates
        a, b = np.repeat(lot, table.shape[1]), table[lot].ravel()
        a, b = a[b >= 0], b[b >= 0]
        order = np.lexsort((a, b))
        a, b = a[order], b[order]
        first = A.group_starts(b)
        many = np.diff(np.r_[first, len(b)])
        for lo in range(0, len(first), 512):
            f, m = first[lo : lo + 512], many[lo : lo + 512]
            node = b[f]
            wide = np.full((len(f), int(m.max(initial=0))), -1, np.int32)
            wide[np.repeat(np.arange(len(f)), m), np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)] = a[f[0] : f[-1] + m[-1]]
            cand = np.concatenate([table[node], wide], axis=1)
            value = np.einsum("nkd,nd->nk", self.x[cand], self.x[node])
            value[cand < 0] = -np.inf
            value[:, table.shape[1] :][(wide[:, :, None] == table[node][:, None, :]).any(axis=2)] = -np.inf
            table[node] = self.choose(self.x[node], np.where(np.isfinite(value), cand, -1), value, table.shape[1])

    def choose(self, q: np.ndarray, cand: np.ndarray, value: np.ndarray, degree: int) -> np.ndarray:
        """Up to ``degree`` diverse neighbours; nearest others fill free places."""
        order = np.argsort(-value, axis=1, kind="stable")[:, : 2 * BUILD_BEAM]
        cand, value = np.take_along_axis(cand, order, 1), np.take_along_axis(value, order, 1)
        n, w = cand.shape
        v = self.x[cand]
        between = v @ v.transpose(0, 2, 1)
        taken = np.zeros((n, w), bool)
        for j in range(w):
            nearer = (np.where(taken, between[:, j, :], -np.inf)).max(axis=1)
            taken[:, j] = (cand[:, j] >= 0) & (nearer < value[:, j]) & (taken.sum(axis=1) < degree)
        rank = np.argsort(np.where(taken, 0, np.where(cand >= 0, 1, 2)), axis=1, kind="stable")[:, :degree]
        out = np.full((n, degree), -1, np.int32)
        out[:, : rank.shape[1]] = np.take_along_axis(cand, rank, 1)
        return out

    def search(self, k: int, q: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the ``beam`` best found in a layer, best first; -1 and -inf where fewer."""
        table, n = self.layers[k], len(q)
        seen = np.zeros((n, len(self.x) + 1), bool)  # the spare last column takes the -1 of free places
        rows = np.arange(n)
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -np.inf, np.float32)
        ids[:, : start.shape[1]] = start[:, :beam]
        sims[:, : start.shape[1]] = np.einsum("nkd,nd->nk", self.x[ids[:, : start.shape[1]]], q)
        sims[ids < 0] = -np.inf
        seen[rows[:, None], ids] = True
        open_ = ids >= 0
        while True:
            go = np.flatnonzero(open_.any(axis=1))
            if not len(go):
                return ids, sims
            pick = np.where(open_[go], sims[go], -np.inf).argmax(axis=1)
            node = ids[go, pick]
            open_[go, pick] = False
            near = table[node]
            fresh = (near >= 0) & ~seen[go[:, None], near]
            seen[go[:, None], near] = True
            value = np.einsum("nkd,nd->nk", self.x[near], q[go])
            value[~fresh] = -np.inf
            better = value > sims[go].min(axis=1)[:, None]
            if not better.any():
                continue
            all_ids, all_sims = np.concatenate([ids[go], near], axis=1), np.concatenate([sims[go], value], axis=1)
            all_open = np.concatenate([open_[go], fresh & better], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            sims[go] = np.take_along_axis(all_sims, order, 1)
            ids[go] = np.where(np.isfinite(sims[go]), np.take_along_axis(all_ids, order, 1), -1)
            open_[go] = np.take_along_axis(all_open, order, 1) & (ids[go] >= 0)

    def nearest(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the ``beam`` best found from the top layer down."""
        near = np.full((len(q), 1), self.entry, np.int32)
        for k in range(len(self.layers) - 1, 0, -1):
            near = self.search(k, q, near, 1)[0]
        return self.search(0, q, near, beam)

    def within(self, q: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) pairs found with a similarity of at least ``least``: a beam search, then
        the whole neighbourhood of what it found, step by step through vectors that are near enough."""
        ids, sims = self.nearest(q, beam)
        row, col = np.nonzero(sims >= least)
        node = ids[row, col].astype(np.int64)
        seen = np.zeros((len(q), len(self.x)), bool)
        seen[row, node] = True
        out = [(row, node)]
        while len(row):
            nxt = self.layers[0][node]
            r = np.broadcast_to(row[:, None], nxt.shape)[nxt >= 0]
            c = nxt[nxt >= 0].astype(np.int64)
            fresh = ~seen[r, c]
            key = np.unique(r[fresh] * len(self.x) + c[fresh])
            r, c = key // len(self.x), key % len(self.x)
            seen[r, c] = True
            hit = np.zeros(len(r), bool)
            for a in range(0, len(r), 1 << 16):
                hit[a : a + (1 << 16)] = np.einsum("nd,nd->n", self.x[c[a : a + (1 << 16)]], q[r[a : a + (1 << 16)]]) >= least
            row, node = r[hit], c[hit]
            out.append((row, node))
        row, node = (np.concatenate(x) for x in zip(*out, strict=True))
        return row, node
