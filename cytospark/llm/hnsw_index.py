"""A hierarchical navigable small-world graph over one shard of unit vectors, as flat arrays.

``links[l]`` holds the neighbours of the nodes of level l in rows of fixed width (-1: none).  Nodes are
inserted in batches: a batch searches the graph so far, takes its neighbours by the usual
diversity rule, and links back; lists that overflow are thinned by the same rule."""
from __future__ import annotations

import numpy as np

M = 16
EF_BUILD = 80
EXPAND = 4
MAX_BATCH = 1024


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 7, m: int = M, ef_build: int = EF_BUILD):
        """``vectors``: float32 rows of length 1."""
        self.vectors, self.m = np.ascontiguousarray(vectors, dtype=np.float32), m
        n = len(vectors)
        u = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(m)).astype(np.int64), 8)
        # Nodes of the higher levels come first, so that every level's graph is there when it is searched.
        order = np.argsort(-self.level, kind="stable")
        self.links = [np.full((n, 2 * m if l == 0 else m), -1, dtype=np.int32) for l in range(int(self.level.max(initial=0)) + 1)]
        self.entry = int(order[0]) if n else -1
        at = 1
        while at < n:
            size = min(MAX_BATCH, max(16, at // 2))
            self._insert(order[at:at + size], ef_build)
            at += size

    def _insert(self, batch: np.ndarray, ef: int) -> None:
        q = self.vectors[batch]
        enter = np.full((len(batch), 1), self.entry)
        own = q @ q.T
        np.fill_diagonal(own, -np.inf)
        for l in range(len(self.links) - 1, -1, -1):
            mine = self.level[batch] >= l
            ids, sims = self._beam(q, enter, l, ef if mine.any() else 1)
            if mine.any():
                here = np.flatnonzero(mine)
                near = own[np.ix_(here, here)]
                k = min(len(here), self.m)
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                cand = np.concatenate([ids[here], batch[here][best]], axis=1)
                csim = np.concatenate([sims[here], np.take_along_axis(near, best, 1)], axis=1)
                chosen = self._choose(cand, csim, self.m)
                self.links[l][batch[here], :self.m] = chosen
                a, b = np.nonzero(chosen >= 0)
                self._link_back(l, chosen[a, b], batch[here][a])
            enter = ids[:, :1]

    def _choose(self, cand: np.ndarray, sims: np.ndarray, k: int) -> np.ndarray:
        """Up to k neighbours a row: by nearness, those nearer to the row's node than to any chosen before,
        then the nearest of the others.  -inf marks what is no candidate."""
        width = min(cand.shape[1], 3 * k)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        valid = np.isfinite(sims)
        v = self.vectors[np.maximum(cand, 0)]
        between = v @ v.transpose(0, 2, 1)
        taken = np.zeros(cand.shape, dtype=bool)
        for c in range(width):
            hidden = (taken[:, :c] & (between[:, c, :c] > sims[:, c, None])).any(axis=1)
            taken[:, c] = valid[:, c] & ~hidden & (taken[:, :c].sum(axis=1) < k)
        rank = np.where(taken, 0, np.where(valid, 1, 2))
        first = np.argsort(rank, axis=1, kind="stable")[:, :k]
        out = np.where(np.take_along_axis(rank, first, 1) < 2, np.take_along_axis(cand, first, 1), -1)
        if out.shape[1] < k:
            out = np.pad(out, ((0, 0), (0, k - out.shape[1])), constant_values=-1)
        return out

    def _link_back(self, l: int, nodes: np.ndarray, new: np.ndarray) -> None:
        links = self.links[l]
        order = np.argsort(nodes, kind="stable")
        nodes, new = nodes[order], new[order]
        uniq, first, count = np.unique(nodes, return_index=True, return_counts=True)
        have = (links[uniq] >= 0).sum(axis=1)
        width = links.shape[1]
        row = np.repeat(np.arange(len(uniq)), count)
        place = np.arange(len(nodes)) - np.repeat(first, count) + have[row]
        fits = (have + count <= width)[row]
        links[nodes[fits], place[fits]] = new[fits]
        full = np.flatnonzero(have + count > width)
        for some in np.array_split(full, max(1, len(full) // 512)):
            if not len(some):
                continue
            most = int((have[some] + count[some]).max())
            cand = np.full((len(some), most), -1, dtype=np.int64)
            cand[:, :width] = links[uniq[some]]
            back = np.full(len(uniq), -1)
            back[some] = np.arange(len(some))
            mine = back[row] >= 0
            cand[back[row[mine]], place[mine]] = new[mine]
            sims = np.einsum("awd,ad->aw", self.vectors[np.maximum(cand, 0)], self.vectors[uniq[some]])
            sims[cand < 0] = -np.inf
            links[uniq[some]] = self._choose(cand, sims, width)

    def _beam(self, q: np.ndarray, enter: np.ndarray, l: int, ef: int, expand: int = EXPAND) -> tuple[np.ndarray, np.ndarray]:
        """The ef nearest found from the entry nodes of each query, nearest first (-1, -inf: none)."""
        links, n = self.links[l], len(self.vectors)
        ids = np.full((len(q), ef), -1, dtype=np.int64)
        sims = np.full((len(q), ef), -np.inf, dtype=np.float32)
        k = min(ef, enter.shape[1])
        ids[:, :k] = enter[:, :k]
        sims[:, :k] = np.einsum("qkd,qd->qk", self.vectors[enter[:, :k]], q)
        seen = np.zeros((len(q), n), dtype=bool)
        seen[np.arange(len(q))[:, None], enter[:, :k]] = True
        done = ids < 0
        act = np.arange(len(q))
        while len(act):
            open_ = ~done[act]
            pick = open_ & (np.cumsum(open_, axis=1) <= expand)
            some = pick.any(axis=1)
            act, pick = act[some], pick[some]
            if not len(act):
                break
            qi, bi = np.nonzero(pick)
            done[act[qi], bi] = True
            near = links[ids[act[qi], bi]]
            r, c = np.nonzero(near >= 0)
            row, node = qi[r], near[r, c].astype(np.int64)
            fresh = ~seen[act[row], node]
            key = np.unique(row[fresh] * n + node[fresh])
            row, node = key // n, key % n
            seen[act[row], node] = True
            got = np.einsum("id,id->i", self.vectors[node], q[act[row]])
            count = np.bincount(row, minlength=len(act))
            width = int(count.max(initial=0))
            if width:
                place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                more_ids = np.full((len(act), width), -1, dtype=np.int64)
                more_sims = np.full((len(act), width), -np.inf, dtype=np.float32)
                more_ids[row, place], more_sims[row, place] = node, got
                all_sims = np.concatenate([sims[act], more_sims], axis=1)
                top = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
                ids[act] = np.take_along_axis(np.concatenate([ids[act], more_ids], axis=1), top, 1)
                sims[act] = np.take_along_axis(all_sims, top, 1)
                done[act] = np.take_along_axis(np.concatenate([done[act], more_ids < 0], axis=1), top, 1)
        return ids, sims

    def search(self, q: np.ndarray, k: int, ef: int, block: int = 256) -> np.ndarray:
        """The k nearest nodes found for each query (-1: none)."""
        out = np.full((len(q), k), -1, dtype=np.int64)
        if self.entry < 0:
            return out
        for at in range(0, len(q), block):
            part = np.ascontiguousarray(q[at:at + block], dtype=np.float32)
            enter = np.full((len(part), 1), self.entry)
            for l in range(len(self.links) - 1, 0, -1):
                enter = self._beam(part, enter, l, 1, 1)[0]
            ids, _ = self._beam(part, enter, 0, max(ef, k))
            out[at:at + block] = ids[:, :k]
        return out

    # --- flat form ---------------------------------------------------------------------------------------

    def pack(self) -> list[bytes]:
        """The arrays of the graph: vectors, then the used rows of each level."""
        parts = [np.array([len(self.vectors), self.vectors.shape[1] if self.vectors.ndim > 1 else 0, self.entry, len(self.links),
                           self.m], dtype="<i8").tobytes(), self.vectors.tobytes(), self.level.astype("<i8").tobytes()]
        return parts + [x[self.level >= l].tobytes() for l, x in enumerate(self.links)]

    @classmethod
    def unpack(cls, parts: list[bytes]) -> Graph:
        self = cls.__new__(cls)
        n, dim, self.entry, levels, self.m = np.frombuffer(parts[0], "<i8").tolist()
        self.vectors = np.frombuffer(parts[1], np.float32).reshape(n, dim)
        self.level = np.frombuffer(parts[2], "<i8")
        self.links = []
        for l in range(levels):
            width = 2 * self.m if l == 0 else self.m
            full = np.full((n, width), -1, dtype=np.int32)
            full[self.level >= l] = np.frombuffer(parts[3 + l], np.int32).reshape(-1, width)
            self.links.append(full)
        return self
