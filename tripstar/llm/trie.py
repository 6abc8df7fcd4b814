"""A compressed prefix tree over ordered integer sets, and probes against it."""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


class Trie:
    """Sets are arrays of tokens; ``sizes`` are their full sizes, which may
    count tokens that no other set has and that are not in the arrays.

    Tokens get a global order (most frequent first, so that paths are shared);
    every set is a path.  A node holds the tokens on its edge, the range of the
    (sorted) sets below it, and the smallest size and the longest path there.
    """

    def __init__(self, sets: list[np.ndarray], sizes: np.ndarray):
        m = len(sets)
        flat = np.concatenate(sets)
        lens = np.array([len(s) for s in sets], dtype=np.int64)
        _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
        order = np.empty(len(counts), np.int64)
        order[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        ranks = order[inverse]
        owner = np.repeat(np.arange(m), lens)
        ranks = ranks[np.lexsort((ranks, owner))]
        off = np.concatenate([[0], np.cumsum(lens)])
        paths = [ranks[off[i]:off[i + 1]] for i in range(m)]
        big = ranks.astype(">u4").tobytes()
        self.order = sorted(range(m), key=lambda i: big[4 * off[i]:4 * off[i + 1]])
        self.paths = [paths[i] for i in self.order]
        self.sizes = sizes[self.order]
        self.n_tokens = len(counts)
        self._build()

    def _build(self):
        m, paths = len(self.paths), self.paths
        common = np.zeros(m + 1, np.int64)  # common[i]: with the path before
        for i in range(1, m):
            a, b = paths[i - 1], paths[i]
            k = min(len(a), len(b))
            differ = np.flatnonzero(a[:k] != b[:k])
            common[i] = differ[0] if len(differ) else k
        # inner nodes are the intervals of equal common depth
        parent, depth, low, high, rep = [-1], [0], [0], [m], [0]
        stack, leaf_parent = [0], np.zeros(m, np.int64)
        for i in range(m):
            want = int(max(common[i], common[i + 1]))
            while depth[stack[-1]] > common[i]:
                high[stack.pop()] = i
            if depth[stack[-1]] < common[i]:  # an ancestor opened by this depth
                raise AssertionError("inner node is missing")
            if want > depth[stack[-1]]:
                # depths between are opened now, deepest last, as later common
                # prefixes inside this stretch need them
                todo, d = [want], want
                j = i + 1
                while j < m and common[j] > depth[stack[-1]]:
                    if common[j] < d:
                        d = int(common[j])
                        todo.append(d)
                    j += 1
                for d in reversed(todo):
                    parent.append(stack[-1])
                    depth.append(d)
                    low.append(i)
                    high.append(m)
                    rep.append(i)
                    stack.append(len(depth) - 1)
            leaf_parent[i] = stack[-1]
        inner = len(depth)
        self.parent = np.concatenate([np.array(parent), leaf_parent])
        lens = np.array([len(p) for p in paths])
        self.depth = np.concatenate([np.array(depth), lens])
        self.low = np.concatenate([np.array(low), np.arange(m)])
        self.high = np.concatenate([np.array(high), np.arange(1, m + 1)])
        rep = np.concatenate([np.array(rep), np.arange(m)])
        self.leaf = np.arange(inner + m) >= inner
        self.inner = inner
        begin = np.where(self.parent >= 0, self.depth[self.parent], 0)
        off = np.concatenate([[0], np.cumsum(lens)])
        flat = np.concatenate(paths) if m else np.zeros(0, np.int64)
        self.edge_size = self.depth - begin
        self.edge = flat[_ranges(off[rep] + begin, self.edge_size)]
        self.edge_at = np.concatenate([[0], np.cumsum(self.edge_size)])
        at_end = np.concatenate([flat, [0]])[np.minimum(off[rep] + self.depth - 1, len(flat))]
        self.end_token = np.where(self.depth > 0, at_end, -1)
        self.min_size = np.empty(inner + m, np.int64)
        self.max_path = np.empty(inner + m, np.int64)
        self.min_size[inner:], self.max_path[inner:] = self.sizes, lens
        for k in range(inner):
            self.min_size[k] = self.sizes[self.low[k]:self.high[k]].min()
            self.max_path[k] = lens[self.low[k]:self.high[k]].max()
        by_parent = np.argsort(self.parent, kind="stable")
        self.children = by_parent[1:]  # without the root
        self.child_at = np.searchsorted(self.parent[self.children], np.arange(inner + m + 1))

    def probe(self, q: int, threshold: int, open_: np.ndarray) -> tuple[np.ndarray, int]:
        """Sorted places of the sets in ``open_`` that link with set ``q``
        (100 x intersection >= threshold x union), and nodes visited.

        Overlaps are carried down the tree, so sets share the work of their
        common path.  A subtree is left when even all tokens that can still
        follow would not reach the threshold, or when it has no open set."""
        path, size = self.paths[q], int(self.sizes[q])
        mark = np.zeros(self.n_tokens, np.int64)
        mark[path] = 1
        opened = np.concatenate([[0], np.cumsum(open_)])
        nodes = self.children[self.child_at[0]:self.child_at[1]]
        carried = np.zeros(len(nodes), np.int64)
        found, visited = [], 0
        while len(nodes):
            some = opened[self.high[nodes]] > opened[self.low[nodes]]
            nodes, carried = nodes[some], carried[some]
            if not len(nodes):
                break
            visited += len(nodes)
            sums = np.concatenate([[0], np.cumsum(mark[self.edge[_ranges(self.edge_at[nodes], self.edge_size[nodes])]])])
            ends = np.cumsum(self.edge_size[nodes])
            overlap = carried + sums[ends] - sums[ends - self.edge_size[nodes]]
            left = np.minimum(len(path) - np.searchsorted(path, self.end_token[nodes], side="right"),
                              self.max_path[nodes] - self.depth[nodes])
            total = size + self.min_size[nodes]
            alive = (100 + threshold) * (overlap + left) >= threshold * total
            nodes, overlap = nodes[alive], overlap[alive]
            leaf = self.leaf[nodes]
            found.append(nodes[leaf] - self.inner)  # a leaf has nothing left: its bound is exact
            nodes, overlap = nodes[~leaf], overlap[~leaf]
            n = self.child_at[nodes + 1] - self.child_at[nodes]
            carried = np.repeat(overlap, n)
            nodes = self.children[_ranges(self.child_at[nodes], n)]
        hits = np.concatenate(found) if found else np.zeros(0, np.int64)
        return hits, visited


def link_groups(sets: list[np.ndarray], sizes: np.ndarray, threshold: int) -> np.ndarray:
    """Component number of each set under the link relation.

    Sets are taken up one after the other from the ones already reached; each
    is probed against the tree of the sets that nobody has reached yet.  Every
    pair of different components has then been compared."""
    trie = Trie(sets, sizes)
    m = len(sets)
    open_, group, n = np.ones(m, np.int64), np.empty(m, np.int64), 0
    for s in range(m):
        if not open_[s]:
            continue
        open_[s] = 0
        queue = [s]
        while queue:
            q = queue.pop()
            group[trie.order[q]] = n
            hits, _ = trie.probe(q, threshold, open_)
            hits = hits[open_[hits] > 0]
            open_[hits] = 0
            queue += hits.tolist()
            if not open_.any():
                break
        for q in queue:
            group[trie.order[q]] = n
        n += 1
    return group
