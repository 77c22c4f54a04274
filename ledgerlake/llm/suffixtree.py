"""Suffix trees of whole-number sequences: Ukkonen's construction, Euler tours, and longest common extensions by lowest common ancestors."""

from __future__ import annotations

import numpy as np


class SuffixTree:
    """The tree of a sequence of numbers from 1, closed by 0, which occurs once.

    Nodes are numbered as they are made; ``start``, ``end`` and ``parent`` tell a node's edge. ``leaf[i]`` is that of the suffix
    from i. Edges are one dictionary by node and first number, so memory is a few hundred bytes a place.
    """

    def __init__(self, symbols: list[int]):
        text = self.text = [*symbols, 0]
        n, width = len(text), max(text) + 1
        start, end, link, parent, edge = [0], [0], [0], [0], {}
        leaf = [0] * n
        node, at, length, waiting = 0, 0, 0, 0  # the active point: below node, along the edge of text[at], so far; suffixes still to insert
        for i, c in enumerate(text):
            waiting += 1
            made = 0
            while waiting:
                if not length:
                    at = i
                key = node * width + text[at]
                child = edge.get(key)
                if child is None:
                    child = len(start)
                    edge[key] = child
                    start.append(i), end.append(n), link.append(0), parent.append(node)
                    leaf[i - waiting + 1] = child
                    if made:
                        link[made] = node
                    made = node
                else:
                    s = start[child]
                    span = (end[child] if end[child] <= i else i + 1) - s
                    if length >= span:  # go down this edge first
                        at, length, node = at + span, length - span, child
                        continue
                    if text[s + length] == c:
                        length += 1
                        if made:
                            link[made] = node
                        break
                    mid = len(start)
                    edge[key] = mid
                    start.append(s), end.append(s + length), link.append(0), parent.append(node)
                    start[child] = s + length
                    parent[child] = mid
                    edge[mid * width + text[s + length]] = child
                    edge[mid * width + c] = mid + 1
                    start.append(i), end.append(n), link.append(0), parent.append(mid)
                    leaf[i - waiting + 1] = mid + 1
                    if made:
                        link[made] = mid
                    made = mid
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    at = i - waiting + 1
        self.start, self.end, self.parent = (np.array(x, np.int64) for x in (start, end, parent))
        self.leaf = np.array(leaf, np.int64)
        first = np.array(text, np.int64)[self.start]
        first[0] = 0
        self.first = first
        self._children(first)

    def _children(self, first: np.ndarray) -> None:
        """Children of each node in the order of their edges' first numbers, one after another."""
        m = len(first)
        order = np.lexsort((first[1:], self.parent[1:])) + 1
        self.kids = order
        self.kid_at = np.searchsorted(self.parent[order], np.arange(m + 1))

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Nodes as an Euler tour meets them, and the depth in words of each node. Children come by their edge's first number, 0
        always first, the others falling if so asked: leaves then come in the order of suffixes over the reversed alphabet.
        """
        kids, at = self.kids, self.kid_at
        if falling:
            rank = np.where(self.first == 0, 0, int(self.first.max()) + 1 - self.first)
            kids = np.lexsort((rank[1:], self.parent[1:])) + 1
        kids, lo, hi = kids.tolist(), at[:-1].tolist(), at[1:].tolist()
        width = (self.end - self.start).tolist()
        depth = [0] * len(lo)
        seen, stack, todo = [], [0], list(lo)
        while stack:
            v = stack[-1]
            seen.append(v)
            k = todo[v]
            if k < hi[v]:
                todo[v] = k + 1
                w = kids[k]
                depth[w] = depth[v] + width[w]
                stack.append(w)
            else:
                stack.pop()
        return np.array(seen, np.int64), np.array(depth, np.int64)


class Extensions:
    """Longest common extensions of pairs of suffixes, each a range minimum over the Euler tour of their tree.

    The tour is cut into blocks: minima to both ends of each block, a sparse table over whole blocks, and a scan within one.
    """

    BLOCK = 16

    def __init__(self, tree: SuffixTree, tour: np.ndarray, depth: np.ndarray):
        place = np.zeros(len(depth), np.int64)
        place[tour[::-1]] = np.arange(len(tour))[::-1]  # where each node is met first
        self.place = place[tree.leaf]
        pad = -len(tour) % self.BLOCK
        self.flat = np.append(depth[tour], np.full(pad, depth.max())).astype(np.int32)
        blocks = self.flat.reshape(-1, self.BLOCK)
        self.before, self.after = np.minimum.accumulate(blocks, 1).ravel(), np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
        self.levels = [blocks.min(1)]
        while 2 << len(self.levels) - 1 <= len(blocks):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers agree from i and from j on, for arrays of different places up to the length."""
        a, b = self.place[i], self.place[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        first, last = a // self.BLOCK, b // self.BLOCK
        out = np.minimum(self.after[a], self.before[b])
        one = np.flatnonzero(first == last)
        low, high = a[one], b[one]
        found = self.flat[high]
        for k in range(self.BLOCK - 1):
            found = np.minimum(found, self.flat[np.minimum(low + k, high)])
        out[one] = found
        many = last - first - 1  # whole blocks between
        level = np.frexp(np.maximum(many, 1).astype(float))[1] - 1
        for k in np.unique(level[many > 0]):
            own = np.flatnonzero((many > 0) & (level == k))
            row = self.levels[k]
            out[own] = np.minimum(out[own], np.minimum(row[first[own] + 1], row[last[own] - (1 << int(k))]))
        return out.astype(np.int64)
