"""Suffix trees of whole-number sequences and constant-time longest common extensions."""

from __future__ import annotations

from array import array

import numpy as np


class SuffixTree:
    """Ukkonen's tree of ``text``, whole numbers from 1, closed by a 0 of its own.

    The tree is built left to right in one pass. An edge is found by its node and first
    symbol in one table; nodes are flat arrays. Symbols should be dense, as the key of
    an edge is node times the alphabet's size plus symbol.
    """

    def __init__(self, text: np.ndarray):
        self.symbols = int(text.max(initial=0)) + 1
        self.text = [*text.tolist(), 0]
        self._grow()

    def _grow(self) -> None:
        text, width = self.text, self.symbols
        total = len(text)
        starts, ends, link, leaf_of = array("q", [0]), array("q", [0]), array("q", [0]), array("q")
        edges: dict[int, int] = {}
        # The active point: a node, the edge that starts with text[first], and a length on it.
        node, first, length, waiting = 0, 0, 0, 0
        for at, symbol in enumerate(text):
            waiting += 1
            unlinked = 0
            while waiting:
                if not length:
                    first = at
                key = node * width + text[first]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(starts)
                    leaf_of.append(len(starts))
                    starts.append(at)
                    ends.append(total)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = node
                        unlinked = 0
                else:
                    start = starts[child]
                    reach = (ends[child] if ends[child] < at else at) - start
                    if length >= reach > 0:
                        node, first, length = child, first + reach, length - reach
                        continue
                    if text[start + length] == symbol:
                        if unlinked:
                            link[unlinked] = node
                        length += 1
                        break
                    # The edge is cut, and a leaf put beside its rest.
                    inner = len(starts)
                    starts.append(start)
                    ends.append(start + length)
                    link.append(0)
                    edges[key] = inner
                    starts[child] = start + length
                    edges[inner * width + text[start + length]] = child
                    edges[inner * width + symbol] = inner + 1
                    leaf_of.append(inner + 1)
                    starts.append(at)
                    ends.append(total)
                    link.append(0)
                    if unlinked:
                        link[unlinked] = inner
                    unlinked = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    first = at - waiting + 1
        self.starts, self.ends = np.array(starts), np.array(ends)
        self.leaf_of = np.array(leaf_of)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.parent, self.symbol = keys // width, keys % width
        self.child = np.fromiter(edges.values(), np.int64, len(edges))

    def tour(self, falling: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of an Euler tour, and the depth of the shallowest node on the
        way from each to the next: the length of their common prefix.

        Children are visited by symbol, or by falling symbol; the closing 0 comes first in both.
        """
        order = np.lexsort((np.where(self.symbol == 0, -self.symbols, -self.symbol) if falling else self.symbol, self.parent))
        child = self.child[order].tolist()
        bounds = np.searchsorted(self.parent[order], np.arange(len(self.starts) + 1)).tolist()
        lengths = (self.ends - self.starts).tolist()
        suffix = np.full(len(self.starts), -1, np.int64)
        suffix[self.leaf_of] = np.arange(len(self.leaf_of))
        suffix = suffix.tolist()
        suffixes, between, shallowest = [], [], 0
        todo = [(0, 0, -1)]  # node, depth, depth of its parent unless it is the first child
        while todo:
            node, depth, turned = todo.pop()
            if turned >= 0:
                shallowest = turned
            if suffix[node] >= 0:
                suffixes.append(suffix[node])
                between.append(shallowest)
                continue
            low, high = bounds[node], bounds[node + 1]
            for k in range(high - 1, low - 1, -1):
                todo.append((child[k], depth + lengths[child[k]], depth if k > low else -1))
        return np.array(suffixes), np.array(between[1:], np.int64)


class Extensions:
    """Common prefixes of any two suffixes, from the lowest common ancestor of their leaves.

    The ancestor is the shallowest node between two leaves on the tour; a table of minima
    over spans of every power of two finds its depth with two reads.
    """

    def __init__(self, tree: SuffixTree):
        suffixes, depths = tree.tour()
        self.rank = np.empty(len(suffixes), np.int64)
        self.rank[suffixes] = np.arange(len(suffixes))
        self.table = [depths.astype(np.int32)]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            last, step = self.table[-1], 1 << (len(self.table) - 1)
            self.table.append(np.minimum(last[:-step], last[step:]))

    def common(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes ``one`` and ``two``, never equal ones."""
        low, high = np.minimum(self.rank[one], self.rank[two]), np.maximum(self.rank[one], self.rank[two])
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            table = self.table[k]
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << int(k))])
        return out
