"""Best paths of many chunks at once: the search of ``pieces.first_path`` on arrays."""

from __future__ import annotations

import numpy as np

#: An edge of a character without a piece.
UNCOVERED = -2


class PieceTable:
    """A vocabulary's trie as sorted keys of (node, character), with the piece that ends at each node."""

    def __init__(self, trie: dict, penalty: float):
        nodes, above, characters, pieces, gains = [trie], [], [], [-1], [0.0]
        for number, below in enumerate(nodes):  # grows while it is walked
            for character, (further, piece) in below.items():
                nodes.append(further)
                above.append(number)
                characters.append(ord(character))
                pieces.append(-1 if piece is None else piece[0])
                gains.append(0.0 if piece is None else piece[1])
        self.letters, letter = np.unique(np.array(characters, np.uint32), return_inverse=True)
        key = np.array(above, np.int64) * len(self.letters) + letter
        order = np.argsort(key)
        self.keys, self.nodes = key[order], (order + 1).astype(np.int32)
        self.pieces, self.gains, self.penalty = np.array(pieces, np.int32), np.array(gains), penalty

    def below(self, node: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The nodes one letter further, -1 where there is none."""
        key = node.astype(np.int64) * len(self.letters) + letter
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((letter >= 0) & (self.keys[at] == key), self.nodes[at], np.int32(-1))

    def edges(self, letter: np.ndarray, left: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length, the places where pieces of that length begin, and their nodes.

        ``left`` tells how many characters a place's chunk has from there. A character
        without a piece of its own is an edge, too, at node 0.
        """
        place, node, out = np.arange(len(letter)), np.zeros(len(letter), np.int32), []
        while len(place):
            node = self.below(node, letter[place + len(out)])
            ends = (node >= 0) & (self.pieces[node] >= 0)
            if out:
                out.append((place[ends], node[ends]))
            else:
                out.append((place, np.where(ends, node, np.int32(0))))
            on = (node >= 0) & (left[place] > len(out))
            place, node = place[on], node[on]
        return out

    def first_paths(self, chunks: list[str]) -> list[tuple[float, bytes, float] | None]:
        """``(score, ids as bytes, score of the second best or -inf)`` of each chunk, none of them empty.

        Sums are made in the order of ``first_path``, so scores are the same to the last digit. None
        stands for a chunk whose best path has a character without a piece, or whose sums differ.
        """
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        first = np.cumsum(size) - size
        code = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = np.minimum(np.searchsorted(self.letters, code), len(self.letters) - 1)
        letter = np.where(self.letters[letter] == code, letter, -1)
        within = np.arange(len(code)) - np.repeat(first, size)
        edges = self.edges(letter, np.repeat(size, size) - within)
        # Prefixes of a chunk have one place more than its characters.
        chunk = np.repeat(np.arange(len(chunks)), size)
        best = np.full(len(code) + len(chunks), -1e300)
        best[first + np.arange(len(chunks))] = 0.0
        self._forward(edges, within, chunk, best)
        # By length, the node of the edge that begins at a place, -1 for none.
        begins = np.full((len(edges), len(best)), -1, np.int32)
        for length, (place, node) in enumerate(edges):
            begins[length, place + chunk[place]] = node
        return self._backward(begins, best, first + np.arange(len(chunks)), size)

    def _forward(self, edges: list, within: np.ndarray, chunk: np.ndarray, best: np.ndarray) -> None:
        """Best scores of all prefixes: places of all chunks from left to right."""
        steps = []
        for length, (place, node) in enumerate(edges, 1):
            order = np.argsort(within[place], kind="stable")
            place, node = place[order], node[order]
            gain = np.where(node > 0, self.gains[node], self.penalty)
            steps.append((place + chunk[place], gain, length, np.searchsorted(within[place], np.arange(int(within.max()) + 2))))
        for at in range(int(within.max()) + 1):
            for place, gain, length, bounds in steps:
                some = place[bounds[at] : bounds[at + 1]]
                if len(some):
                    # One edge of a length goes out from a place, so ends differ.
                    best[some + length] = np.maximum(best[some + length], best[some] + gain[bounds[at] : bounds[at + 1]])

    def _backward(self, begins: np.ndarray, best: np.ndarray, start: np.ndarray, size: np.ndarray) -> list:
        """Best paths from their ends, and the best bound of the edges beside them."""
        n = len(start)
        place, score, second, sound = start + size, np.zeros(n), np.full(n, -np.inf), np.ones(n, bool)
        reachable, active, taken = best[place], np.arange(n), []
        while len(active):
            end, own, goal, other = place[active], score[active], reachable[active], second[active]
            chosen, gained = np.full(len(active), -1, np.int32), np.zeros(len(active))
            span = np.zeros(len(active), np.int64)
            for length in range(1, len(begins) + 1):
                near = np.flatnonzero(end - start[active] >= length)
                node = begins[length - 1, end[near] - length]
                near, node = near[node >= 0], node[node >= 0]
                if not len(near):
                    continue
                total = own[near] + np.where(node > 0, self.gains[node], self.penalty)
                reach = best[end[near] - length] + total
                hit = reach == goal[near]
                # Of equal edges the one with the smallest start is taken; the others wait.
                beside = ~hit | (chosen[near] >= 0)
                other[near[beside]] = np.maximum(other[near[beside]], reach[beside])
                chosen[near[hit]], gained[near[hit]], span[near[hit]] = node[hit], total[hit], length
            second[active] = other
            found = chosen > 0
            sound[active[~found]] = False
            active, chosen = active[found], chosen[found]
            score[active], place[active] = gained[found], end[found] - span[found]
            taken.append((active, self.pieces[chosen]))
            active = active[place[active] > start[active]]
        owner = np.concatenate([a for a, _ in taken[::-1]])
        order = np.argsort(owner, kind="stable")
        ids = np.concatenate([p for _, p in taken[::-1]])[order].astype(np.int32).tobytes()
        ends = 4 * np.cumsum(np.bincount(owner, minlength=n))
        out, begin = [], 0
        for end, s, follow, good in zip(ends.tolist(), score.tolist(), second.tolist(), sound.tolist()):
            out.append((s, ids[begin:end], follow) if good else None)
            begin = end
        return out
