"""A compressed radix trie of byte strings whose terminal nodes know their owner."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Generic, TypeVar

Held = TypeVar("Held")

#: Bytes that a node is taken to need beside its label.
NODE = 400


class Node(Generic[Held]):
    __slots__ = ("label", "below", "held", "spilled")

    def __init__(self, label: bytes):
        self.label, self.below, self.held, self.spilled = label, None, None, False


def shared(label: bytes, text: bytes, at: int) -> int:
    """Bytes that ``label`` has in common with ``text`` from ``at`` on."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Trie(Generic[Held]):
    """Whole strings from a root down; an edge's label is cut only where strings part.

    ``weight`` is about the memory that the trie takes. ``spill`` gives up its heaviest
    subtree; strings that lead there from then on are turned away.
    """

    def __init__(self):
        self.root: Node[Held] = Node(b"")
        self.weight = NODE

    def find(self, text: bytes) -> Node[Held] | None:
        """The terminal node of ``text``, made if new; nothing if its subtree was given up."""
        node, at = self.root, 0
        while at < len(text):
            if node.below is None:
                node.below = {}
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
                self.weight += NODE + len(text) - at
                return child
            if text.startswith(child.label, at):
                if child.spilled:
                    return None
                node, at = child, at + len(child.label)
                continue
            cut = shared(child.label, text, at)
            inner: Node[Held] = Node(child.label[:cut])
            inner.below = {child.label[cut]: child}
            node.below[text[at]] = inner
            child.label = child.label[cut:]
            self.weight += NODE
            node, at = inner, at + cut
        return node

    def _walk(self, node: Node[Held], path: bytes) -> Iterator[tuple[bytes, Held]]:
        todo = [(node, path)]
        while todo:
            here, text = todo.pop()
            if here.held is not None:
                yield text, here.held
            for child in (here.below or {}).values():
                if not child.spilled:
                    todo.append((child, text + child.label))

    def items(self) -> Iterator[tuple[bytes, Held]]:
        """Every string that is still held, with what its terminal node holds."""
        return self._walk(self.root, b"")

    @staticmethod
    def _size(node: Node[Held]) -> int:
        total, todo = 0, [node]
        while todo:
            here = todo.pop()
            total += NODE + len(here.label)
            todo += [c for c in (here.below or {}).values() if not c.spilled]
        return total

    def spill(self) -> list[tuple[bytes, Held]]:
        """Give up the heaviest subtree below the first node where held strings part.

        Something always stays: a trie that holds one string gives up nothing.
        """
        node, path = self.root, b""
        while True:
            open_ = [c for c in (node.below or {}).values() if not c.spilled]
            if len(open_) > 1 or (open_ and node.held is not None):
                break
            if not open_:
                return []
            node, path = open_[0], path + open_[0].label
        heaviest = max(open_, key=self._size)
        self.weight -= self._size(heaviest) - NODE - len(heaviest.label)
        out = list(self._walk(heaviest, path + heaviest.label))
        heaviest.spilled, heaviest.below, heaviest.held = True, None, None
        return out
