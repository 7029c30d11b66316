"""SentencePiece encoding and decoding: N-best segmentation over the piece lattice."""

from __future__ import annotations

import gc
import heapq
import math
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from lodestone.llm.piece_paths import PieceTable
from lodestone.llm.rows import free_name

SPACE = "▁"
#: Segmentations that a task keeps, the first it meets; others are made again each time.
CACHED = 100_000
LONGEST_CACHED = 48
#: Texts whose segmentations are in memory at once; an Arrow batch may hold many more.
AT_ONCE = 512
#: Characters of texts whose chunks are segmented together (one text at least), and chunks on arrays at once.
CHARACTERS = 500_000
CHUNKS = 10_000
#: What an uncovered character costs more than the worst piece.
UNCOVERED = 10.0


class Vocabulary(NamedTuple):
    trie: dict  # by character: (the trie below, id and score of the piece that ends here, or None)
    behind: dict  # the same over the pieces' characters from last to first
    bytes_at: list[int]  # id of each byte's piece
    spelled: list[bytes]  # by id: a piece's bytes, none for marks
    bare: frozenset[int]  # ids of the bytes' pieces
    penalty: float
    chunk: str  # pattern of the chunks that no piece reaches across


def load(path: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model with pieces for all bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, spelled, order = {}, [], {}
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            order[int(piece[3:5], 16)] = k
            spelled.append(bytes.fromhex(piece[3:5]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            spelled.append(b"")
        else:
            pieces[piece] = (k, model.get_score(k))
            spelled.append(piece.replace(SPACE, " ").encode())
    if len(order) != 256:
        raise ValueError("the model has no pieces for all bytes")
    plain = list(pieces)
    alone = "".join(c for c in "\t\n\r" if not any(c in piece for piece in plain))
    behind = {piece[k] for piece in plain for k in range(1, len(piece)) if piece[k - 1].isalpha()}
    # Pieces hold the space mark only in front, so a lattice falls apart before each run of
    # marks; likewise between a letter and a sign that follows letters in no piece.
    if any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in plain):
        chunk = "(?s:.+)"
    else:
        signs = re.escape("".join(c for c in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~" if c not in behind) or SPACE)
        other = f"[^{SPACE}{alone}]"
        chunk = f"{SPACE}*{other}(?:[^{SPACE}{alone}{signs}]+|(?<![^\\W\\d_])[{signs}])*|{SPACE}+|[{alone or SPACE}]"
    penalty = min(score for _, score in pieces.values()) - UNCOVERED
    reverse = {piece[::-1]: found for piece, found in pieces.items()}
    return Vocabulary(_trie(pieces), _trie(reverse), [order[b] for b in range(256)], spelled, frozenset(order.values()), penalty, chunk)


#: What is below the last character of a piece that no other one goes on: one for all, as there are many.
LEAF: dict = {}


def _trie(pieces: dict[str, tuple[int, float]]) -> dict:
    root: dict = {}
    for piece in pieces:
        below = root
        for end, c in enumerate(piece, 1):
            node = below.get(c) or (LEAF, pieces.get(piece[:end]))
            if end < len(piece) and node[0] is LEAF:
                node = ({}, node[1])
            below[c] = node
            below = node[0]
    return root


def _lattice(chunk: str, words: Vocabulary) -> tuple[list[float], list[list]]:
    """The best score of every prefix, and the edges ``(start, piece, score)`` into its end."""
    length, root = len(chunk), words.trie
    best = [0.0] + [-1e300] * length
    into: list[list] = [[] for _ in range(length + 1)]
    for start in range(length):
        score, below, covered = best[start], root, False
        for end in range(start, length):
            node = below.get(chunk[end])
            if node is None:
                break
            below, piece = node
            if piece is not None:
                number, gain = piece
                into[end + 1].append((start, number, gain))
                if score + gain > best[end + 1]:
                    best[end + 1] = score + gain
                if end == start:
                    covered = True
            if not below:
                break
        if not covered:
            into[start + 1].append((start, -1 - start, words.penalty))
            if score + words.penalty > best[start + 1]:
                best[start + 1] = score + words.penalty
    return best, into


def _spelled(path: tuple | None, chunk: str, words: Vocabulary) -> tuple[int, ...]:
    """The ids of a path, first to last; characters without a piece in bytes."""
    ids: list[int] = []
    while path is not None:
        piece, path = path
        if piece >= 0:
            ids.append(piece)
        else:
            ids.extend(words.bytes_at[b] for b in chunk[-1 - piece].encode("utf-8", "surrogatepass"))
    return tuple(ids)


def _best(chunk: str, words: Vocabulary) -> list[float]:
    """The best score of every prefix."""
    length, root, penalty = len(chunk), words.trie.get, words.penalty
    best = [0.0] + [-1e300] * length
    for start in range(length):
        score, node = best[start], root(chunk[start])
        end = start + 1
        if node is None or node[1] is None:
            if score + penalty > best[end]:
                best[end] = score + penalty
            if node is None:
                continue
        below, piece = node
        while True:
            if piece is not None:
                reach = score + piece[1]
                if reach > best[end]:
                    best[end] = reach
            if not below or end == length:
                break
            node = below.get(chunk[end])
            if node is None:
                break
            below, piece = node
            end += 1
    return best


def first_path(chunk: str, words: Vocabulary) -> tuple[float, tuple[int, ...], float | None]:
    """What ``ranked_paths`` gives first. No path has to wait for that, only the best bound is kept.

    Edges are looked up at the path's own places only, from each place to the left.
    """
    place, score, path, following = len(chunk), 0.0, None, None
    best, root, penalty = _best(chunk, words), words.behind.get, words.penalty
    reachable = best[place]
    while place:
        # The best edge with the smallest start is taken; edges come with falling starts.
        chosen, start = None, place - 1
        node = root(chunk[start])
        if node is None or node[1] is None:
            reach = best[start] + (score + penalty)
            if reach == reachable:
                chosen = (start, -1 - start, penalty)
            elif following is None or reach > following:
                following = reach
        while node is not None:
            below, piece = node
            if piece is not None:
                reach = best[start] + (score + piece[1])
                if reach == reachable:
                    if chosen is not None:
                        following = reach
                    chosen = (start, *piece)
                elif following is None or reach > following:
                    following = reach
            if not below or not start:
                break
            start -= 1
            node = below.get(chunk[start])
        if chosen is None:  # sums of the other order differ in their last digit
            return next(ranked_paths(chunk, words))
        place, piece, gain = chosen
        score, path = score + gain, (piece, path)
    return score, _spelled(path, chunk, words), following


def ranked_paths(chunk: str, words: Vocabulary, several: bool = True) -> Iterator[tuple[float, tuple[int, ...], float | None]]:
    """All ways to cut ``chunk`` into pieces, best first: ``(score, ids, score of the next)``.

    A forward Viterbi pass gives the best score of every prefix. A* then grows paths from
    the end to the start; a path's own score plus the best score of what is left to its
    left is exactly what it can reach, so paths come out in order, and the best bound
    that waits is the next path's score. A character without a piece is an edge of its
    own, spelled in bytes. Unless ``several``, only the best way comes.
    """
    length = len(chunk)
    best, into = _lattice(chunk, words)
    heap, count = [(-best[length], 0, length, 0.0, None)], 0
    while heap:
        bound, _, place, score, path = heapq.heappop(heap)
        reachable = -bound
        # Follow the best edge at once; only the others wait their turn.
        while place:
            chosen = None
            for start, piece, gain in into[place]:
                reach = best[start] + (score + gain)
                if chosen is None and reach == reachable:
                    chosen = (start, score + gain, (piece, path))
                elif several:
                    count += 1
                    heapq.heappush(heap, (-reach, count, start, score + gain, (piece, path)))
            if chosen is None:  # sums of the other order differ in their last digit; the paths wait under their own
                break
            place, score, path = chosen
        if place:
            continue
        yield score, _spelled(path, chunk, words), -heap[0][0] if heap else None
        if not several:
            return


def segmentations(chunk: str, words: Vocabulary, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best ways to cut ``chunk`` into pieces, best first: ``(score, ids)``."""
    return [(score, ids) for score, ids, _ in islice(ranked_paths(chunk, words, n > 1), n)]


class _Known(dict):
    """Segmented chunks: ``(ids as bytes, best score, loss of the second best, the chunk)``.

    ``passing`` has those of the texts at hand that are more than a task keeps.
    """

    def __init__(self, words: Vocabulary, n: int):
        super().__init__()
        self.words, self.n, self.passing = words, n, {}

    def learn(self, chunks: set[str], table: PieceTable) -> None:
        """Segment chunks together; what ``table`` leaves out, and long ones, are done when they are asked for."""
        new, self.passing = [c for c in chunks if c not in self and len(c) <= LONGEST_CACHED], {}
        for at in range(0, len(new), CHUNKS):
            some = new[at : at + CHUNKS]
            for chunk, found in zip(some, table.first_paths(some)):
                if found:
                    score, ids, following = found
                    (self if len(self) < CACHED else self.passing)[chunk] = (ids, score, score - following, chunk)

    def __missing__(self, chunk: str) -> tuple:
        entry = self.passing.get(chunk)
        if entry:
            return entry
        score, ids, following = first_path(chunk, self.words)
        entry = (array("i", ids).tobytes(), score, math.inf if following is None else score - following, chunk)
        if len(self) < CACHED and len(chunk) <= LONGEST_CACHED:
            self[chunk] = entry
        return entry


class _Grown(dict):
    """The ``n`` best ways to cut a chunk, grown by A*, best first: ``(loss, ids as bytes, whether they spell the chunk)``."""

    def __init__(self, words: Vocabulary, n: int):
        super().__init__()
        self.words, self.n = words, n

    def __missing__(self, chunk: str) -> list[tuple[float, bytes, bool]]:
        found, spelled = segmentations(chunk, self.words, self.n), self.words.spelled
        plain = chunk.replace(SPACE, " ").encode("utf-8", "surrogatepass")
        entry = [(found[0][0] - score, array("i", ids).tobytes(), b"".join(map(spelled.__getitem__, ids)) == plain) for score, ids in found]
        if len(self) < CACHED and len(chunk) <= LONGEST_CACHED:
            self[chunk] = entry
        return entry


class Encoder:
    """Encodes whole texts; chunks that come up again are not segmented again."""

    def __init__(self, words: Vocabulary, n: int = 1, table: PieceTable | None = None):
        self.words, self.n, self.known, self.grown = words, n, _Known(words, n), _Grown(words, n)
        self.table = table or PieceTable(words.trie, words.penalty)
        self.cut = re.compile(words.chunk).findall
        self.mark = tuple(words.bytes_at[b] for b in SPACE.encode())

    def cuts(self, text: str) -> Iterator[list[str] | None]:
        """Lists of the text's chunks; None stands for a space mark in the text itself, which is spelled in bytes."""
        for number, part in enumerate(text.split(SPACE)):
            if number:
                yield None
            # As the model does, a space mark goes before the text.
            yield self.cut(("" if number else SPACE) + part.replace(" ", SPACE))

    def chunks(self, text: str) -> list[tuple]:
        """The text's chunks, segmented, as ``_Known`` has them."""
        return self._segmented(self.cuts(text)) if text else []

    def chunks_of(self, texts: list[str | None]) -> Iterator[tuple[str | None, list[tuple]]]:
        """Every text with its ``chunks``; those of several texts are segmented together."""
        at = 0
        while at < len(texts):
            cuts, size = [], 0
            while at + len(cuts) < len(texts) and size < CHARACTERS:
                text = texts[at + len(cuts)] or ""
                cuts.append(list(self.cuts(text)) if text else [])
                size += len(text)
            self.known.learn({chunk for lists in cuts for cut in lists if cut for chunk in cut}, self.table)
            for text, lists in zip(texts[at : at + len(cuts)], cuts):
                yield text, self._segmented(lists)
            at += len(cuts)

    def _segmented(self, cuts: Iterable[list[str] | None]) -> list[tuple]:
        out: list[tuple] = []
        for cut in cuts:
            if cut is None:
                out.append((array("i", self.mark).tobytes(), self.words.penalty, math.inf, SPACE))
            else:
                out += map(self.known.__getitem__, cut)
        return out

    def ranked(self, lists: list[tuple]) -> list[tuple[float, bytes, bool]]:
        """The ``n`` best segmentations of a text's ``chunks``, best first: ``(score, ids as bytes, like the best)``.

        Chunks are independent, so the n best take their alternatives from the at most
        ``n - 1`` chunks whose second choice costs least; only those are grown further. The
        last value tells that every alternative spells its chunk, so that a segmentation
        decodes to the text if the best one does.
        """
        score = sum(map(itemgetter(1), lists))
        ids = list(map(itemgetter(0), lists))
        losses = list(map(itemgetter(2), lists))
        cheap = heapq.nsmallest(self.n - 1, range(len(losses)), key=losses.__getitem__)
        cheap = [k for k in cheap if losses[k] < math.inf]
        ways = {k: self.grown[lists[k][3]] for k in cheap}
        plans = [(0.0, {})]
        for k in cheap:
            plans = heapq.nsmallest(
                self.n, ((loss + more, plan | {k: j}) for loss, plan in plans for j, (more, _, _) in enumerate(ways[k])), key=lambda x: x[0]
            )
        out = []
        for loss, plan in plans:
            for k, j in plan.items():
                ids[k] = ways[k][j][1]
            out.append((score - loss, b"".join(ids), all(ways[k][j][2] for k, j in plan.items())))
        return out

    def n_best(self, text: str) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of the whole text, best first."""
        return [(score, np.frombuffer(ids, np.int32).tolist()) for score, ids, _ in self.ranked(self.chunks(text))]


def decode(ids: list[int], words: Vocabulary) -> str:
    """The text of piece ids; undoes every segmentation."""
    data = b"".join(map(words.spelled.__getitem__, ids))
    if data[:1] == b" " and ids[0] not in words.bare:
        data = data[1:]
    return data.decode("utf-8", "surrogatepass")


FOUND = ["ids", "score", "second", "others", "same"]


def _segmented(encoder: Encoder, column: pa.Array) -> pa.Array:
    words = encoder.words
    ids, scores, seconds, same = [], [], [], []
    starts, next_ids, next_scores = [], [], []
    for content, chunks in encoder.chunks_of(column.to_pylist()):
        if content is None:
            ids.append(None), scores.append(None), seconds.append(None), same.append(None), starts.append(None)
            continue
        (score, best, _), *following = encoder.ranked(chunks)
        best = np.frombuffer(best, np.int32)
        following = [(x, np.frombuffer(other, np.int32), alike) for x, other, alike in following]
        starts.append(len(next_ids))
        ids.append(best)
        scores.append(score)
        seconds.append(following[0][0] if following else None)
        back = decode(best.tolist(), words) == content
        same.append(back and all(alike or decode(other.tolist(), words) == content for _, other, alike in following))
        next_ids += [other for _, other, _ in following]
        next_scores += [x for x, _, _ in following]
    arrays = [pa.array(ids, pa.list_(pa.int32())), pa.array(scores, pa.float64()), pa.array(seconds, pa.float64())]
    pairs = pa.StructArray.from_arrays([pa.array(next_ids, pa.list_(pa.int32())), pa.array(next_scores, pa.float64())], ["ids", "score"])
    others = pa.ListArray.from_arrays(pa.array([*starts, len(next_ids)], pa.int32()), pairs)
    return pa.StructArray.from_arrays([*arrays, others, pa.array(same, pa.bool_())], FOUND)


def _in_slices(encoder: Encoder, columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts' segmentations, ``AT_ONCE`` texts at a time. What Arrow frees goes back at once, as an executor has several such processes."""
    pool = pa.default_memory_pool()
    for column in columns:
        for at in range(0, max(1, len(column)), AT_ONCE):
            pool.release_unused()
            yield _segmented(encoder, column.slice(at, AT_ONCE))


def encode(docs: DataFrame, path: str, n: int = 1, text: str = "text") -> DataFrame:
    """``docs`` with ``piece_ids`` of the best segmentation, ``piece_score``, ``next_score``, ``next_best`` and ``decodes``.

    ``next_best`` has the ids and score of the second to the n-th best segmentation, best
    first, as far as there are so many; ``next_score`` is the first of these scores, null
    if there is none. ``decodes`` tells that the ids of each segmentation give back the
    text. A null text has null ids, an empty one none. An empty table gives no rows;
    columns of these names are replaced, all others stay.
    """
    words = load(path)
    table = PieceTable(words.trie, words.penalty)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gc.collect()
        gc.freeze()  # else every collection walks the vocabulary
        gc.disable()  # nothing here refers back to itself
        try:
            yield from _in_slices(Encoder(words, n, table), columns)
        finally:
            gc.enable()
            gc.unfreeze()
            pa.default_memory_pool().release_unused()

    new = ("piece_ids", "piece_score", "next_score", "next_best", "decodes")
    columns, made = [F.col(f"`{c}`") for c in docs.columns if c not in new], free_name(docs, "_found")
    kind = "ids array<int>, score double, second double, others array<struct<ids: array<int>, score: double>>, same boolean"
    found = docs.select(*columns, F.arrow_udf(run, kind)(F.col(text).cast("string")).alias(made))
    return found.select(*columns, *(F.col(f"{made}.{old}").alias(name) for old, name in zip(FOUND, new)))
