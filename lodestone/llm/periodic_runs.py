"""Maximal periodic runs of words, from suffix trees and Lyndon roots."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from lodestone.llm.rows import boxed, unboxed
from lodestone.llm.suffix_tree import Extensions, SuffixTree

RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
RESULTS = ("n_words", "runs", "strongest", "collapsed")
ODD = np.uint64(0x9E3779B97F4A7C15)


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For every suffix the next one to its right that sorts before it."""
    out = np.empty(len(rank), np.int64)
    values, open_ = rank.tolist(), []
    for at in range(len(values)):
        here = values[at]
        while open_ and values[open_[-1]] > here:
            out[open_.pop()] = at
        open_.append(at)
    out[open_] = len(values)
    return out[:-1]


def all_runs(text: np.ndarray, least_length: int, least_exponent: int) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of ``text`` (whole numbers from 1), by start and period.

    The longest Lyndon word at a place, under one of the two orders of the alphabet, is the
    root of every run. Each root is extended to the right by the common prefix of the places
    where it begins and ends, and to the left by that of the reversed text.
    """
    n = len(text)
    tree = SuffixTree(text)
    forth, back = Extensions(tree), Extensions(SuffixTree(text[::-1]))
    places = np.arange(n)
    falling = np.empty(n + 1, np.int64)
    falling[tree.tour(falling=True)[0]] = np.arange(n + 1)
    found = []
    for rank in (forth.rank, falling):
        after = next_smaller(rank)
        roots = (after < n) & (least_exponent * (after - places) <= n)
        one, two = places[roots], after[roots]
        left = back.common(n - one, n - two)
        start, end = one - left, two + forth.common(one, two)
        found.append(np.stack([start, end - start, two - one], axis=1))
    runs = np.unique(np.concatenate(found), axis=0)
    runs = runs[runs[:, 1] >= np.maximum(least_length, least_exponent * runs[:, 2])]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def stretches(marks: np.ndarray, least_length: int, least_exponent: int) -> list[tuple[int, int]]:
    """Stretches outside which no run can reach, from 64-bit marks of the words.

    In a run of ``length`` and period q, ``length - q`` words in a row equal those q further,
    so it is covered by word groups of that size, each of which occurs twice. Groups are
    compared by hashes: equal groups have equal ones, and a chance match only costs time.
    """
    q = least_length // least_exponent
    size = max(1, min(least_length - q, (least_exponent - 1) * (q + 1)))
    n = len(marks) - size + 1
    if n < 2:
        return []
    h = marks[:n].copy()
    for k in range(1, size):
        h = (h ^ (h >> np.uint64(29))) * ODD + marks[k : k + n]
    order = np.argsort(h)
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return []
    edges = np.zeros(len(marks) + 1, np.int64)
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    inside = np.concatenate([[0], (np.cumsum(edges)[:-1] > 0).astype(np.int8), [0]])
    turns = np.flatnonzero(np.diff(inside)).reshape(-1, 2)
    return [(int(a), int(b)) for a, b in turns if b - a >= least_length]


def runs_of(words: Sequence[bytes], least_length: int, least_exponent: int) -> list[tuple[int, int, int]]:
    """All runs of a document's words as ``(start, length, period)``."""
    if len(words) < least_length:
        return []
    marks = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    out = []
    for low, high in stretches(marks, least_length, least_exponent):
        known: dict[bytes, int] = {}
        text = np.array([known.setdefault(w, len(known) + 1) for w in words[low:high]])
        out += [(low + s, n, q) for s, n, q in all_runs(text, least_length, least_exponent).tolist()]
    return out


def stronger(a: tuple[int, int, int], b: tuple[int, int, int]) -> int:
    """Negative if ``a`` has the greater exact exponent; ties by start, then period."""
    x, y = b[1] * a[2] - a[1] * b[2], (a[0], a[2])
    return x or (-1 if y < (b[0], b[2]) else 1)


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words outside runs and those of each run's first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep).tolist()])


def periodic_runs(
    docs: DataFrame, text: str = "text", least_length: int = 24, least_exponent: int = 3, columns: Sequence[str] | None = None
) -> DataFrame:
    """Every row with ``n_words``, ``runs``, the ``strongest`` run and the ``collapsed`` text.

    Words are stretches without ASCII blanks. A run is a stretch of words with smallest
    period q, of at least ``least_length`` words and ``least_exponent`` times q, that no
    neighbouring word extends. ``runs`` is an array of ``(start, length, period)`` by start
    and period; ``strongest`` has the greatest length for its period (ties: smallest start,
    then period; null without runs). ``collapsed`` holds all words that no run has after its
    first q, joined by blanks. ``least_exponent`` is 2 at least.

    No shuffle: documents are worked on one by one. Memory follows the longest stretch of a
    document whose word groups repeat (about half a kilobyte a word), not the document.
    Null, empty and blank texts have no words and an empty collapsed text; repeated rows
    stay; an empty table gives no rows. Columns named in ``columns`` (default: all) come
    with each row, except that results replace columns of their names.
    """
    if least_exponent < 2 or least_length < 2:
        raise ValueError("least_length and least_exponent are 2 at least")
    box = boxed(docs, columns, RESULTS)
    rows = docs.select(box.alias("box"), F.col(f"`{text}`").cast("string").cast("binary").alias("body"))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    schema = T.StructType(
        [
            rows.schema["box"],
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("strongest", RUN),
            T.StructField("body", T.BinaryType()),
        ]
    )
    arrow_run = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, runs, best, texts = [], [], [], []
            for body in batch.column(1):
                words = (body.as_py() or b"").split()  # at 0x20 and 0x09 to 0x0D
                found = runs_of(words, least_length, least_exponent)
                counts.append(len(words))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                top = min(found, key=cmp_to_key(stronger), default=None)
                best.append(top and dict(zip(("start", "length", "period"), top)))
                texts.append(collapsed(words, found))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(runs, pa.list_(arrow_run)),
                    pa.array(best, arrow_run),
                    pa.array(texts, pa.binary()),
                ],
                names=["box", "n_words", "runs", "strongest", "body"],
            )

    found = rows.mapInArrow(work, schema).withColumn("collapsed", F.col("body").cast("string"))
    return unboxed(found.withColumn("runs", F.col("runs").cast(f"array<{run}>")), "box", RESULTS)
