"""Removal of repeated byte strings with suffix arrays over content-dealt shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.suffix_sort import permuted_common_prefixes, suffix_array
from lodestone.operators.skew import FEW_SALTS, salted_join
from lodestone.session import discard, durable

#: Bytes of an anchor. Every window is dealt by the anchor of smallest hash in it.
ANCHOR = 32
#: Text that is hashed at once, and text that one suffix array holds (a longer group makes a longer one).
CHUNK = 1 << 20
SHARD = 1 << 20
#: Anchors with more distinct surroundings are settled window by window.
HOT = 20_000
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
LAST = 2**63 - 1


def _doc(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    steps = np.full(n + 1, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps)


class Hashes:
    """Hashes of all strings of a text from running sums, modulo 2**64."""

    def __init__(self, which: int, longest: int):
        base = BASES[which]
        self.table = _mixed(np.arange(1, 257, dtype=np.uint64) * BASES[1 - which])
        self.grow(base, longest)
        self.base = base

    def grow(self, base: np.uint64, longest: int) -> None:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        self.up, self.down = _powers(base, longest), _powers(inverse, longest)

    def read(self, data: np.ndarray) -> None:
        if len(data) >= len(self.up):
            self.grow(self.base, 2 * len(data))
        self.sums = np.r_[np.uint64(0), np.cumsum(self.table[data] * self.up[: len(data)])]

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def _last_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """For every start, the place of the smallest of ``width`` values; of equal ones the last."""
    best, place, held = values, np.arange(len(values)), 1
    while held < width:
        step = min(held, width - held)
        right = best[step:] <= best[: len(best) - step]
        place = np.where(right, place[step:], place[: len(place) - step])
        best = np.where(right, best[step:], best[: len(best) - step])
        held += step
    return place


def find_anchors(data: np.ndarray, ends: np.ndarray, width: int, hashes: list[Hashes]) -> dict[str, np.ndarray]:
    """Runs of windows with one anchor, over documents laid end to end.

    For every run: the document's number, the first and last start of its windows in that
    document, the anchor's distance from the first start, the anchor's hash ``h`` and the
    hash ``r`` of all bytes that the run's windows cover with the anchor's place in them.
    """
    names = ("document", "first", "last", "off", "h", "r")
    n = len(data)
    if n < width:
        return {name: np.zeros(0, np.int64) for name in names}
    for one in hashes:
        one.read(data)
    at = np.arange(n - ANCHOR + 1)
    grams = _mixed(hashes[0].of(at, at + ANCHOR))
    anchor = _last_smallest(grams, width - ANCHOR + 1)[: n - width + 1]
    starts = np.arange(n - width + 1)
    document = np.searchsorted(ends, starts, side="right")
    inside = starts + width <= ends[document]
    starts, anchor, document = starts[inside], anchor[inside], document[inside]
    if not len(starts):
        return {name: np.zeros(0, np.int64) for name in names}
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1])]
    head = np.flatnonzero(new)
    tail = np.r_[head[1:], len(starts)] - 1
    first, last, p, d = starts[head], starts[tail], anchor[head], document[head]
    off = p - first
    r = _mixed(hashes[1].of(first, last + width) + _mixed((off * 4096 + (last - first)).astype(np.uint64)))
    begin = np.r_[0, ends][d]
    return dict(zip(names, (d, first - begin, last - begin, off, grams[p].view(np.int64), r.view(np.int64))))


def _runs(document: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """``(document, start, end)`` of the bytes under runs of windows, with touching ones joined."""
    if not len(first):
        return np.zeros((0, 3), np.int64)
    order = np.lexsort((first, document))
    document, first, end = document[order], first[order], last[order] + width
    new = np.r_[True, (document[1:] != document[:-1]) | (first[1:] > end[:-1])]
    head = np.flatnonzero(new)
    return np.stack([document[head], first[head], np.maximum.reduceat(end, head)], axis=1)


def anchors(docs: DataFrame, width: int) -> DataFrame:
    """``(h, r, doc, mark, first, last, off)`` for all runs of windows of all texts.

    Of runs that repeat within a document only the first is kept; the bytes of the others
    come as rows with a null ``off``, from ``first`` to ``last``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = [Hashes(0, CHUNK), Hashes(1, CHUNK)]
        held, size = [], 0

        def found() -> pa.RecordBatch:
            data = np.frombuffer(b"".join(text for _, _, text in held), np.uint8)
            ends = np.cumsum([len(text) for _, _, text in held])
            a = find_anchors(data, ends, width, hashes)
            order = np.lexsort((a["first"], a["r"], a["h"], a["document"]))
            a = {name: values[order] for name, values in a.items()}
            again = np.zeros(len(order), bool)
            if len(order):
                again[1:] = np.logical_and.reduce([a[c][1:] == a[c][:-1] for c in ("document", "h", "r")])
            own = _runs(a["document"][again], a["first"][again], a["last"][again], width)
            a = {name: values[~again] for name, values in a.items()}
            d = np.concatenate([a["document"], own[:, 0]]).astype(np.int64)
            doc = np.array([x[0] for x in held], np.int64)[d]
            mark = np.array([x[1] for x in held], np.int32)[d]
            # Rows of the second kind are spread by their document.
            h = np.concatenate([a["h"], _mixed(doc[len(a["h"]) :].astype(np.uint64) + own[:, 1].astype(np.uint64)).view(np.int64)])
            off = pa.array(np.concatenate([a["off"], own[:, 0]]), pa.int32(), mask=np.arange(len(d)) >= len(a["h"]))
            return pa.record_batch(
                [
                    pa.array(h),
                    pa.array(np.concatenate([a["r"], np.zeros(len(own), np.int64)])),
                    pa.array(doc),
                    pa.array(mark),
                    pa.array(np.concatenate([a["first"], own[:, 1]]), pa.int32()),
                    pa.array(np.concatenate([a["last"], own[:, 2]]), pa.int32()),
                    off,
                ],
                names=["h", "r", "doc", "mark", "first", "last", "off"],
            )

        for batch in batches:
            for doc, mark, text in zip(*(batch.column(k) for k in range(3))):
                data = text.as_py()
                if len(data) >= width:
                    held.append((doc.as_py(), mark.as_py(), data))
                    size += len(data)
                if size >= CHUNK:
                    yield found()
                    held, size = [], 0
        if held:
            yield found()

    return docs.mapInArrow(run, "h long, r long, doc long, mark int, first int, last int, off int")


def _sorted_out(rows: DataFrame, width: int) -> DataFrame:
    """Runs that repeat an earlier one whole, as spans, and runs whose anchor has other surroundings too.

    Spans have ``off`` null and cover bytes ``first`` to ``last``. Rows come sorted by
    ``h, r, doc, mark, first``; the pass holds one row of state, however large a group is.
    """
    names = ["h", "doc", "mark", "first", "last", "off"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
        before = None  # the last row: h, r, and the doc, mark, first of the first row of its (h, r)
        held_h, seen, waiting = None, 0, None  # distinct r of the last h so far; its first row while it is the only one

        for batch in batches:
            if not batch.num_rows:
                continue
            c = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("h", "r", "doc", "mark", "first", "last")}
            span = np.isnan(batch.column("off").cast(pa.float64()).to_numpy(zero_copy_only=False))
            off = batch.column("off").fill_null(0).to_numpy(zero_copy_only=False)
            out = [np.stack([c["h"][span], c["doc"][span], c["mark"][span], c["first"][span], c["last"][span], np.full(span.sum(), -1)], axis=1)]
            c = {name: values[~span] for name, values in c.items()}
            off, n = off[~span], int((~span).sum())
            if n:
                lead = np.ones(n, bool)
                lead[1:] = (c["h"][1:] != c["h"][:-1]) | (c["r"][1:] != c["r"][:-1])
                joins = before is not None and (c["h"][0], c["r"][0]) == before[:2]
                lead[0] = not joins
                source = np.maximum.accumulate(np.where(lead, np.arange(n), -1))
                own = {x: np.where(source >= 0, c[x][np.maximum(source, 0)], before[2 + k] if before else 0) for k, x in enumerate(("doc", "mark", "first"))}
                # A row that repeats the first one's document is that same place again.
                again = ~lead & ((c["doc"] != own["doc"]) | (c["mark"] != own["mark"]) | (c["first"] != own["first"]))
                out.append(np.stack([c["h"][again], c["doc"][again], c["mark"][again], c["first"][again], c["last"][again] + width, np.full(again.sum(), -1)], axis=1))
                before = (c["h"][-1], c["r"][-1], own["doc"][-1], own["mark"][-1], own["first"][-1])

                leads = np.flatnonzero(lead)
                table = np.stack([c["h"][leads], c["doc"][leads], c["mark"][leads], c["first"][leads], c["last"][leads], off[leads]], axis=1)
                if waiting is not None:
                    table = np.concatenate([waiting, table])
                if len(table):
                    h = table[:, 0]
                    start = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                    counts = np.diff(np.r_[start, len(h)])
                    total = counts.copy()
                    if held_h is not None and h[0] == held_h and waiting is None:
                        total[0] += seen
                    mixed = np.repeat(total > 1, counts)
                    out.append(table[mixed])
                    held_h, seen = h[-1], int(total[-1])
                    waiting = table[-1:] if seen == 1 else None
            rows = np.concatenate(out)
            if len(rows):
                columns = [pa.array(rows[:, k], kind) for k, kind in enumerate(kinds[:-1])]
                columns.append(pa.array(rows[:, 5], pa.int32(), mask=rows[:, 5] < 0))
                yield pa.record_batch(columns, names=names)

    return rows.repartition("h").sortWithinPartitions("h", "r", "doc", "mark", "first").mapInArrow(
        run, "h long, doc long, mark int, first int, last int, off int"
    )


def _hot(mixed: DataFrame) -> DataFrame:
    return durable(mixed.groupBy("h").count().where(F.col("count") > HOT).select("h"), "repeats-hot")


def _with_texts(runs: DataFrame, docs: DataFrame) -> DataFrame:
    """``(doc, mark, data, runs)``: every text that has runs, with all of them."""
    wanted = runs.groupBy("doc", "mark").agg(F.collect_list(F.struct("h", "first", "last", "off")).alias("runs"))
    return docs.join(wanted, ["doc", "mark"]).dropDuplicates(["doc", "mark"]).select("doc", "mark", "data", "runs")


def _regions(mixed: DataFrame, docs: DataFrame, width: int, hot: DataFrame) -> DataFrame:
    """``(h, doc, mark, first, off, bytes)`` of runs of windows, but for those of hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("h", pa.int64()), ("doc", pa.int64()), ("mark", pa.int32()), ("first", pa.int32()), ("off", pa.int32()), ("data", pa.binary())]
        for batch in batches:
            for doc, mark, text, runs in zip(*(batch.column(k) for k in range(4))):
                doc, mark, data = doc.as_py(), mark.as_py(), text.as_py()
                out = [(x["h"], doc, mark, x["first"], x["off"], data[x["first"] : x["last"] + width]) for x in runs.as_py()]
                yield pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(zip(*out), fields)], names=[f for f, _ in fields])

    rows = _with_texts(mixed.join(hot, "h", "left_anti"), docs)
    return rows.mapInArrow(run, "h long, doc long, mark int, first int, off int, data binary")


def _hot_spans(mixed: DataFrame, docs: DataFrame, width: int, hot: DataFrame) -> DataFrame:
    """``(doc, mark, first, last)``: bytes under windows of hot anchors that occur earlier.

    Windows are known by 128 bits of hash. Their first places are combined before the
    shuffle and joined to all others in salted shares, so no task holds a window's places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, mark, text, runs in zip(*(batch.column(k) for k in range(4))):
                data = text.as_py()
                first = [k for x in runs.as_py() for k in range(x["first"], x["last"] + 1)]
                hashed = b"".join(hashlib.blake2b(data[k : k + width], digest_size=16).digest() for k in first)
                w = np.frombuffer(hashed, np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    [
                        pa.array(np.ascontiguousarray(w[:, 0])),
                        pa.array(np.ascontiguousarray(w[:, 1])),
                        pa.array(np.full(len(first), doc.as_py(), np.int64)),
                        pa.array(np.full(len(first), mark.as_py(), np.int32)),
                        pa.array(first, pa.int32()),
                    ],
                    names=["w1", "w2", "doc", "mark", "first"],
                )

    rows = _with_texts(mixed.join(hot, "h", "left_semi"), docs)
    windows = durable(rows.mapInArrow(run, "w1 long, w2 long, doc long, mark int, first int"), "repeats-windows")
    place = F.struct("doc", "mark", "first")
    least = windows.groupBy("w1", "w2").agg(F.min(place).alias("least"), F.count("*").alias("places"))
    again = salted_join(
        windows, least.where("places > 1").drop("places"), ["w1", "w2"], ["doc", "mark", "first"], "inner", FEW_SALTS
    )
    again = again.where(place != F.col("least"))
    found = durable(again.select("doc", "mark", "first", (F.col("first") + width).alias("last")), "repeats-hot-spans")
    discard(windows)
    return found


def _alike(h: np.ndarray, off: np.ndarray, data: list[bytes], width: int) -> np.ndarray:
    """Regions that agree with another of their anchor on enough bytes at the anchor's left or right.

    A window that holds the anchor holds half of the rest of its bytes on one of its sides.
    """
    side = (width - ANCHOR + 1) // 2
    keep = np.zeros(len(h), bool)
    for lefts in (True, False):
        parts = []
        for k, (o, text) in enumerate(zip(off.tolist(), data)):
            part = text[max(0, o - side) : o + ANCHOR] if lefts else text[o : o + ANCHOR + side]
            parts.append((int(h[k]), part if len(part) == ANCHOR + side else None))
        first: dict = {}
        for k, part in enumerate(parts):
            if part[1] is not None:
                other = first.setdefault(part, k)
                if other != k:
                    keep[other] = keep[k] = True
    return keep


def repeated_windows(doc: np.ndarray, mark: np.ndarray, first: np.ndarray, data: list[bytes], width: int) -> np.ndarray:
    """``(region, start)`` of windows that occur in an earlier place too, by a suffix array of all regions."""
    lengths = np.array([len(x) for x in data])
    size = int(lengths.sum()) + len(data) + 1
    s = np.zeros(size, np.int64)
    begins = np.r_[0, np.cumsum(lengths + 1)][:-1]
    region = np.repeat(np.arange(len(data)), lengths + 1)
    offset = np.arange(size - 1) - begins[region]
    inside = offset < lengths[region]
    s[:-1][inside] = np.frombuffer(b"".join(data), np.uint8).astype(np.int64) + 2
    s[:-1][~inside] = 1
    sa = suffix_array(s)
    common = permuted_common_prefixes(s, sa, width)
    window = np.zeros(size, bool)
    window[:-1] = offset + width <= lengths[region]
    # Windows are whole inside their regions, so a common prefix of that length has no end mark in it.
    place = sa[window[sa]]
    joined = common[place] >= width
    group = np.cumsum(~joined)
    where, at = region[place], offset[place]
    start = first[where] + at
    order = np.lexsort((start, mark[where], doc[where], group))
    lead = np.r_[True, group[order][1:] != group[order][:-1]] if len(order) else np.zeros(0, bool)
    source = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))] if len(order) else order
    same = (doc[where[order]] == doc[where[source]]) & (mark[where[order]] == mark[where[source]]) & (start[order] == start[source])
    found = order[~same]
    return np.stack([where[found], start[found]], axis=1)


def _spans(regions: DataFrame, width: int) -> DataFrame:
    """``(doc, mark, first, last)``: bytes under windows that occur earlier, of all regions of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def found(rows) -> pa.RecordBatch:
            h, doc, mark, first, off, data = rows
            keep = np.flatnonzero(_alike(h, off, data, width) | (np.fromiter(map(len, data), np.int64, len(data)) == width))
            doc, mark, first, data = doc[keep], mark[keep], first[keep], [data[k] for k in keep]
            if not len(keep):
                runs = np.zeros((0, 3), np.int64)
            else:
                windows = repeated_windows(doc, mark, first, data, width)
                runs = _runs(windows[:, 0], windows[:, 1], windows[:, 1], width)
            at = runs[:, 0]
            return pa.record_batch(
                [pa.array(doc[at]), pa.array(mark[at], pa.int32()), pa.array(runs[:, 1], pa.int32()), pa.array(runs[:, 2], pa.int32())],
                names=["doc", "mark", "first", "last"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)] + [batch.column(5).to_pylist()]
            rows = rows if held is None else [np.concatenate([a, b]) for a, b in zip(held[:5], rows[:5])] + [held[5] + rows[5]]
            h = rows[0]
            # Whole anchors go on as soon as they fill a shard.
            ends = np.flatnonzero(np.r_[h[1:] != h[:-1], False]) + 1
            sizes, begin = np.cumsum([len(x) for x in rows[5]]), 0
            for end in ends.tolist():
                if sizes[end - 1] - (sizes[begin - 1] if begin else 0) >= SHARD:
                    yield found([x[begin:end] for x in rows])
                    begin = end
            held = [x[begin:] for x in rows]
        if held is not None and len(held[0]):
            yield found(held)

    return regions.repartition("h").sortWithinPartitions("h").mapInArrow(run, "doc long, mark int, first int, last int")


def remove_repeats(docs: DataFrame, width: int = 100, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept)``: texts less all bytes under repeated strings.

    A byte goes if a string of ``width`` bytes that covers it also starts earlier, in a
    smaller doc_id or further left; all strings are judged on the input. ``kept`` is
    binary, as a cut may split a character. A null text is empty; a null doc_id comes
    last; rows that repeat doc_id and text are one place and get the same result, rows
    that repeat a doc_id with another text are ordered by a hash of it. Matches never
    cross documents. Other columns are ignored; an empty table gives no rows.

    Every window is dealt by its anchor, the 32 bytes of smallest hash in it, so equal
    windows meet. Runs of windows that repeat whole are settled by their hash; what else
    shares an anchor is sorted in suffix arrays, shard by shard, of whole anchors; windows of
    hot anchors are settled by 128 bits of hash.
    """
    content = F.encode(F.coalesce(F.col(text).cast("string"), F.lit("")), "UTF-8")
    texts = docs.select(_doc(doc_id).alias("doc"), F.col(doc_id).cast("long").alias("doc_id"), content.alias("data"))
    texts = texts.withColumn("mark", F.hash("data")).select("doc", "mark", "data", "doc_id")
    settled = durable(_sorted_out(anchors(texts.select("doc", "mark", "data"), width), width), "repeats-settled")
    mixed = settled.where("off is not null")
    hot = _hot(mixed)
    more = durable(_spans(_regions(mixed, texts, width, hot), width), "repeats-spans")
    if not hot.isEmpty():
        more = more.unionByName(_hot_spans(mixed, texts, width, hot))
    spans = settled.where("off is null").select("doc", "mark", "first", "last").unionByName(more)
    spans = spans.groupBy("doc", "mark").agg(F.collect_list(F.struct("first", "last")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]
        for batch in batches:
            out = []
            for doc, text, spans in zip(*(batch.column(k) for k in range(3))):
                data, parts, upto, count = text.as_py(), [], 0, 0
                for first, last in sorted((x["first"], x["last"]) for x in spans.as_py() or ()):
                    if first > upto or not count:
                        count += 1
                        parts.append(data[upto:first])
                    upto = max(upto, last)
                kept = b"".join([*parts, data[upto:]])
                out.append((doc.as_py(), len(data), len(data) - len(kept), count, kept))
            yield pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(zip(*out), fields)], names=[f for f, _ in fields])

    both = texts.join(spans, ["doc", "mark"], "left").select("doc_id", "data", "spans")
    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
