"""SimHash near-deduplication with bit-sliced comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.components import components
from lodestone.session import discard, durable

BITS = 64
SEED = 42
HASHES_AT_ONCE = 16_384
#: Groups up to this size are compared lane by lane, larger ones in tiles.
SMALL = 24
TILE = 256
#: A bucket with more fingerprints is dealt into pieces that are compared pair by pair of pieces.
PIECE = 8_192
LAST = 2**63 - 1
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, words: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles of ``words`` words, repeats included, part by part.

    A text with fewer words is one shingle; one without words, or null, has none.
    """
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = list(accumulate(map(len, tokens), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    last = ends[words - 1 :] or ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(last), HASHES_AT_ONCE):
        upto = min(len(last), at + HASHES_AT_ONCE)
        yield np.fromiter(
            (digest(joined[a:b], SEED) for a, b in zip(starts[at:upto], last[at:upto])), np.dtype("<u8"), upto - at
        )


def _sign(parts: Iterable[np.ndarray]) -> int:
    count, total = 0, np.zeros(BITS, np.int64)
    for hashes in parts:
        count += len(hashes)
        total += _bits(hashes).sum(axis=0, dtype=np.int32)
    return int(np.packbits(total * 2 > count, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, words: int) -> int:
    """SimHash of a whole text over shingles of ``words`` words, repeats included.

    A text with fewer words is one shingle; one without words, or null, has fingerprint 0.
    """
    return _sign(shingle_hashes(text, words))


def _bits(values: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones for each value, lowest bit first."""
    return np.unpackbits(values.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(
    docs: DataFrame, words: int = 4, doc_id: str = "doc_id", text: str = "text", beside: tuple[str, ...] = ()
) -> DataFrame:
    """``(doc_id, fp)`` for every row and the longs named in ``beside``; ``fp`` is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            others = [batch.column(2 + k) for k in range(len(beside))]
            yield pa.record_batch([batch.column(0), pa.array(marks.view(np.int64)), *others], names=["doc_id", "fp", *beside])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *beside)
    return rows.mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} long" for c in beside)]))


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Vertical store: word ``w`` of plane ``b`` holds bit ``b`` of values ``64 w`` to ``64 w + 63``."""
    packed = np.packbits(np.ascontiguousarray(_bits(values).T), axis=1, bitorder="little")
    wide = np.zeros((BITS, -(-packed.shape[1] // 8) * 8), np.uint8)
    wide[:, : packed.shape[1]] = packed
    return wide.view("<u8")


def lanes_within(planes: Iterator[np.ndarray], radius: int, shape: tuple[int, ...]) -> np.ndarray:
    """Lanes set in at most ``radius`` of the 64 planes, as words.

    Counts stand vertically too: a few counter planes per lane, two planes added at a
    time by a carry-save adder. A lane that outgrows its counter stays marked. The block
    is abandoned as soon as every lane exceeds the radius.
    """
    counters = [np.zeros(shape, np.uint64) for _ in range(max(1, radius.bit_length()))]
    over = np.zeros(shape, np.uint64)

    def exceeding() -> np.ndarray:
        above, level = over.copy(), np.full(shape, ALL)
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                level &= counters[k]
            else:
                above |= level & counters[k]
                level &= ~counters[k]
        return above

    for step, (one, two) in enumerate(zip(planes, planes)):
        low = counters[0]
        either = one ^ two
        carry = (one & two) | (low & either)
        counters[0] = low ^ either
        for k in range(1, len(counters)):
            held = counters[k]
            counters[k] = held ^ carry
            carry = carry & held
        over |= carry
        if step >= radius and step % 3 == 0:
            far = exceeding()
            if (far == ALL).all():
                return ~far
    return ~exceeding()


def _unpacked(words: np.ndarray, lanes: int) -> np.ndarray:
    shown = np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1, bitorder="little")
    return shown[..., :lanes].astype(bool)


def merge(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union of the pairs ``a[i], b[i]`` in ``roots``, which points every item at its group's first."""
    while a.size:
        a, b = roots[a], roots[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low != high
        a, b = low[apart], high[apart]
        np.minimum.at(roots, b, a)
        while True:
            further = roots[roots]
            if (further == roots).all():
                break
            roots[:] = further


def links_within(keys: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that join all values of equal key at most ``radius`` bits apart, as stars.

    Rows are sorted by key. Every pair of equal key is compared; of a group that hangs
    together only the links of its members to the first one are returned.
    """
    n = len(values)
    roots = np.arange(n)
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, n])
    small = sizes <= SMALL
    size_of = np.repeat(np.where(small, sizes, 0), sizes)
    place = np.arange(n) - np.repeat(starts, sizes)
    for step in range(1, SMALL):
        here = np.flatnonzero(place + step < size_of)
        if not here.size:
            break
        planes = bit_planes(values[here] ^ values[here + step])
        near = here[_unpacked(lanes_within(iter(planes), radius, planes[0].shape), here.size)]
        merge(roots, near, near + step)
    for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
        group = values[start : start + size]
        planes = bit_planes(group)
        for at in range(0, size, TILE):
            asked = group[at : at + TILE]
            masks = _bits(asked).T.astype(np.uint64) * ALL
            first = at // 64
            block = planes[:, first:]
            differences = (block[b][None, :] ^ masks[b][:, None] for b in range(BITS))
            near = _unpacked(lanes_within(differences, radius, (len(asked), block.shape[1])), size - first * 64)
            i, j = np.nonzero(near)
            i, j = i + at, j + first * 64
            later = j > i
            merge(roots, start + i[later], start + j[later])
    joined = np.flatnonzero(roots != np.arange(n))
    return roots[joined], joined


def _bucket_keys(fp: F.Column, blocks: int, kept: int) -> F.Column:
    """One key for every choice of ``kept`` of the fingerprint's blocks."""
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    parts = [
        F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << high - low) - 1)) for low, high in zip(edges, edges[1:])
    ]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), kept)):
        key = F.lit(number).cast("long")
        for k in chosen:
            key = F.shiftleft(key, edges[k + 1] - edges[k]).bitwiseOR(parts[k])
        keys.append(key)
    return F.array(*keys)


def near_links(marks: DataFrame, radius: int = 4, blocks: int = 6) -> DataFrame:
    """``(u, v)`` links that connect all distinct ``fp`` at most ``radius`` bits apart.

    Of ``blocks`` blocks of bits, two fingerprints within the radius agree in at least
    ``blocks - radius``; every such choice of blocks is a bucket key, so no pair is missed.
    Buckets larger than a piece are dealt into pieces by hash, and every two pieces meet
    in a task of their own.
    """
    kept = blocks - radius
    if not 1 <= kept:
        raise ValueError("more blocks than the radius are needed")
    rows = marks.select("fp", F.explode(_bucket_keys(F.col("fp"), blocks, kept)).alias("key"))
    large = durable(rows.groupBy("key").count().where(F.col("count") > PIECE), "buckets")
    pieces = F.ceil(F.col("count") / PIECE).cast("int")
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("pieces")).cast("int")
    met = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    dealt = (
        rows.join(large, "key", "left")
        .withColumn("pieces", F.coalesce(pieces, F.lit(1)))
        .withColumn("own", own)
        .select("fp", "key", "own", met.alias("met"))
        .select("fp", "key", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"))
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((0, 3), np.int64), np.zeros(0, np.uint64)]

        def found(keys, values):
            change = np.r_[False, (keys[1:] != keys[:-1]).any(axis=1)] if len(keys) else np.zeros(0, bool)
            a, b = links_within(np.cumsum(change), values, radius)
            return pa.record_batch([pa.array(values[a].view(np.int64)), pa.array(values[b].view(np.int64))], names=["u", "v"])

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (1, 2, 3)], axis=1)
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys, values = np.concatenate([held[0], keys]), np.concatenate([held[1], values])
            if not len(keys):
                continue
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            cut = int(last[-1]) + 1 if last.size else 0
            held = [keys[cut:], values[cut:]]
            if cut:
                yield found(keys[:cut], values[:cut])
        if len(held[0]):
            yield found(*held)

    return dealt.mapInArrow(run, "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame, words: int = 4, radius: int = 4, blocks: int = 6, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: its SimHash and the smallest doc_id that links reach.

    Nulls and texts without words have fingerprint 0 and are linked like any other; equal
    texts and repeated rows share a component; a null doc_id keeps its row and never names
    a component that has another one; an empty table gives no rows. Other columns are ignored.
    """
    marks = durable(fingerprints(docs, words, doc_id, text), "simhash")
    firsts = durable(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    links = durable(near_links(firsts, radius, blocks), "simhash-links")
    roots = components(links).withColumnRenamed("node", "fp")
    grouped = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    named = durable(grouped.join(smallest, "root").select("fp", "component_id"), "simhash-named")
    discard(firsts, links)
    return marks.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 4, radius: int = 4, blocks: int = 6, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each group of fingerprints that links connect.

    The row of the smallest doc_id stays, null ids last, and of rows that repeat it the one
    of smallest text hash. Rows of equal doc_id and text are copies whatever else they hold;
    the one whose columns hash lowest stays. Texts without words are a group like any other.
    An empty table gives no rows; columns stay as they are.
    """
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # Texts are told apart by 128 bits of hashes.
    name = [
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LAST)).alias("doc_id"),
        F.xxhash64(content).alias("m1"),
        F.xxhash64(F.lit(1), content).alias("m2"),
    ]
    keys = ["doc_id", "m1", "m2"]
    marks = fingerprints(docs.select(*name, content.alias("text")), words, beside=("m1", "m2"))
    firsts = durable(marks.groupBy("fp").agg(F.min(F.struct(*keys)).alias("first")), "simhash-distinct")
    links = durable(near_links(firsts.select("fp"), radius, blocks), "simhash-links")
    roots = components(links).withColumnRenamed("node", "fp")
    grouped = firsts.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    lead = durable(grouped.select("first.*"), "simhash-kept")
    discard(firsts, links)
    rows = docs.select(*name, F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")).join(lead, keys, "left_semi")
    kept = rows.groupBy(*keys).agg(F.min_by("row", F.xxhash64(F.col("row").cast("string"))).alias("row"))
    return kept.select("row.*")
