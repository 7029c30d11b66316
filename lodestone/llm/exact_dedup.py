"""Exact duplicates by Patricia tries over length-and-hash partitions."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from lodestone.llm.patricia import Trie
from lodestone.llm.rows import boxed, unboxed
from lodestone.session import durable

#: Bytes of tries in a task that reads rows, and in one that merges a partition. Beyond the
#: first a new trie is begun, beyond the second subtrees are spilled.
NEAR, FULL = 32 << 20, 128 << 20
#: Bytes of distinct texts that a partition is meant to have, and of texts in a batch.
SHARE, BATCH = 32 << 20, 4 << 20
RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


class Owner:
    """What a terminal node holds: the best row so far, how many rows, and who asks for it."""

    __slots__ = ("best", "row", "rows", "slots")

    def __init__(self, best: int | None, row: int, rows: int, slots: array):
        self.best, self.row, self.rows, self.slots = best, row, rows, slots

    def meet(self, best: int | None, row: int, rows: int, sign: int) -> None:
        self.rows += rows
        mine, other = (self.best is None, -sign * (self.best or 0), self.row), (best is None, -sign * (best or 0), row)
        if other < mine:
            self.best, self.row = best, row


def _batches(rows: Iterator[tuple[bytes, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows with the bytes that they hold, as batches of bounded size."""
    held, size = [], 0
    for weight, row in rows:
        held.append(row)
        size += weight + 64
        if size >= BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


#: A terminal node: its slot, its text, the best row's identifier and number, and its rows.
NODES = [("slot", pa.int64()), ("body", pa.binary()), ("best", pa.int64()), ("row", pa.int64()), ("rows", pa.int64())]
NODE_SQL = "slot bigint, body binary, best bigint, row bigint, rows bigint"
MERGED = [("slots", pa.list_(pa.int64())), ("sha", pa.binary()), *NODES[1:]]
MERGED_SQL = "slots array<bigint>, sha binary, body binary, best bigint, row bigint, rows bigint"


def _near(rows: DataFrame, sign: int, lower: bool, budget: int) -> DataFrame:
    """First tries, each over rows of one task: a line for each row with its node's slot,
    and one for each node. Copies are merged here before anything is shuffled."""
    schema = T.StructType(
        [T.StructField("box", rows.schema["box"].dataType), T.StructField("number", T.LongType())] + list(T._parse_datatype_string(NODE_SQL))
    )
    fields = pa.schema(NODES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        trie: Trie[Owner] = Trie()
        boxes = None

        def nodes() -> Iterator[pa.RecordBatch]:
            every = ((len(t), (o.slots[0], t, o.best, o.row, o.rows)) for t, o in trie.items())
            for found in _batches(every, fields):
                empty = [pa.nulls(len(found), boxes), pa.nulls(len(found), pa.int64())]
                yield pa.RecordBatch.from_arrays([*empty, *found.columns], names=["box", "number", *fields.names])

        for batch in batches:
            boxes, slots, first = batch.schema.field(0).type, [], number
            for doc_id, body in zip(batch.column(1).to_pylist(), batch.column(2)):
                text = body.as_py() or b""
                node = trie.find(text.lower() if lower else text)  # bytes: A to Z only
                if node.held is None:
                    node.held = Owner(doc_id, number, 1, array("q", [number]))
                else:
                    node.held.meet(doc_id, number, 1, sign)
                slots.append(node.held.slots[0])
                number += 1
                if trie.weight > budget:
                    yield from nodes()
                    trie = Trie()
            n = len(slots)
            rest = [pa.nulls(n, f.type) for f in fields][1:]
            numbers = pa.array(range(first, number), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), numbers, pa.array(slots, pa.int64()), *rest], names=["box", "number", *fields.names]
            )
        if boxes is not None:
            yield from nodes()

    return rows.mapInArrow(work, schema)


def _merge(nodes: DataFrame, sign: int, budget: int) -> DataFrame:
    """Tries over whole partitions: a line for each distinct text. Lines that still have a
    text belong to a spilled subtree and go to the next round."""
    fields = pa.schema(MERGED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie: Trie[Owner] = Trie()

        def settled() -> Iterator[tuple[int, tuple]]:
            for text, o in trie.items():
                yield 8 * len(o.slots), (list(o.slots), sha256(text).digest(), None, o.best, o.row, o.rows)

        def spilled(text: bytes, o: Owner) -> tuple[int, tuple]:
            return len(text) + 8 * len(o.slots), (list(o.slots), None, text, o.best, o.row, o.rows)

        def turned_away() -> Iterator[tuple[int, tuple]]:
            for batch in batches:
                slots, bodies, best, row, rows = (batch.column(k) for k in range(5))
                for k in range(len(batch)):
                    text = bodies[k].as_py()
                    new = Owner(best[k].as_py(), row[k].as_py(), rows[k].as_py(), array("q", slots[k].as_py()))
                    node = trie.find(text)
                    if node is None:
                        yield spilled(text, new)
                        continue
                    if node.held is None:
                        node.held = new
                    else:
                        node.held.meet(new.best, new.row, new.rows, sign)
                        node.held.slots.extend(new.slots)
                    trie.weight += 8 * len(new.slots)
                    while trie.weight > budget and (given := trie.spill()):
                        yield from (spilled(*x) for x in given)
            yield from settled()

        yield from _batches(turned_away(), fields)

    return nodes.mapInArrow(work, MERGED_SQL)


def exact_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: str = "smallest",
    lower: bool = True,
    columns: Sequence[str] | None = None,
    near: int = NEAR,
    full: int = FULL,
    share: int = SHARE,
) -> DataFrame:
    """Every row with the identifier that stays of its group of equal texts, the group's size,
    whether this row is the one, and the SHA-256 (hex) of the compared text.

    Texts are compared whole, as bytes in UTF-8, with A to Z lower-cased if ``lower``; null
    counts as empty. ``keep`` is ``smallest`` or ``largest``; of rows that repeat the
    identifier kept, one stays. A null identifier stays only where all of a group are null
    (``keep_id`` is null then). An empty table gives no rows. Columns named in ``columns``
    (default: all) come with each row, except that results replace columns of their names.

    Every task puts its own rows into Patricia tries of bounded size, so of a text that a
    third of all rows share one node a trie is left. Nodes are dealt by length and content
    hash; a trie of each partition takes their full strings, and its terminal nodes keep the
    owner. Equality is that of whole strings: hashes only deal. A trie beyond ``full`` bytes
    spills its heaviest subtree, which is dealt anew over more partitions in the next round.
    Rows find their owner by the node they fell into, a key that has rows of one task only.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    sign = -1 if keep == "smallest" else 1
    box = boxed(docs, columns, RESULTS)
    body = F.col(f"`{text}`").cast("string").cast("binary").alias("body")
    rows = docs.select(box.alias("box"), F.col(f"`{doc_id}`").cast("long").alias("id"), body)
    near_nodes = durable(_near(rows, sign, lower, near), "trie-rows")
    waiting = near_nodes.where("body is not null").select(F.array("slot").alias("slots"), "body", "best", "row", "rows")
    settled, level = None, 0
    while True:
        total = waiting.agg(F.coalesce(F.sum(F.octet_length("body") + 64), F.lit(0))).first()[0]
        if level and not total:
            break
        # The round's number goes into the hash, so that what was spilled together is dealt apart.
        key = F.xxhash64(F.octet_length("body"), "body", F.lit(level))
        parts = max(waiting.sparkSession.sparkContext.defaultParallelism, -(-total // share))
        found = durable(_merge(waiting.repartition(parts, key), sign, full), "trie-owners")
        done = found.where("body is null").select("slots", "sha", "best", "row", "rows")
        settled = done if settled is None else settled.union(done)
        waiting = found.where("body is not null").select("slots", "body", "best", "row", "rows")
        level += 1
    owners = settled.select(F.explode("slots").alias("slot"), "sha", "best", F.col("row").alias("owner"), "rows")
    members = near_nodes.where("number is not null").select("box", "number", "slot")
    found = members.join(owners, "slot").select(
        "box",
        F.col("best").alias("keep_id"),
        F.col("rows").alias("group_size"),
        (F.col("number") == F.col("owner")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    return unboxed(found, "box", RESULTS)


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with the columns of ``docs``; options as for ``exact_duplicates``."""
    found = exact_duplicates(docs.select("*", F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_whole")), columns=["_whole"], **options)
    return found.where("kept").select("_whole.*")
