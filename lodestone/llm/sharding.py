"""Byte-balanced shards by Karmarkar-Karp differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lodestone.session import durable

#: Items that the differencing sees for each shard: this many grains of small groups ...
GRAINS = 128
#: ... and at most this many large groups (a group is large from a 1/LARGE part of a shard on).
LARGE = 128
ROWS_PER_BUCKET = 50_000


def difference(sizes: np.ndarray, ways: int) -> np.ndarray:
    """Part number of every item: Karmarkar-Karp differencing into ``ways`` parts.

    Every item starts as a partial partition that holds it alone. The two partitions of
    largest spread are combined again and again, the heaviest part of one with the
    lightest of the other, until one is left. Ties go to the earlier partition.
    """
    if not len(sizes):
        return np.zeros(0, np.int64)
    sums, members, heap = {}, {}, []
    for item, size in enumerate(sizes.tolist()):
        row = np.zeros(ways, np.int64)
        row[-1] = size
        sums[item], members[item] = row, {ways - 1: (item,)}
        heap.append((-(int(row[-1] - row[0])), item))
    heapq.heapify(heap)
    fresh = len(sizes)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        total = sums.pop(one) + sums.pop(two)[::-1]
        # A part is a pair tree of items, so that combining costs nothing for each item.
        parts = members.pop(one)
        for place, held in members.pop(two).items():
            turned = ways - 1 - place
            parts[turned] = (parts[turned], held) if turned in parts else held
        order = np.argsort(total, kind="stable")
        where = np.empty(ways, np.int64)
        where[order] = np.arange(ways)
        sums[fresh] = total[order]
        members[fresh] = {int(where[place]): held for place, held in parts.items()}
        heapq.heappush(heap, (-int(total[order[-1]] - total[order[0]]), fresh))
        fresh += 1
    out = np.zeros(len(sizes), np.int64)
    for part, tree in members[heap[0][1]].items():
        stack = [tree]
        while stack:
            for node in stack.pop():
                if isinstance(node, tuple):
                    stack.append(node)
                else:
                    out[node] = part
    return out


def assign_shards(
    docs: DataFrame, shards: int = 40, overhead: int = 16, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every row.

    Rows of equal text are one indivisible group (null counts as empty text). Groups are
    summed before the shuffle. Large groups (at most ``shards * LARGE`` can exist) stay
    items of their own; all others are put by hash into ``shards * GRAINS`` grains, so the
    differencing always sees a bounded number of items however many rows there are, and
    balances whole groups only. ``slot`` counts the rows of a shard without gaps: rows are
    dealt into buckets by hash, ranked inside, and moved by the sizes of the buckets before.
    Repeated rows keep a slot each; an empty table gives no rows; other columns are ignored.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = durable(
        docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            (F.octet_length(content).cast("long") + overhead).alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.unhex(F.sha2(content, 256)).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"))
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    limit = max(1, total // (shards * LARGE))
    grain = F.pmod(F.xxhash64("digest"), F.lit(shards * GRAINS)).cast("string")
    item = F.when(F.col("bytes") > limit, F.hex("digest")).otherwise(grain)
    items = durable(groups.withColumn("item", item), "shard-groups")

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = pd.concat([pd.DataFrame({"item": [], "bytes": []}), *parts]).sort_values(["bytes", "item"], ascending=False)
        sizes = table["bytes"].to_numpy(dtype=np.int64)
        yield pd.DataFrame({"item": table["item"].astype(str), "shard": difference(sizes, shards).astype(np.int32)})

    placed = (
        items.groupBy("item").agg(F.sum("bytes").alias("bytes")).coalesce(1).mapInPandas(split, "item string, shard int")
    )
    of_digest = durable(items.join(placed, "item").select("digest", "shard"), "shard-of-digest")
    buckets = max(1, -(-count // (shards * ROWS_PER_BUCKET)))
    spread = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(buckets)).cast("int")
    dealt = rows.withColumn("bucket", spread).join(of_digest, "digest")
    ranked = dealt.withColumn(
        "rank", F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("doc_id", "digest")).cast("long") - 1
    )
    held = durable(dealt.groupBy("shard", "bucket").agg(F.count("*").alias("rows")), "shard-buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("shard", "bucket", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    return ranked.join(offsets, ["shard", "bucket"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
