"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.session import discard, durable

ROUNDS = 60


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (u, v)``: the smallest node it reaches.

    Alternates large-star and small-star rounds: every node points its larger, then its
    smaller neighbours at the smallest one it knows, so the number of rounds grows with
    the logarithm of a component's diameter. Rounds are aggregations and equi-joins of
    node pairs; minima are combined before the shuffle. The edges of one node meet in one
    task where adaptive execution does not split it; a large star settles in two rounds.
    Rows with a null and loops count for nothing; repeated edges count once. No edges: no rows.
    """
    wide = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current = durable(wide, "edges")
    before = _state(current)
    for _ in range(ROUNDS):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        following = durable(small, "edges")
        discard(current)
        current, after = following, _state(following)
        if after == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = after
    raise RuntimeError("components did not settle")
