"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lodestone.session import discard, durable

#: Queries and candidates that meet in one task.
QUERY_BLOCK = 1_024
CANDIDATE_BLOCK = 16_384
#: Bins into which each step divides a query's remaining range of scores.
BINS = 2_048
#: Query rows scored at once inside a task.
STRIPE = 128
EXACT = 2.0**53
LONG = 2**63 - 1


def whole_vectors(vectors: DataFrame, scale: int, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, q)`` with ``q = floor(scale * x)``; rows with a null, NaN or infinite component go.

    Components outside the range of a long are held at its ends.
    """
    values = F.col(vector).cast("array<double>")
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("x"), bad.alias("bad"))
    return rows.where("vec_id is not null and x is not null and not bad").select(
        "vec_id", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("q")
    )


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the range of a long they are held at its ends."""
    width = queries.shape[1]
    if not width:
        return np.zeros((len(queries), len(candidates)), np.int64)
    top = float(np.abs(queries.astype(np.float64)).max()) * float(np.abs(candidates.astype(np.float64)).max()) * width
    if top < EXACT:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    if top < 2.0**62:
        return queries @ candidates.T
    whole = queries.astype(object) @ candidates.astype(object).T
    return np.clip(whole, -LONG - 1, LONG).astype(np.int64)


def _width(span: np.ndarray) -> np.ndarray:
    return -(-span // BINS)


def _blocks(queries: pd.DataFrame, candidates: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray]]:
    """Stripes of queries with their scores; a mask tells candidates that are not the query's own row."""
    if not len(queries) or not len(candidates):
        return
    right = np.stack(candidates["q"].to_numpy())
    ids = candidates["vec_id"].to_numpy()
    for at in range(0, len(queries), STRIPE):
        stripe = queries.iloc[at : at + STRIPE]
        found = scores(np.stack(stripe["q"].to_numpy()), right)
        yield stripe, found, ids[None, :] != stripe["vec_id"].to_numpy()[:, None]


def top_k(
    vectors: DataFrame, k: int, every: int, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best candidates of every query, exactly.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are all rows
    of another vec_id with as many components. Ties go to the smaller vec_id; repeated
    rows are candidates, and queries, of their own but a query_id is answered once.
    Fewer candidates than ``k`` are all returned; null and non-finite vectors take no part.

    Every pass scores all pairs, block against block, and keeps of each block only the
    bins that can hold a k-th value, with their counts. The counts add up to one global
    histogram for each query; the bin that holds its k-th value is the range of the next
    pass, until it is one value wide. Then scores at or above that value are kept, of each
    block at most ``k`` for a query, which loses none of the k best, and ties are ranked.
    """
    rows = whole_vectors(vectors, scale, vec_id, vector).withColumn("dims", F.size("q"))
    rows = durable(rows.withColumn("reach", F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x)), "topk-rows")
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0).dropDuplicates(["vec_id"])
    n_queries, n_rows = asked.count(), rows.count()
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))
    row_blocks = max(1, -(-n_rows // CANDIDATE_BLOCK))

    def dealt(n: int, salt: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    candidates = rows.select(
        "vec_id", "q", "dims", dealt(row_blocks, 1).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("b")
    )
    farthest = rows.groupBy("dims").agg(F.max("reach").alias("farthest"))
    # A score is at most the product of both lengths; a little more makes up for rounding.
    reach = F.least(F.ceil(F.sqrt(F.col("reach") * F.col("farthest")) * 1.001 + 1).cast("long"), F.lit(2**61))
    state = asked.join(F.broadcast(farthest), "dims").select(
        "vec_id", "q", "dims", (-reach).alias("low"), (reach * 2 + 1).alias("span"), F.lit(0).cast("long").alias("above")
    )
    state = durable(state, "topk-state")

    def meet(state: DataFrame, work, schema: str) -> DataFrame:
        spread = state.select(
            "*", dealt(query_blocks, 2).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("c")
        )
        keys = ["dims", "b", "c"]
        return spread.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInPandas(work, schema)

    def histogram(queries: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for stripe, found, other in _blocks(queries, others):
            low, span, above = (stripe[c].to_numpy()[:, None] for c in ("low", "span", "above"))
            # Scores above the range are counted already, in ``above``.
            bins = (found - low) // _width(span)
            inside = other & (found >= low) & (found - low < span)
            for row, query in enumerate(stripe["vec_id"].to_numpy()):
                held, counts = np.unique(bins[row][inside[row]], return_counts=True)
                held, counts = held[::-1], counts[::-1]
                upto = np.searchsorted(np.cumsum(counts), k - int(above[row, 0])) + 1
                parts.append(pd.DataFrame({"vec_id": query, "bin": held[:upto], "n": counts[:upto]}))
        return pd.concat(parts) if parts else pd.DataFrame({"vec_id": [], "bin": [], "n": []}).astype("int64")

    while state.where("span > 0").limit(1).count():
        counted = meet(state.where("span > 0"), histogram, "vec_id long, bin long, n long")
        counted = counted.groupBy("vec_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("vec_id").orderBy(F.desc("bin"))
        seen = state.select("vec_id", F.col("above").alias("seen"))
        reached = counted.withColumn("upto", F.sum("n").over(down)).join(seen, "vec_id").where(F.col("upto") + F.col("seen") >= k)
        kth = reached.groupBy("vec_id").agg(F.max(F.struct("bin", (F.col("upto") - F.col("n")).alias("over"))).alias("at"))
        span, width, found = F.col("span"), F.ceil(F.col("span") / BINS).cast("long"), F.col("at").isNotNull()
        # Without a k-th value in range the query has fewer candidates than k and takes them all.
        low = F.when(found, F.col("low") + F.col("at.bin") * width).when(span > 0, F.lit(-LONG - 1)).otherwise(F.col("low"))
        left = F.when(found & (width > 1), F.least(width, span - F.col("at.bin") * width)).otherwise(F.lit(0)).cast("long")
        above = F.col("above") + F.coalesce(F.col("at.over"), F.lit(0))
        following = state.join(kth, "vec_id", "left").select(
            "vec_id", "q", "dims", low.alias("low"), left.alias("span"), above.alias("above")
        )
        following = durable(following, "topk-state")
        discard(state)
        state = following

    def best(queries: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        parts, ids = [], others["vec_id"].to_numpy()
        for stripe, found, other in _blocks(queries, others):
            wanted = other & (found >= stripe["low"].to_numpy()[:, None])
            for row, query in enumerate(stripe["vec_id"].to_numpy()):
                at = np.flatnonzero(wanted[row])
                # The complement turns the order of whole numbers around without overflow.
                at = at[np.lexsort((ids[at], ~found[row][at]))][:k]
                parts.append(pd.DataFrame({"query_id": query, "vec_id": ids[at], "score": found[row][at]}))
        return pd.concat(parts) if parts else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    kept = meet(state, best, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
