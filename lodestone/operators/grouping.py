"""First-seen groups, as flat rows or as bounded nested blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestone.operators.skew import salted_join

BLOCK_ROWS = 4096


def group_key(column: str):
    """Group key that keeps a null group apart and joins by plain equality."""
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(column)))


def with_group_position(rows: DataFrame, group: str, pos: str) -> DataFrame:
    """Add the position at which each row's group was first seen.

    Ordering by that position, then by ``pos``, lists groups in first-seen order.
    """
    keyed = rows.withColumn("_key", group_key(group))
    groups = keyed.groupBy("_key").agg(F.min(pos).alias(f"{group}_pos"))
    return salted_join(keyed, groups, ["_key"], [pos]).drop("_key")


def nested_blocks(
    rows: DataFrame, group: str, pos: str, fields: list[str], name: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Rows nested per group, in position order, at most ``block_rows`` to a block.

    ``pos`` is a unique long, so a block of ``block_rows`` neighbouring positions
    bounds every array; a group of any size becomes as many blocks as it needs.
    A group's blocks in ``block`` order hold its rows in order.
    """
    blocks = (
        rows.withColumn("block", F.floor(F.col(pos) / F.lit(block_rows)).cast("long"))
        .groupBy(group, "block")
        .agg(
            F.min(pos).alias("_first"),
            F.sort_array(F.collect_list(F.struct(F.col(pos).alias("_pos"), *fields))).alias("_rows"),
        )
    )
    bare = (lambda r: r[fields[0]]) if len(fields) == 1 else (lambda r: F.struct(*[r[f].alias(f) for f in fields]))
    return with_group_position(blocks, group, "_first").select(
        F.col(group), F.col(f"{group}_pos"), "block", F.transform("_rows", bare).alias(name)
    )


def first_group(rows: DataFrame, group: str, pos: str) -> DataFrame:
    """All rows of the group that was seen first."""
    first = rows.select(group, pos).orderBy(pos).limit(1).select(F.col(group).alias("_first"))
    return rows.join(F.broadcast(first), rows[group].eqNullSafe(F.col("_first"))).drop("_first")


def last_write_wins(rows: DataFrame, path: str, seq: str) -> DataFrame:
    """The row that survives when several are written to one path in ``seq`` order."""
    last = rows.groupBy(path).agg(F.max(seq).alias(seq))
    return rows.join(last, [path, seq], "left_semi")


def collisions(rows: DataFrame, path: str, key: str) -> DataFrame:
    """Paths shared by more than one distinct key."""
    return (
        rows.groupBy(path)
        .agg(F.count_distinct(key).alias("n_keys"), F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_keys") > 1)
    )
