"""Building blocks whose work stays bounded when one key holds most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SALTS = 16
# Where the right side is as large as the left, repeating it often costs more than it saves.
FEW_SALTS = 4


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Equi-join whose left side may have hot keys, nulls included.

    ``right`` holds a bounded number of rows per key. The rows of every left key are
    spread over ``salts`` tasks by a hash of the ``spread`` columns, and the right
    rows are repeated once per salt. Where the right side turns out small, adaptive
    execution broadcasts it; where one salt is still too large, it splits that too.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(copies, [*keys, "_salt"], how).drop("_salt")


def count_before(rows: DataFrame, pos: str, flag: Column, name: str) -> DataFrame:
    """Add ``name``: how many flagged rows have a smaller ``pos``.

    ``pos`` is a unique non-negative long. Counts are summed in three levels of 16
    bits, so each window and each join key covers at most 65,536 rows or buckets
    however many rows there are; no level sorts the whole table in one task.
    """
    bits, levels = 16, 3
    tagged = rows.withColumn("_flag", flag.cast("long"))
    sums = [None]
    for level in range(1, levels + 1):
        source = tagged if level == 1 else sums[-1]
        column, value = (pos, "_flag") if level == 1 else ("_bucket", "_sum")
        sums.append(
            source.groupBy(F.shiftright(F.col(column), bits).alias("_bucket")).agg(F.sum(value).alias("_sum"))
        )
    offsets = None
    for level in range(levels, 0, -1):
        parent = F.shiftright(F.col("_bucket"), bits)
        within = Window.partitionBy("_parent").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        here = (
            sums[level]
            .withColumn("_parent", parent)
            .withColumn("_before", F.coalesce(F.sum("_sum").over(within), F.lit(0)))
        )
        if offsets is not None:
            above = offsets.select(F.col("_bucket").alias("_parent"), F.col("_before").alias("_above"))
            here = here.join(above, "_parent").withColumn("_before", F.col("_before") + F.col("_above"))
        offsets = here.select("_bucket", "_before")
    within = Window.partitionBy("_bucket").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return (
        tagged.withColumn("_bucket", F.shiftright(F.col(pos), bits))
        .join(offsets, "_bucket")
        .withColumn(name, F.col("_before") + F.coalesce(F.sum("_flag").over(within), F.lit(0)))
        .drop("_bucket", "_before", "_flag")
    )
