"""Input rows carried through Arrow functions under one name that nothing can clash with."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def boxed(docs: DataFrame, columns: Sequence[str] | None, results: Sequence[str]) -> Column:
    """One struct of the named columns (all if none are named), less those that results replace."""
    replaced = {name.lower() for name in results}
    kept = [c for c in (docs.columns if columns is None else columns) if c.lower() not in replaced]
    return F.struct(*[docs[f"`{c}`"] for c in kept]) if kept else F.struct(F.lit(None).cast("int").alias("nothing"))


def unboxed(found: DataFrame, box: str, results: Sequence[str]) -> DataFrame:
    """The columns of the struct ``box`` and then the results."""
    names = [c for c in found.schema[box].dataType.names if c != "nothing" or len(found.schema[box].dataType.names) > 1]
    return found.select(*[F.col(box)[c].alias(c) for c in names], *results)


def free_name(docs: DataFrame, name: str) -> str:
    """A name for a working column that no column of ``docs`` has."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name
