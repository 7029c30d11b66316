"""One JSON array of any length as many rows: texts cut at closing braces, put together again by element.

A reader that cuts files at ``}`` gives every task a byte range of a large file. Whether a
piece begins inside a string, and how deep, depends on all pieces before it. Each piece is
summed up for both cases, splits of a file are chained by their sums, and pieces between
two returns to the array's level are joined into the text of one element.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestone.functions import json as J
from lodestone.operators.skew import salted_join
from lodestone.session import discard, durable

SPLIT = ["file_path", "block"]


@dataclass(frozen=True)
class Elements:
    """``groups (file_path, pos, elements, ok)`` of arrays, ``files (file_path, listed, valid)``, ``others (file_path, content)``."""

    groups: DataFrame
    files: DataFrame
    others: DataFrame


def _levels(outside: Column) -> Column:
    """Brackets opened less brackets closed; the brace that ends a piece is not in it."""
    without = lambda *signs: _less(outside, signs)
    return without("{", "[") - without("]", "}")


def _less(text: Column, signs: tuple[str, ...]) -> Column:
    bare = text
    for sign in signs:
        bare = F.replace(bare, F.lit(sign), F.lit(""))
    return F.octet_length(text) - F.octet_length(bare)


def measured(pieces: DataFrame) -> DataFrame:
    """Add to ``pieces (file_path, block, id, file_size, part)`` what each does to string state and depth.

    ``odd`` is 1 if the piece turns inside to outside, ``d0`` and ``d1`` are the changes of
    depth if it begins outside or inside a string; ``cut`` marks an escape that ends with it.
    """
    plain = F.regexp_replace("part", r"\\[\s\S]", "")
    staged = J.computed_once(pieces, _plain=plain)
    strings = r'"[^"]*(?:"|\z)'
    rest = F.regexp_replace("_plain", r'\A[^"]*(?:"|\z)', "")
    return staged.select(
        *pieces.columns,
        (_less(F.col("_plain"), ('"',)) % 2).cast("int").alias("odd"),
        _levels(F.regexp_replace("_plain", strings, "")).alias("d0"),
        _levels(F.regexp_replace(rest, strings, "")).alias("d1"),
        F.contains("_plain", F.lit("\\")).alias("cut"),
        F.octet_length("part").cast("long").alias("bytes"),
    )


def _placed(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(file_path, block, id, pos, ends)`` of every piece, and ``(file_path, listed, valid)`` of every file."""
    narrow = pieces.drop("part")
    along = Window.partitionBy(*SPLIT).orderBy("id")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    turned = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    steps = narrow.withColumn("turned", turned)
    begins_out = F.col("turned") == 0
    ends_out = (F.col("turned") + F.col("odd")) % 2 == 0
    # The change of depth, closing brace included, if the split begins outside or inside a string.
    steps = steps.withColumns(
        {
            "t0": F.when(begins_out, F.col("d0")).otherwise(F.col("d1")) - ends_out.cast("int"),
            "t1": F.when(begins_out, F.col("d1")).otherwise(F.col("d0")) - (~ends_out).cast("int"),
        }
    )
    splits = steps.groupBy(*SPLIT).agg(
        (F.sum("odd") % 2).alias("odd"),
        F.sum("t0").alias("t0"),
        F.sum("t1").alias("t1"),
        F.count(F.lit(1)).alias("n"),
        F.sum("bytes").alias("bytes"),
        F.max("file_size").alias("file_size"),
        F.max("id").alias("last"),
        F.min_by("listed", "id").alias("listed"),
        F.bool_or("cut").alias("cut"),
    )
    splits = durable(splits, "json-splits")
    chain = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    started = splits.withColumn("inside", F.coalesce(F.sum("odd").over(chain), F.lit(0)) % 2)
    started = started.withColumn("t", F.when(F.col("inside") == 0, F.col("t0")).otherwise(F.col("t1")))
    started = started.withColumn("depth", F.coalesce(F.sum("t").over(chain), F.lit(0)))
    files = splits.groupBy("file_path").agg(
        F.min_by("listed", "block").alias("listed"),
        F.max_by("last", "block").alias("last"),
        F.max("block").alias("last_block"),
        (F.max("file_size") - F.sum("bytes")).alias("braces"),
        F.sum("n").alias("n"),
        F.bool_or("cut").alias("cut"),
        (F.sum("odd") % 2).alias("inside"),
    )
    final = started.groupBy("file_path").agg(F.sum("t").alias("final"))
    # Only the last piece of a file may lack its brace; the file's size tells.
    open_end = F.col("braces") == F.col("n") - 1
    sound = ~F.col("cut") & (F.col("inside") == 0) & (F.col("final") + open_end.cast("int") == 0) & (open_end | (F.col("braces") == F.col("n")))
    files = durable(files.join(final, "file_path").select("file_path", "listed", "last", "last_block", open_end.alias("open_end"), sound.alias("sound")), "json-files")

    known = started.select(*SPLIT, "inside", "depth").join(files.select("file_path", "last", "last_block", "open_end"), "file_path").select(
        *SPLIT, "inside", "depth", F.when(F.col("open_end") & (F.col("block") == F.col("last_block")), F.col("last")).alias("unclosed")
    )
    here = steps.join(known, SPLIT)
    t = F.when(F.col("inside") == 0, F.col("t0")).otherwise(F.col("t1"))
    outside = (F.col("inside") + F.col("turned") + F.col("odd")) % 2 == 0
    closed = F.coalesce(F.col("id") != F.col("unclosed"), F.lit(True))
    here = here.withColumn("ends", (outside & closed & (F.col("depth") + F.sum(t).over(upto) == 1)).cast("int"))
    here = durable(here.select(*SPLIT, "id", "ends", F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("nth")), "json-places")
    offsets = here.groupBy(*SPLIT).agg(F.sum("ends").alias("n"))
    offsets = offsets.select(*SPLIT, F.coalesce(F.sum("n").over(chain), F.lit(0)).alias("offset"))
    places = here.join(offsets, SPLIT).select(*SPLIT, "id", (F.col("offset") + F.col("nth")).alias("pos"), "ends")
    discard(splits)
    return places, files.select("file_path", "listed", F.col("sound").alias("valid"), "open_end")


def _text(pieces: str, closed: Column) -> Column:
    parts = F.transform(F.sort_array(pieces), lambda p: p["part"])
    return F.concat(F.array_join(parts, "}"), F.when(closed, "}").otherwise(""))


def array_elements(pieces: DataFrame) -> Elements:
    """Elements of files that hold an array, element by element, and the whole text of other files.

    ``pieces`` is what ``files.read_json_pieces`` gives: ``(file_path, block, id, file_size,
    part)``, the parts of a file between its closing braces, ordered by ``(block, id)``.
    ``pos`` counts groups of a file: each holds one object and scalars before it, the last
    what follows the last object. ``ok`` is false where a group is no list of JSON values
    with its commas in place. A file is valid if its quotes and brackets close and all of its
    groups are ``ok``; groups of other files are not put together. An element is one value
    and so one task's work; a file is shared by all tasks.
    """
    listed = F.col("part").rlike(r"\A\s*\[")
    rows = durable(measured(pieces).withColumn("listed", listed), "json-pieces")
    places, files = _placed(rows)
    files = durable(files, "json-forms")
    placed = rows.select(*SPLIT, "id", "part").join(places, [*SPLIT, "id"])
    # Files are few next to pieces, but one may have nearly all pieces.
    known = salted_join(placed, files, ["file_path"], ["block", "id"], "inner")
    piece = F.struct("block", "id", "part")
    arrays = known.where("listed and valid").groupBy("file_path", "pos").agg(
        F.collect_list(piece).alias("pieces"), F.bool_or(F.col("ends") == 1).alias("whole"), F.bool_or("open_end").alias("open_end")
    )
    text = F.col("text")
    staged = arrays.select("file_path", "pos", "whole", _text("pieces", F.col("whole") | ~F.col("open_end")).alias("text"))
    opening = F.when(F.col("pos") == 0, F.lit(r"[")).otherwise(F.lit(","))
    begins = F.startswith(F.ltrim(F.regexp_replace(text, r"\A\s+", "")), opening)
    # What is between a group's first sign and, in the last group, the array's end.
    inner = F.regexp_replace(F.regexp_replace(text, r"\A\s*[\[,]", ""), r"\s*\z", "")
    last = ~F.col("whole")
    bare = F.when(last, F.regexp_replace(inner, r"\]\z", "")).otherwise(inner)
    closing_only = last & (F.col("pos") > 0) & text.rlike(r"\A\s*\]\s*\z")
    closes = ~last | text.rlike(r"\]\s*\z")
    wrapped = F.concat(F.lit("["), bare, F.lit("]"))
    read = J.computed_once(staged, _value=F.when(begins & closes, J.parsed(wrapped)), _only=closing_only, _first=F.col("pos") == 0)
    elements = F.when(F.col("_only"), F.array().cast("array<variant>")).otherwise(J.elements(F.col("_value")))
    # A comma asks for a value; only the array's very beginning may be followed by its end.
    enough = F.col("_only") | (F.size(elements) > 0) | (F.col("_first") & ~F.col("whole"))
    sound = F.coalesce(elements.isNotNull() & enough, F.lit(False))
    groups = durable(read.select("file_path", "pos", elements.alias("elements"), sound.alias("ok"), "whole"), "json-groups")
    # A whole array ends with a group that no object ends.
    judged = groups.groupBy("file_path").agg((F.bool_and("ok") & (F.count_if(~F.col("whole")) == 1)).alias("good"))
    files_ = files.join(judged, "file_path", "left").select(
        "file_path", "listed", F.when(F.col("listed"), F.col("valid") & F.coalesce("good", F.lit(False))).alias("valid")
    )
    others = known.where("not listed").groupBy("file_path").agg(F.collect_list(piece).alias("pieces"), F.bool_or("open_end").alias("open_end"))
    others = others.select("file_path", _text("pieces", ~F.col("open_end")).alias("content"))
    return Elements(groups.drop("whole"), files_, others)
