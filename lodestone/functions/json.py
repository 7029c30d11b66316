"""JSON helpers that keep absent keys, null values and value types apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# JSON text of every value Python counts as false.
FALSY = r'^(?:null|false|""|\[\]|\{\}|-?0(?:\.0*)?(?:[eE].*)?)$'


def is_one_value(text: Column) -> Column:
    """True where the text holds one JSON value and nothing after it.

    A text that closes the array early has the same length in both, and so fails one.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return alone & (F.json_array_length(F.concat(F.lit("["), text, F.lit(",0]"))) == 2)


def parsed(text: Column) -> Column:
    """VARIANT of a whole JSON text, null when the text is not exactly one JSON value."""
    return F.when(is_one_value(text), F.try_parse_json(text))


def member(value: Column, key: str) -> Column:
    """Value under ``key``: SQL null when absent, a VARIANT null when it is JSON null."""
    return F.try_variant_get(value, f"$.{key}", "variant")


def as_text(value: Column) -> Column:
    """A string as it is, JSON null as null, any other value as its JSON text."""
    return F.try_variant_get(value, "$", "string")


def elements(value: Column) -> Column:
    """Array elements; null when the value is not an array."""
    return F.try_variant_get(value, "$", "array<variant>")


def is_text(value: Column) -> Column:
    return F.startswith(F.to_json(value), F.lit('"'))


def is_object(value: Column) -> Column:
    return F.startswith(F.to_json(value), F.lit("{"))


def truthy(value: Column) -> Column:
    """Python's truth value; an absent value is false."""
    return F.coalesce(~F.to_json(value).rlike(FALSY), F.lit(False))


def map_pairs(text: Column) -> Column:
    """Top-level pairs of a JSON object as ``array<struct<key, value>>``.

    Source order and repeated keys are kept, which VARIANT objects do not do.
    """
    return F.map_entries(F.from_json(text, "map<string,variant>", {"allowSingleQuotes": "false"}))


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns whose expressions later filters and projections do not repeat.

    Catalyst moves a filter below a projection by repeating the projected expression
    in it; it does not do so below a generator.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))
