"""HTML pages to Markdown and metadata."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from lodestone.functions.markdown import convert

DEFAULT_LANGUAGE = "en"
PAGE = T.StructType([T.StructField(n, T.StringType()) for n in ("markdown", "title", "description", "language")])


#: Pages that are Python objects at once; an Arrow batch may hold many more.
AT_ONCE = 128


def _converted(html: pa.Array) -> pa.Array:
    nothing = (None,) * len(PAGE.names)
    rows = [nothing if text is None else convert(text) for text in html.to_pylist()]
    # A lone surrogate is no text that Arrow could hold.
    safe = [tuple(v and v.encode("utf-8", "replace").decode() for v in row) for row in rows]
    return pa.StructArray.from_arrays([pa.array([row[i] for row in safe], pa.string()) for i in range(len(PAGE.names))], PAGE.names)


@F.arrow_udf(PAGE)
def _page(html: pa.Array) -> pa.Array:
    return pa.concat_arrays([_converted(html.slice(at, AT_ONCE)) for at in range(0, max(1, len(html)), AT_ONCE)])


def page(html: Column) -> Column:
    """``struct<markdown, title, description, language>`` of a page; fields are null for a null page.

    Built-in functions can't keep a stack of open elements without copying it for every
    token, so pages go through one pass in Arrow batches. Put the result below a generator
    (``json.computed_once``) where several steps read it.
    """
    return _page(html)


def to_markdown(html: Column) -> Column:
    return page(html)["markdown"]


def title(html: Column) -> Column:
    """Text of the title element; empty without one."""
    return page(html)["title"]


def description(html: Column) -> Column:
    """Content of the description; empty without one."""
    return page(html)["description"]


def language(html: Column) -> Column:
    """The language that the root element names, or the default."""
    found = page(html)["language"]
    return F.when(html.isNotNull(), F.coalesce(F.nullif(found, F.lit("")), F.lit(DEFAULT_LANGUAGE)))
