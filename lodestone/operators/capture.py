"""Requested URLs to stored documents and capture metadata."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, functions as F

from lodestone.functions import html as H
from lodestone.functions.json import computed_once
from lodestone.functions.urls import content_path
from lodestone.operators.membership import bit_table, may_match
from lodestone.operators.skew import FEW_SALTS, salted_join
from lodestone.session import durable

# Fixed values used where nothing better is known.
NO_CATEGORY = "Uncategorized"
NO_QUESTION = "No Question"
SOURCE_TYPE = "web"
UNKNOWN_SOURCE = "unknown"


def _metadata(found: Column) -> Column:
    language = F.when(F.col("html").isNotNull(), F.coalesce(F.nullif(found["language"], F.lit("")), F.lit(H.DEFAULT_LANGUAGE)))
    return F.struct(
        F.col("url").alias("sourceURL"), found["title"].alias("title"), found["description"].alias("description"), language.alias("language")
    )


def with_metadata(pages: DataFrame) -> DataFrame:
    """Add title, description and language of ``(url, html)`` rows as ``metadata``."""
    return pages.withColumn("metadata", _metadata(H.page(F.col("html"))))


def pages_to_markdown(pages: DataFrame) -> DataFrame:
    """``(item_pos, url, html)`` to ``(item_pos, markdown, metadata)``.

    A page is read once for both, even where later steps filter on them.
    """
    read = computed_once(pages, _page=H.page(F.col("html")))
    return read.select("item_pos", F.col("_page.markdown").alias("markdown"), _metadata(F.col("_page")).alias("metadata"))


def fetch(requested: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages of the requested URLs as scrape items; the page id is the item position."""
    # Found on narrow rows, so that texts are moved for the pages asked for at most.
    found = pages.select("page_id", "url").join(requested.select("url"), "url", "left_semi")
    found = durable(found.select("page_id").distinct(), "found")
    # Pages that nobody asked for are dropped in the scan, before texts are moved. A semi-join
    # would be moved below that step.
    wanted = may_match(pages, "page_id", bit_table(found, "page_id")).join(found, "page_id")
    return pages_to_markdown(wanted.select(F.col("page_id").alias("item_pos"), "url", "html"))


def unmatched(requested: DataFrame, items: DataFrame) -> DataFrame:
    """Requested URLs no scrape item came back for."""
    returned = items.select(F.col("metadata.sourceURL").alias("url")).distinct()
    return requested.join(returned, "url", "left_anti")


def with_success(items: DataFrame) -> DataFrame:
    return items.withColumn("is_success", F.coalesce(F.col("markdown") != "", F.lit(False)))


def with_metadata_defaults(items: DataFrame) -> DataFrame:
    """Default metadata where an item has none at all; single absent fields stay absent."""
    empty = F.struct(
        F.lit(None).cast("string").alias("sourceURL"),
        F.lit("").alias("title"),
        F.lit("").alias("description"),
        F.lit(H.DEFAULT_LANGUAGE).alias("language"),
    )
    return items.withColumn("metadata", F.coalesce("metadata", empty))


def tally(items: DataFrame) -> DataFrame:
    """Success and failure counts of a completed scrape: only returned items count."""
    seen = with_success(items)
    return seen.agg(
        F.count_if("is_success").alias("n_success"), F.count_if(~F.col("is_success")).alias("n_failed")
    )


def counted(items: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``items`` and, once an action has run over them, their ``tally``: counted as they pass, without a pass of its own."""
    seen = Observation()
    good = F.coalesce(F.col("markdown") != "", F.lit(False))
    watched = items.observe(seen, F.count_if(good).alias("n_success"), F.count_if(~good).alias("n_failed"))
    row = lambda: items.sparkSession.createDataFrame([seen.get], "n_success bigint, n_failed bigint")
    return watched, row


def failed_scrape_tally(requested: DataFrame) -> DataFrame:
    """Counts of a scrape that ended in an error before any item came back."""
    return requested.agg(F.lit(0).cast("long").alias("n_success"), F.count(F.lit(1)).alias("n_failed"))


def capture_metadata(items: DataFrame, dimension: DataFrame, files: DataFrame, root: str = "") -> DataFrame:
    """Metadata row and document of every successful scrape item with a URL.

    ``dimension`` is ``url_dimension``; ``files`` lists all URL files found as
    ``file_path``, readable or not: the first in order is the fallback.
    """
    good = (
        with_metadata_defaults(with_success(items).where("is_success"))
        .withColumn("url", F.col("metadata.sourceURL"))
        .where(F.coalesce(F.col("url"), F.lit("")) != "")
        .select("item_pos", "url", "markdown")
    )
    known = dimension.select("url", "category", "question", "input_file", F.lit(True).alias("_known"))
    fallback = files.agg(F.min("file_path").alias("_first_file"))
    joined = salted_join(good, known, ["url"], ["item_pos"], salts=FEW_SALTS).crossJoin(fallback)
    known_flag = F.col("_known").isNotNull()
    source = F.when(known_flag, F.col("input_file")).otherwise(F.col("_first_file"))
    return joined.select(
        "item_pos",
        F.when(known_flag, F.col("category")).otherwise(NO_CATEGORY).alias("category"),
        F.when(known_flag, F.col("question")).otherwise(NO_QUESTION).alias("question"),
        content_path(source, F.col("url"), root).alias("content_path"),
        "url",
        F.lit(SOURCE_TYPE).alias("source_type"),
        F.lit(0).cast("long").alias("question_count"),
        "markdown",
    )


def stored_documents(items: DataFrame, metadata: DataFrame) -> DataFrame:
    """The document each path ends up with: ``(item_pos, content_path, markdown)``.

    Winners are chosen on narrow rows; the texts are joined on once, by item.
    """
    # Item positions are unique, so the largest of a path names its last document.
    written = metadata.groupBy("content_path").agg(F.max("item_pos").alias("item_pos"))
    return items.select("item_pos", "markdown").join(written, "item_pos").select("item_pos", "content_path", "markdown")


def stage_summary(records: DataFrame, requested: DataFrame, metadata: DataFrame) -> DataFrame:
    """One row: URLs extracted, URLs processed, documents saved."""
    return (
        records.agg(F.count(F.lit(1)).alias("n_extracted"))
        .crossJoin(requested.agg(F.count(F.lit(1)).alias("n_processed")))
        .crossJoin(metadata.agg(F.count(F.lit(1)).alias("n_saved")))
    )


def stamp_question_count(metadata: DataFrame, qna: DataFrame) -> DataFrame:
    """Put the total number of pairs on every metadata row."""
    total = qna.agg(F.count(F.lit(1)).alias("_total"))
    return metadata.drop("question_count").crossJoin(total).withColumnRenamed("_total", "question_count")


def entry_defaults(metadata: DataFrame) -> DataFrame:
    """Defaults for metadata tables that lack a column; present nulls stay null."""
    defaults = {
        "category": F.lit(NO_CATEGORY),
        "content_path": F.lit(None).cast("string"),
        "question_count": F.lit(0).cast("long"),
        "url": F.lit(None).cast("string"),
        "source_type": F.lit(UNKNOWN_SOURCE),
    }
    return metadata.withColumns({c: v for c, v in defaults.items() if c not in metadata.columns})
