"""URL result files to URL records, and the last-wins rules over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestone.functions import json as J
from lodestone.functions.text import category_slug
from lodestone.functions.urls import is_valid_url
from lodestone.operators.grouping import group_key
from lodestone.operators.json_split import array_elements
from lodestone.operators.skew import salted_join
from lodestone.session import durable

NO_CATEGORY = "Uncategorized"

_ITEMS = "array<struct<url:string,question:string,is_pdf:boolean,bad:boolean>>"


def _item(url: Column, question: Column, is_pdf: Column) -> Column:
    """One candidate URL; a truthy value that is not a string spoils its file."""
    return F.struct(
        F.when(J.is_text(url), J.as_text(url)).alias("url"),
        question.alias("question"),
        is_pdf.alias("is_pdf"),
        (J.truthy(url) & ~J.is_text(url)).alias("bad"),
    )


def _spoiled() -> Column:
    null, no, yes = F.lit(None).cast("string"), F.lit(False), F.lit(True)
    return F.array(F.struct(null.alias("url"), null.alias("question"), no.alias("is_pdf"), yes.alias("bad")))


def _none() -> Column:
    return F.array().cast(_ITEMS)


def _list_block(entry: Column, position: Column) -> Column:
    """Block of one ``{category, question, urls}`` entry."""
    question = J.as_text(J.member(entry, "question"))
    urls = J.member(entry, "urls")
    named = F.transform(
        F.json_object_keys(J.as_text(urls)),
        lambda k: F.struct(
            k.alias("url"), question.alias("question"), F.lit(False).alias("is_pdf"), F.lit(False).alias("bad")
        ),
    )
    items = (
        F.when(~J.is_object(entry), _spoiled())
        .when(urls.isNull() | J.is_text(urls), _none())
        .when(J.is_object(urls), named)
        .otherwise(F.coalesce(F.transform(J.elements(urls), lambda u: _item(u, question, F.lit(False))), _spoiled()))
    )
    named_category = J.member(entry, "category")
    category = F.when(named_category.isNull(), NO_CATEGORY).otherwise(J.as_text(named_category))
    return F.struct(position.alias("entry_pos"), category.alias("category"), items.alias("items"))


def _map_block(category: Column, entries: Column, position: Column) -> Column:
    """Block of one ``category: [{url, question, is_pdf}]`` pair."""
    listed = F.transform(
        J.elements(entries),
        lambda e: F.when(
            J.is_object(e),
            _item(J.member(e, "url"), J.as_text(J.member(e, "question")), J.truthy(J.member(e, "is_pdf"))),
        ).otherwise(_spoiled()[0]),
    )
    nothing = F.to_json(entries).isin('""', "{}")
    items = F.when(nothing, _none()).otherwise(F.coalesce(listed, _spoiled()))
    return F.struct(position.alias("entry_pos"), category.alias("category"), items.alias("items"))


def _last_of_each_key(pairs: Column) -> Column:
    """Pairs with repeated keys resolved: last value, first position."""
    keys = F.transform(pairs, lambda p: p["key"])
    numbered = F.transform(pairs, lambda p, i: F.struct(i.alias("i"), p["key"].alias("key"), p["value"].alias("value")))
    resolved = F.transform(
        F.filter(numbered, lambda p: p["i"] == F.size(keys) - F.array_position(F.reverse(keys), p["key"])),
        lambda p: F.struct(
            (F.array_position(keys, p["key"]) - 1).cast("int").alias("i"), p["key"].alias("key"), p["value"].alias("value")
        ),
    )
    return F.when(F.size(F.array_distinct(keys)) == F.size(keys), numbered).otherwise(resolved)


def read_url_documents(documents: DataFrame) -> DataFrame:
    """Classify each URL file ``(file_path, content)`` and lay out its blocks.

    ``status`` is ``ok`` or the reason why the whole file is skipped.
    """
    content = F.col("content")
    listed = F.transform(J.elements(F.col("_value")), lambda e, i: _list_block(e, i))
    mapped = F.transform(F.col("_pairs"), lambda p: _map_block(p["key"], p["value"], p["i"]))
    staged = (
        documents.withColumn("_map", content.rlike(r"^\s*\{"))
        .withColumn("_value", F.when(~F.col("_map"), J.parsed(content)))
        .withColumn("_source", F.when(F.col("_map") & J.is_one_value(content), J.map_pairs(content)))
        .withColumn("_pairs", _last_of_each_key(F.col("_source")))
        .withColumn("_blocks", F.when(F.col("_map"), mapped).otherwise(listed))
    )
    status = (
        F.when(F.col("_value").isNull() & F.col("_pairs").isNull(), "invalid_json")
        .when(F.col("_blocks").isNull(), "unsupported_structure")
        .when(F.exists("_blocks", lambda b: F.exists(b["items"], lambda x: x["bad"])), "bad_entry")
        .otherwise("ok")
    )
    return J.computed_once(staged, status=status, blocks=F.col("_blocks")).select("file_path", "status", "blocks")


def read_url_pieces(pieces: DataFrame) -> DataFrame:
    """Like ``read_url_documents`` for files read in pieces: a list's blocks come as a row each.

    ``status`` is that of the whole file, on every row of it; ``explode_urls`` and what
    follows read both forms. A file in map form is put together first.
    """
    found = array_elements(pieces)
    blocks = F.transform("elements", lambda e: _list_block(e, F.col("pos").cast("int")))
    laid = durable(found.groups.select("file_path", "pos", blocks.alias("blocks")), "url-blocks")
    spoiled = F.exists("blocks", lambda b: F.exists(b["items"], lambda x: x["bad"]))
    bad = laid.groupBy("file_path").agg(F.bool_or(F.coalesce(spoiled, F.lit(False))).alias("_bad"))
    status = F.when(~F.col("valid"), "invalid_json").when(F.coalesce("_bad", F.lit(False)), "bad_entry").otherwise("ok")
    files = durable(found.files.where("listed").join(bad, "file_path", "left").select("file_path", status.alias("status")), "url-files")
    good = salted_join(laid.where(F.size("blocks") > 0), files.where("status = 'ok'"), ["file_path"], ["pos"], "inner").select("file_path", "status", "blocks")
    # Files that are skipped, and lists without a block, keep one row.
    other = files.join(good.select("file_path").distinct(), "file_path", "left_anti")
    nothing = F.array().cast(laid.schema["blocks"].dataType)
    shown = other.select("file_path", "status", F.when(F.col("status") == "ok", nothing).alias("blocks"))
    return good.unionByName(shown).unionByName(read_url_documents(found.others))


def explode_urls(url_documents: DataFrame) -> DataFrame:
    """Valid URLs of all readable files, with positions."""
    blocks = url_documents.where(F.col("status") == "ok").select("file_path", F.explode("blocks").alias("b"))
    items = blocks.select(
        "file_path", "b.entry_pos", "b.category", F.posexplode("b.items").alias("url_pos", "item")
    )
    return items.select("file_path", "entry_pos", "url_pos", "category", "item.question", "item.url", "item.is_pdf").where(
        is_valid_url(F.col("url"))
    )


def dedupe_per_file(records: DataFrame) -> DataFrame:
    """One row per file and URL: the last record's values at the first record's position."""
    pos = F.struct("entry_pos", "url_pos")
    return (
        records.groupBy("file_path", "url")
        .agg(F.min(pos).alias("first"), F.max_by(F.struct("category", "question", "is_pdf"), pos).alias("last"))
        .select("file_path", "url", "first.entry_pos", "first.url_pos", "last.category", "last.question", "last.is_pdf")
    )


def dedupe_in_documents(url_documents: DataFrame) -> DataFrame:
    """What ``dedupe_per_file`` gives for files that are one row each, without a shuffle.

    A file's valid URLs are sorted by URL and position inside the row; where a URL begins
    is its first position, where it ends are the values that count.
    """

    def listed(b: Column) -> Column:
        item = lambda x, i: F.struct(
            x["url"].alias("url"), b["entry_pos"].alias("entry_pos"), i.alias("url_pos"),
            b["category"].alias("category"), x["question"].alias("question"), x["is_pdf"].alias("is_pdf"),
        )
        return F.filter(F.transform(b["items"], item), lambda x: is_valid_url(x["url"]))

    whole = url_documents.where(F.col("status") == "ok").select("file_path", "blocks")
    found = J.computed_once(whole, _sorted=F.array_sort(F.flatten(F.transform("blocks", listed))))
    other = lambda x, i, step: ~F.get("_sorted", i + step)["url"].eqNullSafe(x["url"])
    firsts = F.filter("_sorted", lambda x, i: other(x, i, -1))
    lasts = F.filter("_sorted", lambda x, i: other(x, i, 1))
    zipped = found.select("file_path", F.inline(F.arrays_zip(firsts.alias("first"), lasts.alias("last"))))
    return zipped.select(
        "file_path", "last.url", "first.entry_pos", "first.url_pos", "last.category", "last.question", "last.is_pdf"
    )


def web_only(file_urls: DataFrame) -> DataFrame:
    """Drop PDF records. Must follow ``dedupe_per_file``: a late PDF flag removes the URL."""
    return file_urls.where(~F.col("is_pdf"))


def url_dimension(web_urls: DataFrame) -> DataFrame:
    """One row per URL: its first place over all files and its last file's metadata."""
    return (
        web_urls.groupBy("url")
        .agg(
            F.min(F.struct("file_path", "entry_pos", "url_pos")).alias("first"),
            F.max_by(F.struct("category", "question", "file_path"), "file_path").alias("last"),
        )
        .select(
            "url",
            F.col("first.file_path").alias("first_file"),
            "first.entry_pos",
            "first.url_pos",
            "last.category",
            "last.question",
            F.col("last.file_path").alias("input_file"),
        )
    )


def distinct_urls(web_urls: DataFrame) -> DataFrame:
    """Every URL once, with the place that orders it."""
    return (
        web_urls.groupBy("url")
        .agg(F.min(F.struct("file_path", "entry_pos", "url_pos")).alias("first"))
        .select("url", "first.file_path", "first.entry_pos", "first.url_pos")
    )


def duplicates_removed(web_urls: DataFrame) -> DataFrame:
    """One row: URLs found, distinct URLs, and the difference."""
    return web_urls.agg(
        F.count(F.lit(1)).alias("n_urls"), F.count_distinct("url").alias("n_distinct")
    ).withColumn("n_removed", F.col("n_urls") - F.col("n_distinct"))


def filed_results(results: DataFrame, pos: str) -> DataFrame:
    """Search results under the file of their category slug.

    When two categories share a slug, the file of the later one replaces the other's.
    Results without a category share a file without a name.
    """
    filed = results.withColumn("file_path", category_slug(F.col("category")))
    filed = filed.withColumns({"_file": group_key("file_path"), "_key": group_key("category")})
    categories = filed.groupBy("_file", "_key").agg(F.min(pos).alias("_first"))
    written = categories.groupBy("_file").agg(F.max_by("_key", "_first").alias("_key"))
    return salted_join(filed, written, ["_file", "_key"], [pos], "left_semi").drop("_file", "_key")


def result_records(filed: DataFrame, pos: str) -> DataFrame:
    """URL records straight from filed search results."""
    listed = F.posexplode("urls").alias("url_pos", "url")
    return (
        filed.select("file_path", F.col(pos).alias("entry_pos"), "category", "question", listed)
        .withColumn("is_pdf", F.lit(False))
        .where(is_valid_url(F.col("url")))
    )


def url_list_lengths(documents: DataFrame) -> DataFrame:
    """``n_urls`` of each file: lengths of its ``urls`` members, valid or not.

    Only the list form and a single object have such members. Counting a file stops
    at a member that has no length.
    """
    value, urls = F.col("_value"), F.col("_urls")

    def length(item: Column) -> Column:
        member = J.member(item, "urls")
        return (
            F.when(member.isNull(), 0)
            .when(J.is_text(member), F.char_length(J.as_text(member)))
            .when(J.is_object(member), F.size(F.json_object_keys(J.as_text(member))))
            .otherwise(F.size(J.elements(member)))
        )

    items = F.coalesce(J.elements(value), F.when(J.is_object(value), F.array(value)))
    stop = F.array_position(F.transform(urls, lambda n: n.isNull()), F.lit(True)).cast("int")
    counted = F.when(stop > 0, F.slice(urls, F.lit(1), stop - 1)).otherwise(urls)
    total = F.aggregate(counted, F.lit(0).cast("long"), lambda acc, n: acc + n)
    return (
        documents.withColumn("_value", J.parsed(F.col("content")))
        .withColumn("_urls", F.transform(items, length))
        .select("file_path", F.coalesce(total, F.lit(0)).alias("n_urls"))
    )
