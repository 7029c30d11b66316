"""URLs from JSON of any shape, at any depth, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestone.functions.json import FALSY, computed_once, is_one_value
from lodestone.functions.urls import is_valid_url
from lodestone.session import durable

#: Bytes of documents whose tokens a task sorts; a document is in one task, however large.
PART_BYTES = 2 << 20

# A string literal and, for an object key, the colon after it; a bracket; any other literal.
TOKEN = r'"[^"\\]*+(?:\\[\s\S][^"\\]*+)*+"(?:\s*+:)?|[{}\[\]]|[^\s"{}\[\]:,]++'


def harvest_status(documents: DataFrame) -> DataFrame:
    """``(doc, status)``: ``ok``, or ``invalid_json`` for documents that give no rows."""
    status = F.when(is_one_value(F.col("content")), "ok").otherwise("invalid_json")
    return documents.select("doc", status.alias("status"))


def _text(literal: Column) -> Column:
    """What a string literal stands for."""
    plain = F.substr(literal, F.lit(2), F.length(literal) - 2)
    wrapped = F.concat(F.lit('{"v":'), literal, F.lit("}"))
    return F.when(F.contains(literal, F.lit("\\")), F.get_json_object(wrapped, "$.v")).otherwise(plain)


def _dealt(documents: DataFrame) -> DataFrame:
    """Documents dealt over as many tasks as their size asks for, two at least.

    Tokens are many times as large as their document, so the number of tasks that fits the
    documents does not fit the tokens.
    """
    kept = durable(documents.select("doc", "content"), "documents")
    size = kept.agg(F.sum(F.octet_length("content"))).first()[0] or 0
    return kept.repartition(max(2, -(-size // PART_BYTES)), "doc")


def _tokens(documents: DataFrame) -> DataFrame:
    """Tokens ``(doc, at, token, next, after, opens, named, container, name)`` of valid documents that count.

    ``container`` is the place of the bracket around a token, its own for a bracket that
    opens; ``next`` and ``after`` are the two tokens behind. Of a key that an object
    repeats, all values but the last are gone with everything in them. Depth is a running
    sum of brackets, so nesting has no limit but the JSON parser's; a document is one
    task's work, documents are dealt over all.
    """
    literal = F.col("token")
    found = _dealt(documents).where(is_one_value(F.col("content"))).select(
        "doc", F.posexplode(F.regexp_extract_all("content", F.lit(TOKEN), F.lit(0))).alias("at", "token")
    )
    opens, closes = literal.isin("{", "["), literal.isin("}", "]")
    along = Window.partitionBy("doc").orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = found.withColumns({"opens": opens, "closes": closes, "named": F.startswith("token", F.lit('"')) & F.endswith("token", F.lit(":"))})
    depth = F.sum(F.col("opens").cast("int") - F.col("closes").cast("int")).over(upto)
    steps = steps.withColumns({"level": depth + F.col("closes").cast("int"), "next": F.lead("token").over(along), "after": F.lead("token", 2).over(along)})
    # Brackets that match and what is right between them have one level.
    level = Window.partitionBy("doc", "level").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumns(
        {
            "container": F.last(F.when(F.col("opens"), F.col("at")), ignorenulls=True).over(level),
            "name": F.when(F.col("named"), _text(F.regexp_replace("token", r"\s*:\z", ""))),
        }
    )
    latest = F.max("at").over(Window.partitionBy("doc", "container", "name"))
    steps = steps.withColumn("old", F.col("named") & (F.col("at") < latest))
    steps = steps.withColumn("dead", F.coalesce(F.lag("old").over(along), F.lit(False)))
    ended = F.col("closes") & F.coalesce(F.last(F.when(F.col("opens"), F.col("dead")), ignorenulls=True).over(level), F.lit(False))
    steps = steps.withColumn("ended", ended)
    inside = F.sum((F.col("opens") & F.col("dead")).cast("int") - F.col("ended").cast("int")).over(upto)
    steps = steps.withColumn("inside", inside)
    kept = steps.where("inside = 0 and not dead and not ended and not old and not closes")
    return kept.select("doc", "at", "token", "next", "after", "opens", "named", "container", "name")


def _numbered(values: DataFrame) -> DataFrame:
    """Valid URLs, numbered among all values of their document."""
    order = Window.partitionBy("doc").orderBy("at")
    numbered = computed_once(values.withColumn("value_pos", F.row_number().over(order) - 1), url=_text(F.col("literal")))
    return numbered.where(is_valid_url(F.col("url")))


def _string() -> Column:
    return F.startswith("token", F.lit('"')) & ~F.col("named")


def harvest_urls(documents: DataFrame) -> DataFrame:
    """Every valid URL among the string values of ``(doc, content)``, in document order.

    Of a repeated key the last value counts, at its own place. Documents that are no JSON
    give no rows; ``harvest_status`` names them.
    """
    values = _tokens(documents).where(_string()).select("doc", "at", F.col("token").alias("literal"))
    return _numbered(values).select("doc", "value_pos", "url")


def harvest_urls_with_pdf(documents: DataFrame) -> DataFrame:
    """``(url, is_pdf)`` of every object with a URL, and of every URL string.

    An object's ``url`` shows up twice: once with the object's flag, once as a plain
    string without one. Repeated keys and bad documents as in ``harvest_urls``.
    """
    within = Window.partitionBy("doc", "container")
    value = F.col("next")
    empty = ((value == "{") & (F.col("after") == "}")) | ((value == "[") & (F.col("after") == "]"))
    truth = ~(value.rlike(FALSY) | empty)
    # A literal is a value here, as its key stands before it; a key that follows would have its colon.
    address = F.when((F.col("name") == "url") & F.startswith("next", F.lit('"')), value)
    found = _tokens(documents).withColumns(
        {
            "address": F.max(address).over(within),
            "flag": F.coalesce(F.max(F.when(F.col("name") == "is_pdf", truth)).over(within), F.lit(False)),
        }
    )
    is_object = (F.col("token") == "{") & F.col("address").isNotNull()
    values = found.where(_string() | is_object).select(
        "doc", "at", F.when(is_object, F.col("address")).otherwise(F.col("token")).alias("literal"), (is_object & F.col("flag")).alias("is_pdf")
    )
    return _numbered(values).select("doc", "value_pos", "url", "is_pdf")
