"""Question documents in list or map form to one question table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestone.functions import json as J
from lodestone.functions.text import normalise_unicode


def question_blocks(documents: DataFrame) -> DataFrame:
    """Category blocks of question documents ``(doc, content)``.

    A list holds ``{category, questions}`` objects; a map holds categories as keys.
    ``reject`` says why a block cannot be used. Map keys may be empty, categories of
    the list form may not.
    """
    content = F.col("content")
    null = F.lit(None).cast("string")
    mapped = F.transform(
        "_pairs", lambda p: F.struct(p["key"].alias("category"), p["value"].alias("questions"), null.alias("reject"))
    )
    typed = (
        documents.withColumn("_map", content.rlike(r"^\s*\{"))
        .withColumn("_pairs", F.when(F.col("_map") & J.is_one_value(content), J.map_pairs(content)))
        .withColumn("_list", F.when(~F.col("_map"), J.elements(J.parsed(content))))
        .withColumn("_blocks", F.when(F.col("_map"), mapped).otherwise(F.transform("_list", _list_block)))
    )
    no_questions, reason = F.lit(None).cast("variant"), F.lit("unsupported_structure")
    whole = F.array(F.struct(null.alias("category"), no_questions.alias("questions"), reason.alias("reject")))
    return typed.select("doc", F.posexplode(F.coalesce("_blocks", whole)).alias("block_pos", "b")).select(
        "doc",
        "block_pos",
        "b.category",
        "b.questions",
        F.coalesce("b.reject", F.when(J.elements(F.col("b.questions")).isNull(), "questions_not_a_list")).alias("reject"),
    )


def _list_block(block: Column) -> Column:
    category, questions = J.member(block, "category"), J.member(block, "questions")
    reject = F.when(~J.is_object(block), "not_an_object").when(~J.truthy(category), "missing_category")
    return F.struct(
        J.as_text(category).alias("category"),
        F.coalesce(questions, F.parse_json(F.lit("[]"))).alias("questions"),
        reject.alias("reject"),
    )


def last_block_wins(blocks: DataFrame) -> DataFrame:
    """A repeated category keeps its first position and its last block's questions."""
    return (
        blocks.where(F.col("reject").isNull())
        .groupBy("doc", "category")
        .agg(F.min("block_pos").alias("category_pos"), F.max_by("questions", "block_pos").alias("questions"))
    )


def explode_questions(blocks: DataFrame, normalise: bool = True) -> DataFrame:
    """Questions of the blocks, with positions; ``reject`` marks unusable elements.

    An object's ``question`` counts even when null; ``q`` is read only where the key
    is absent. With ``normalise=False`` only plain strings are accepted.
    """
    e = F.col("_element")
    named, short = J.member(e, "question"), J.member(e, "q")
    position = [c for c in ("block_pos", "category_pos") if c in blocks.columns]
    staged = (
        blocks.select("doc", "category", *position, F.posexplode(J.elements(F.col("questions"))).alias("q_pos", "_element"))
        .withColumn("_text", J.is_text(e))
        .withColumn("_object", J.is_object(e))
    )
    usable = F.col("_text") | F.col("_object") if normalise else F.col("_text")
    question = F.when(named.isNotNull(), J.as_text(named)).when(short.isNotNull(), J.as_text(short)).otherwise("")
    return J.computed_once(
        staged,
        question=F.when(F.col("_text"), J.as_text(e)).when(F.col("_object"), question),
        dorks=F.when(F.col("_object"), J.as_text(J.member(e, "dorks"))),
        urls=F.when(F.col("_object"), F.transform(J.elements(J.member(e, "urls")), J.as_text)),
        reject=F.when(~usable, "invalid_question"),
    ).drop("_element", "_text", "_object")


def normalise_questions(documents: DataFrame, normalise: bool = True, unicode: bool = False) -> DataFrame:
    """Usable questions of all documents; with ``unicode`` their text and categories in NFC.

    Categories are normalised before repeated ones are told apart.
    """
    blocks = question_blocks(documents)
    if unicode:
        blocks = blocks.withColumn("category", normalise_unicode(F.col("category")))
    found = explode_questions(last_block_wins(blocks), normalise).where(F.col("reject").isNull()).drop("reject")
    return found.withColumn("question", normalise_unicode(F.col("question"))) if unicode else found


def question_rejects(documents: DataFrame, normalise: bool = True) -> DataFrame:
    """Every block and element that a strict load would stop at."""
    blocks = question_blocks(documents)
    bad_blocks = blocks.where(F.col("reject").isNotNull()).select(
        "doc", "block_pos", F.lit(None).cast("int").alias("q_pos"), "category", "reject"
    )
    bad_elements = (
        explode_questions(blocks.where(F.col("reject").isNull()), normalise)
        .where(F.col("reject").isNotNull())
        .select("doc", "block_pos", "q_pos", "category", "reject")
    )
    return bad_blocks.unionByName(bad_elements)


def strict_questions(documents: DataFrame, normalise: bool = True) -> DataFrame:
    """Like ``normalise_questions``, but the job fails at the first reject."""
    first = question_rejects(documents, normalise).agg(F.min("reject").alias("_reject"))
    guard = first.select(
        F.when(F.col("_reject").isNull(), True).otherwise(
            F.raise_error(F.concat(F.lit("invalid question data: "), F.col("_reject"))).cast("boolean")
        ).alias("_ok")
    )
    return normalise_questions(documents, normalise).crossJoin(guard).where("_ok").drop("_ok")
