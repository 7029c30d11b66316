"""Prompts and recorded model replies: rendering, decoding, retrying."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodestone.functions import json as J
from lodestone.functions.text import quoted
from lodestone.operators.skew import count_before, salted_join
from lodestone.session import durable

MAX_ATTEMPTS = 5
#: Categories that are printed together for prompts.
VOCABULARY_BLOCK = 256


def render(template: str, name: str, value: str) -> str:
    """Fill one ``{name}``; other braces are left alone."""
    return template.replace("{" + name + "}", value)


def qna_prompts(documents: DataFrame, template: str, domain: str) -> DataFrame:
    """Prompt and size of every document ``(content_path, markdown)``."""
    head = render(template, "domain_of_expertise", domain)
    return documents.select(
        "content_path",
        F.concat(F.lit(head + "\n"), F.col("markdown")).alias("prompt"),
        F.char_length("markdown").alias("n_chars"),
    )


def question_prompts(topics: DataFrame, template: str) -> DataFrame:
    """Question-generation prompt of every topic."""
    return topics.withColumn("prompt", F.replace(F.lit(template), F.lit("{topic}"), F.col("topic")))


def _opened(replies: DataFrame) -> DataFrame:
    """Add the parsed envelope, its ``response`` and that value parsed when it is text."""
    response = F.col("_response")
    return (
        replies.withColumn("_envelope", J.parsed(F.col("reply")))
        .withColumn("_response", J.member(F.col("_envelope"), "response"))
        .withColumn("_text", F.when(J.is_text(response), J.as_text(response)))
        .withColumn("_inner", F.when(F.col("_text").isNull(), response).otherwise(J.parsed(F.col("_text"))))
    )


def _envelope_status(response_ok: Column) -> Column:
    """The first part of every decode status."""
    return (
        F.when(F.col("reply").isNull(), "no_reply")
        .when(F.coalesce(~J.is_object(F.col("_envelope")), F.lit(True)), "bad_reply")
        .when(~response_ok, "no_response")
    )


def _without_working(df: DataFrame) -> DataFrame:
    return df.drop("reply", "_envelope", "_response", "_text", "_inner")


def decode_qna(replies: DataFrame) -> DataFrame:
    """Add ``decode_status`` and the list of pairs to replies ``(prompt_id, reply)``.

    ``response`` may be an object or its JSON text. Anything else yields no pairs and
    a status that says why.
    """
    opened = _opened(replies).withColumn("_list", J.member(F.col("_inner"), "qnaList"))
    opened = opened.withColumn("_elements", J.elements(F.col("_list")))
    status = (
        _envelope_status(F.col("_response").isNotNull())
        .when(F.col("_inner").isNull(), "bad_json")
        .when(F.col("_list").isNull(), "no_list")
        .when(F.col("_elements").isNull(), "bad_list")
        .otherwise("ok")
    )
    decoded = J.computed_once(opened, decode_status=status, _pairs=F.col("_elements"))
    return _without_working(decoded).drop("_list", "_elements")


def explode_qna(decoded: DataFrame) -> DataFrame:
    """One row per pair, in reply order."""
    kept = [c for c in decoded.columns if c not in ("_pairs", "decode_status")]
    pair = F.col("_pair")
    return decoded.select(*kept, F.posexplode("_pairs").alias("pair_pos", "_pair")).select(
        *kept, "pair_pos", J.as_text(J.member(pair, "q")).alias("q"), J.as_text(J.member(pair, "a")).alias("a")
    )


def decode_question_list(attempts: DataFrame) -> DataFrame:
    """Add ``decode_status`` and ``_items`` to attempts ``(topic_id, attempt, reply)``."""
    opened = _opened(attempts).withColumn("_elements", J.elements(F.col("_inner")))
    status = (
        _envelope_status(F.col("_response").isNotNull())
        .when(F.col("_text").isNull() | F.col("_inner").isNull(), "bad_json")
        .when(~J.truthy(F.col("_inner")), "empty")
        .when(F.col("_elements").isNull(), "not_a_list")
        .otherwise("ok")
    )
    questions = F.transform("_elements", lambda e: J.as_text(J.member(e, "question")))
    decoded = J.computed_once(opened, decode_status=status, questions=questions)
    return _without_working(decoded).drop("_elements")


def first_good_attempt(attempts: DataFrame, retries: int = MAX_ATTEMPTS) -> DataFrame:
    """Per topic the earliest usable attempt; ``attempt`` is null where there is none."""
    decoded = decode_question_list(attempts.where(F.col("attempt").between(1, retries)))
    good = F.when(F.col("decode_status") == "ok", F.col("attempt"))
    return decoded.groupBy("topic_id").agg(
        F.min(good).alias("attempt"), F.min_by("questions", good).alias("questions"), F.count(F.lit(1)).alias("n_tried")
    )


def explode_generated(chosen: DataFrame) -> DataFrame:
    """Questions of the chosen attempts, in reply order."""
    return chosen.where(F.col("attempt").isNotNull()).select(
        "topic_id", "attempt", F.posexplode("questions").alias("q_pos", "question")
    )


def decode_categories(replies: DataFrame) -> DataFrame:
    """Add ``decode_status``, the reply's own question text and its category.

    Input is ``(pos, reply)``; a text counts only where the status is ``ok``.
    """
    opened = (
        _opened(replies)
        .withColumn("_category", J.member(F.col("_inner"), "category"))
        .withColumn("_question", J.member(F.col("_inner"), "question"))
    )
    status = (
        _envelope_status(J.truthy(F.col("_response")))
        .when(F.col("_text").isNull() | F.col("_inner").isNull(), "bad_json")
        .when(~J.truthy(F.col("_inner")), "empty")
        .when(F.col("_category").isNull(), "no_category")
        .when(F.col("_question").isNull(), "no_question")
        .when(~J.truthy(F.col("_category")), "empty_category")
        .otherwise("ok")
    )
    decoded = J.computed_once(
        opened,
        decode_status=status,
        answer_question=J.as_text(F.col("_question")),
        answer_category=J.as_text(F.col("_category")),
    )
    return _without_working(decoded).drop("_category", "_question")


def categorised(decoded: DataFrame) -> DataFrame:
    """Usable categorisations: position, category and the reply's question text."""
    return decoded.where(F.col("decode_status") == "ok").select(
        "pos", F.col("answer_category").alias("category"), F.col("answer_question").alias("question")
    )


def answered_categories(decoded: DataFrame) -> DataFrame:
    """``(pos, category)`` of every question, null where the answer is unusable.

    Written once: the vocabulary operators read it several times.
    """
    usable = F.when(F.col("decode_status") == "ok", F.col("answer_category"))
    return durable(decoded.select("pos", usable.alias("category")), "answers")


def _first_uses(answers: DataFrame) -> DataFrame:
    return answers.where(F.col("category").isNotNull()).groupBy("category").agg(F.min("pos").alias("pos"))


def running_vocabulary(answers: DataFrame) -> DataFrame:
    """``(pos, n_existing)``: how many categories were known before each question."""
    firsts = _first_uses(answers).select("pos", F.lit(True).alias("_new"))
    flagged = answers.select("pos").join(firsts, "pos", "left")
    return count_before(flagged, "pos", F.col("_new").isNotNull(), "n_existing").select("pos", "n_existing")


def vocabulary(answers: DataFrame) -> DataFrame:
    """Categories in first-seen order, numbered from zero."""
    return count_before(_first_uses(answers), "pos", F.lit(True), "category_pos").select("category", "category_pos")


def categorisation_prompts(questions: DataFrame, answers: DataFrame, instruction: str, block: int = VOCABULARY_BLOCK) -> DataFrame:
    """The prompt each question was categorised with, running category list included.

    The vocabulary is printed in blocks of neighbouring categories. A prompt holds all
    blocks before its own, joined once for each block that prompts end in, and the part of
    its own block that was known. No row or task holds more of the vocabulary than a
    prompt that is its result.
    """
    running = durable(running_vocabulary(answers), "running")
    known = vocabulary(answers).select(F.col("category_pos").alias("p"), quoted(F.col("category")).alias("c"))
    blocks = known.groupBy(F.floor(F.col("p") / block).alias("block")).agg(F.sort_array(F.collect_list(F.struct("p", "c"))).alias("_named"))
    blocks = durable(blocks.select("block", F.transform("_named", lambda x: x["c"]).alias("names")), "vocabulary-blocks")
    ends = running.select(F.floor(F.col("n_existing") / block).alias("end")).distinct().where("end > 0")
    before = ends.select("end", F.explode(F.sequence(F.lit(0), F.col("end") - 1)).alias("block"))
    heads = before.join(blocks.select("block", F.array_join("names", ", ").alias("text")), "block").groupBy("end")
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("_texts"))
    heads = heads.select(F.col("end").alias("block"), F.array_join(F.transform("_texts", lambda x: x["text"]), ", ").alias("head"))
    asked = questions.join(running, "pos").withColumns(
        {"block": F.floor(F.col("n_existing") / block), "rest": (F.col("n_existing") % block).cast("int")}
    )
    # Late questions mostly end in the same block.
    asked = salted_join(salted_join(asked, heads, ["block"], ["pos"]), blocks, ["block"], ["pos"])
    rest = F.when(F.col("rest") > 0, F.array_join(F.slice("names", F.lit(1), F.greatest("rest", F.lit(1))), ", "))
    prompt = F.concat(
        F.lit(f"Instruction: {instruction} Question: "),
        F.col("question"),
        F.lit("\nExisting categories: ["),
        F.concat_ws(", ", "head", rest),
        F.lit("]"),
    )
    return asked.select("pos", "n_existing", prompt.alias("prompt"))


def categorisation_counts(decoded: DataFrame) -> DataFrame:
    """One row: questions asked and categories found."""
    good = F.col("decode_status") == "ok"
    return decoded.agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.count_distinct(F.when(good, F.col("answer_category"))).alias("n_categories"),
    )
