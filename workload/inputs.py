"""Operator inputs, derived from the driver's tables with plain integer arithmetic.

Every derivation is linear in its tables and has a DuckDB twin in ``oracle.py``.
Documents are cut at 64 turns so that none grows with its conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodestone.sources.files import read_pages

LINKS = 10
TURNS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _json_text(value: Column) -> Column:
    """A column as a JSON value."""
    wrapped = F.to_json(F.struct(value.alias("v")))
    return F.substr(wrapped, F.lit(6), F.length(wrapped) - 6)


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").where("role = 'user'").selectExpr(
        "conv_id * 1000 + turn as qid",
        "conv_id",
        "turn",
        "concat('Topic ', if(conv_id % 13 = 0, '!', '&'), ' ', conv_id % 7, ' (L-', (conv_id + turn) % 3, ')') as category",
        "text as question",
        "case conv_id % 5 when 0 then 'site:example.com' when 1 then 'filetype:html' when 2 then '' end as dorks",
        "if(conv_id % 7 = 3, array(concat('https://supplied.example.org/', conv_id, '/', turn)), null) as urls",
    )


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten page URLs per question, some broken, some flagged as PDF."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    size = pages.agg((F.max("page_id") + 1).alias("n_pages"))
    asked = (
        questions(spark, sf_dir)
        .crossJoin(F.broadcast(size))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(LINKS - 1))))
        .withColumn("page_id", F.expr("(conv_id * 31 + (turn * 3 + j * j) % 23) % n_pages"))
    )
    return asked.select("conv_id", "turn", "j", "category", "question", "page_id").join(pages, "page_id").selectExpr(
        f"concat('topic__', conv_id % 7, '_l_', conv_id % 3, '/c', conv_id, '_', turn div {TURNS}, '.json') as file_path",
        "conv_id",
        "turn",
        "j",
        "category",
        "question",
        "conv_id % 4 = 0 as is_list",
        "case when (page_id + turn) % 19 = 0 then replace(url, '://', ':/')"
        " when page_id % 23 = 0 and conv_id % 2 = 0 then regexp_replace(url, '^(https?://[^/]*)/', '$1_')"
        " else url end as url",
        "conv_id % 4 <> 0 and (page_id + turn + j) % 17 = 0 as is_pdf",
    )


def url_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URL files ``(file_path, content)`` in list and map form, some of them broken."""
    rows = links(spark, sf_dir)
    listed = (
        rows.where("is_list")
        .groupBy("file_path", "conv_id", "turn", "category", "question")
        .agg(F.expr("transform(sort_array(collect_list(struct(j, url))), x -> x.url)").alias("urls"))
        .groupBy("file_path", "conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "category", "question", "urls"))).alias("entries"))
        .withColumn("content", F.to_json("entries"))
    )
    mapped = (
        rows.where("not is_list")
        .groupBy("file_path", "conv_id", "category")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "j", "url", "question", "is_pdf"))).alias("items"))
        .groupBy("file_path", "conv_id")
        .agg(F.sort_array(F.collect_list(F.struct(F.expr("items[0].turn").alias("first"), "category", "items"))).alias("blocks"))
        .withColumn("content", F.to_json(F.map_from_entries(F.expr("transform(blocks, b -> struct(b.category, b.items))"))))
    )
    both = listed.select("file_path", "conv_id", "content").unionByName(mapped.select("file_path", "conv_id", "content"))
    return both.select(
        "file_path",
        F.expr(
            "case when conv_id % 41 = 7 then left(content, length(content) - 1)"
            " when conv_id % 43 = 5 then regexp_replace(content, '\"url(s?)\":', '\"url$1\":7,\"was\":')"
            " else content end"
        ).alias("content"),
    )


def question_documents(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    """Question documents with one block per turn: a text, two objects, odd elements."""
    is_list = form == "list"
    text = _json_text(F.col("question"))
    note = _json_text(F.concat(F.lit("note "), F.col("qid")))
    full = F.concat(F.lit('{"question":'), text, F.lit(',"dorks":"site:a.b","urls":["http://a.b/'), F.col("qid"), F.lit('",null]}'))
    short = F.concat(F.lit('{"q":'), note, F.lit("}"))
    null_question = F.lit('{"question":null,"q":"z"}')
    odd = F.when(F.col("qid") % 11 == 0, F.lit(",5")).when(F.col("qid") % 11 == 1, F.lit(",{}")).otherwise(F.lit(""))
    elements = F.concat(F.lit("["), text, F.lit(","), full, F.lit(","), short, F.lit(","), null_question, odd, F.lit("]"))
    name = F.concat(F.lit("Block "), (F.floor(F.col("turn") / 2) + F.col("conv_id")) % 2)
    category = F.when(F.col("qid") % 17 == 0, "").otherwise(name)
    listed = F.concat(F.lit('{"category":'), _json_text(category), F.lit(',"questions":'), elements, F.lit("}"))
    mapped = F.concat(_json_text(category), F.lit(":"), elements)
    opening, closing = ("[", "]") if is_list else ("{", "}")
    return (
        questions(spark, sf_dir)
        .select(
            F.expr(f"concat('c', conv_id, '_', turn div {TURNS})").alias("doc"),
            "turn",
            (listed if is_list else mapped).alias("block"),
        )
        .groupBy("doc")
        .agg(F.expr("transform(sort_array(collect_list(struct(turn, block))), x -> x.block)").alias("blocks"))
        .select("doc", F.concat(F.lit(opening), F.array_join("blocks", ","), F.lit(closing)).alias("content"))
    )


def scrape_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scrape replies ``(item_pos, url, html)``: empty URLs, empty pages, redirects."""
    pages = read_pages(spark, f"{sf_dir}/pages.parquet")
    plain = pages.selectExpr(
        "page_id * 2 as item_pos",
        "case when page_id % 37 = 5 then '' when page_id % 29 = 3 then concat(url, '/moved') else url end as url",
        "case when page_id % 31 = 7 then '' else html end as html",
    )
    renamed = pages.where("page_id % 23 = 0").selectExpr(
        "page_id * 2 + 1 as item_pos", "regexp_replace(url, '^(https?://[^/]*)/', '$1_') as url", "html"
    )
    return plain.unionByName(renamed)


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user turn and the assistant turn right after it."""
    turns = table(spark, sf_dir, "conversations")
    asked = turns.where("role = 'user'").selectExpr("conv_id", "turn + 1 as turn", "conv_id * 1000 + turn as prompt_id", "text as q")
    answered = turns.where("role = 'assistant'").selectExpr("conv_id", "turn", "text as a")
    return asked.join(answered, ["conv_id", "turn"]).select("prompt_id", (F.col("conv_id") % 6).alias("shape"), "q", "a")


def qna_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded replies ``(prompt_id, reply)`` in six shapes, some prompts without one."""
    pair = F.to_json(F.struct("q", "a"))
    one = F.concat(F.lit('{"qnaList":['), pair, F.lit("]}"))
    two = F.concat(F.lit('{"qnaList":['), pair, F.lit(","), pair, F.lit("]}"))
    as_text = lambda c: F.concat(F.lit('{"response":'), _json_text(c), F.lit("}"))
    shape = F.col("shape")
    reply = (
        F.when(F.col("prompt_id") % 29 == 0, F.lit(None))
        .when(shape == 0, as_text(one))
        .when(shape == 1, F.concat(F.lit('{"response":'), one, F.lit("}")))
        .when(shape == 2, as_text(F.lit("not json")))
        .when(shape == 3, as_text(F.concat(F.lit('{"pairs":['), pair, F.lit("]}"))))
        .when(shape == 4, F.concat(F.lit('{"answer":'), one, F.lit("}")))
        .otherwise(as_text(two))
    )
    return exchanges(spark, sf_dir).select("prompt_id", reply.alias("reply"))


def question_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded attempts ``(topic_id, attempt, reply)``: good, empty and broken ones."""
    kind = (F.col("conv_id") + F.col("turn")) % 3
    good = F.to_json(F.array(F.struct(F.col("text").alias("question"))))
    inner = F.when(kind == 0, good).when(kind == 1, F.lit("[]")).otherwise(F.lit("{oops"))
    return (
        table(spark, sf_dir, "conversations")
        .select(
            F.col("conv_id").alias("topic_id"),
            (F.col("turn") + 1).alias("attempt"),
            F.concat(F.lit('{"response":'), _json_text(inner), F.lit("}")).alias("reply"),
        )
    )


def category_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded categorisations ``(pos, reply)``: empty categories, bad JSON, lost keys."""
    named = F.to_json(F.struct("question", F.expr("if(qid % 9 = 0, '', category)").alias("category")))
    inner = F.when(F.col("qid") % 10 == 3, F.lit("{oops")).when(F.col("qid") % 10 == 7, F.to_json(F.struct("question"))).otherwise(named)
    return questions(spark, sf_dir).select(
        F.col("qid").alias("pos"), F.concat(F.lit('{"response":'), _json_text(inner), F.lit("}")).alias("reply")
    )


def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested JSON document per question: links below a ``payload`` key."""
    entry = F.struct(F.col("url"), F.col("is_pdf"), F.struct(F.col("question").alias("text")).alias("about"))
    return (
        links(spark, sf_dir)
        .groupBy((F.col("conv_id") * 1000 + F.col("turn")).alias("doc"))
        .agg(F.sort_array(F.collect_list(F.struct("j", entry.alias("e")))).alias("rows"))
        .select("doc", F.to_json(F.struct(F.struct(F.transform("rows", lambda r: r["e"]).alias("hits")).alias("payload"))).alias("content"))
    )
