"""One query per operator: ``name -> function(spark, sf_dir)``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestone.functions.text import category_slug, normalise_unicode
from lodestone.functions.urls import base_name, content_path, is_valid_url, safe_url_name
from lodestone.operators import capture as C
from lodestone.operators import grouping as G
from lodestone.operators import harvest as V
from lodestone.operators import questions as Q
from lodestone.operators import replies as R
from lodestone.operators import search as S
from lodestone.operators import url_records as U
from lodestone.plans import jobs
from lodestone.session import durable, run_dir
from lodestone.sources import files, sinks
from lodestone.sources.document_files import can_open
from workload import inputs as I

ENTRY = ["item_pos", "category_pos", "category", *jobs.ENTRY_FIELDS]
INSTRUCTION = "Put the question into one of the existing categories or name a new one."
QNA_TEMPLATE = "Write question and answer pairs about {domain_of_expertise} as {json}."
TOPIC_TEMPLATE = "List questions about {topic}."

_indexes: dict[tuple[str, str], S.PageIndex] = {}


def page_index(spark: SparkSession, sf: str) -> S.PageIndex:
    """The page index, built once per session and read by every search."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _indexes:
        _indexes[key] = jobs.index_pages(files.read_pages(spark, f"{sf}/pages.parquet"))
    return _indexes[key]


def _records(spark, sf):
    return U.explode_urls(U.read_url_documents(I.url_documents(spark, sf)))


def _web(spark, sf):
    return U.web_only(dedupe_in_documents(spark, sf))


def _items(spark, sf):
    return C.pages_to_markdown(I.scrape_items(spark, sf))


def _metadata(spark, sf):
    paths = I.url_documents(spark, sf).select("file_path")
    return C.capture_metadata(_items(spark, sf), U.url_dimension(_web(spark, sf)), paths)


def _stored(spark, sf):
    items = durable(_items(spark, sf), "items")
    paths = I.url_documents(spark, sf).select("file_path")
    return C.stored_documents(items, C.capture_metadata(items, U.url_dimension(_web(spark, sf)), paths))


def _pairs(spark, sf):
    return R.explode_qna(R.decode_qna(I.qna_replies(spark, sf)))


# URL files


def url_validity(spark, sf):
    return I.links(spark, sf).select("url").distinct().withColumn("is_valid", is_valid_url(F.col("url")))


def file_status(spark, sf):
    return U.read_url_documents(I.url_documents(spark, sf)).select("file_path", "status")


def explode_urls(spark, sf):
    return _records(spark, sf)


def split_url_files(spark, sf):
    """The same files in pieces, as a reader that splits files gives them."""
    parts = F.split("content", r"\}")
    closed = F.endswith("content", F.lit("}"))
    pieces = I.url_documents(spark, sf).select(
        "file_path",
        F.octet_length("content").cast("long").alias("file_size"),
        F.posexplode(F.when(closed, F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)).alias("n", "part"),
    )
    pieces = pieces.select("file_path", F.floor(F.col("n") / 5).alias("block"), F.col("n").cast("long").alias("id"), "file_size", "part")
    return U.explode_urls(U.read_url_pieces(pieces))


def dedupe_per_file(spark, sf):
    return U.dedupe_per_file(_records(spark, sf))


def dedupe_in_documents(spark, sf):
    return U.dedupe_in_documents(U.read_url_documents(I.url_documents(spark, sf)))


def web_urls(spark, sf):
    return _web(spark, sf).select("file_path", "url")


def distinct_urls(spark, sf):
    return U.distinct_urls(_web(spark, sf))


def url_dimension_last_wins(spark, sf):
    return U.url_dimension(_web(spark, sf))


def duplicates_removed(spark, sf):
    return U.duplicates_removed(_web(spark, sf))


# Names and paths


def category_slugs(spark, sf):
    return I.questions(spark, sf).select("category").distinct().withColumn("slug", category_slug(F.col("category")))


def slug_collisions(spark, sf):
    named = I.questions(spark, sf).withColumn("slug", category_slug(F.col("category")))
    return G.collisions(named, "slug", "category")


def safe_url_names(spark, sf):
    return I.links(spark, sf).select("url").distinct().withColumn("safe_name", safe_url_name(F.col("url")))


def content_paths(spark, sf):
    links = I.links(spark, sf).select("file_path", "url").distinct()
    path = content_path(F.col("file_path"), F.col("url"))
    return links.withColumn("content_path", path).withColumn("name", base_name(path))


def path_collisions(spark, sf):
    path = content_path(F.col("file_path"), F.regexp_replace("url", "/[0-9].*$", ""))
    named = I.links(spark, sf).withColumn("content_path", path)
    return G.collisions(named, "content_path", "url")


# Capture


def html_to_markdown(spark, sf):
    return _items(spark, sf).select("item_pos", "markdown")


def page_metadata(spark, sf):
    return C.with_metadata(I.scrape_items(spark, sf)).select("item_pos", "metadata.*")


def default_metadata(spark, sf):
    """Items that came back empty have no metadata; they get the defaults."""
    items = C.with_success(_items(spark, sf))
    lost = items.withColumn("metadata", F.when(F.col("is_success"), F.col("metadata")))
    return C.with_metadata_defaults(lost).select("item_pos", "metadata.*")


def capture_metadata(spark, sf):
    return _metadata(spark, sf).drop("markdown")


def capture_tally(spark, sf):
    return C.tally(_items(spark, sf))


def unmatched_urls(spark, sf):
    return C.unmatched(U.distinct_urls(_web(spark, sf)).select("url"), _items(spark, sf))


def stored_documents(spark, sf):
    metadata = capture_metadata(spark, sf)
    renamed = metadata.withColumn("content_path", F.regexp_replace("content_path", "^.*/|_[0-9].*$", ""))
    return C.stored_documents(_items(spark, sf), renamed)


def fetched_pages(spark, sf):
    requested = U.distinct_urls(_web(spark, sf))
    return C.fetch(requested, I.table(spark, sf, "pages")).select("item_pos", "metadata.sourceURL", "markdown")


def capture_summary(spark, sf):
    web = durable(_web(spark, sf), "web")
    paths = I.url_documents(spark, sf).select("file_path")
    metadata = C.capture_metadata(_items(spark, sf), U.url_dimension(web), paths)
    return C.stage_summary(web, U.distinct_urls(web), metadata)


# Metadata and report


def metadata_by_category(spark, sf):
    return G.with_group_position(_metadata(spark, sf), "category", "item_pos").select(*ENTRY)


def metadata_blocks(spark, sf):
    rows = _metadata(spark, sf)
    blocks = G.nested_blocks(rows, "category", "item_pos", jobs.ENTRY_FIELDS, "entries", block_rows=32)
    return blocks.select("category", "category_pos", "block", F.posexplode("entries").alias("entry_pos", "e")).select(
        "category", "category_pos", "block", "entry_pos", "e.*"
    )


def question_count_stamp(spark, sf):
    stamped = C.stamp_question_count(_metadata(spark, sf), _pairs(spark, sf))
    return stamped.select("item_pos", "category", "content_path", "question_count")


def first_category_preview(spark, sf):
    return G.first_group(_metadata(spark, sf), "category", "item_pos").select("item_pos", "category", *jobs.ENTRY_FIELDS)


def stage_counts(spark, sf):
    lengths = U.url_list_lengths(I.url_documents(spark, sf))
    return jobs.stage_counts(lengths, _stored(spark, sf), _pairs(spark, sf))


def aggregated_metadata(spark, sf):
    blocks = jobs.aggregate_metadata(_metadata(spark, sf), _pairs(spark, sf))
    return blocks.select("category", "category_pos", "block", F.posexplode("entries").alias("entry_pos", "e")).select(
        "category", "category_pos", "block", "entry_pos", "e.*"
    )


def captured_documents(spark, sf):
    """The capture job from URL records to stored documents, with the pages as they are."""
    paths = I.url_documents(spark, sf).select("file_path")
    return jobs.capture(_records(spark, sf), paths, I.table(spark, sf, "pages")).documents


# Questions


def _flat_questions(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc",
        "category",
        "category_pos",
        "q_pos",
        "question",
        "dorks",
        F.size("urls").alias("n_urls"),
        F.col("urls")[0].alias("first_url"),
    )


def questions_list_form(spark, sf):
    return _flat_questions(Q.normalise_questions(I.question_documents(spark, sf, "list")))


def questions_map_form(spark, sf):
    return _flat_questions(Q.normalise_questions(I.question_documents(spark, sf, "map")))


def questions_normalised_unicode(spark, sf):
    """Decomposed letters in documents become the composed ones that the table has."""
    decomposed = I.question_documents(spark, sf, "list").withColumn("content", F.replace("content", F.lit("é"), F.lit("e\u0301")))
    return _flat_questions(Q.normalise_questions(decomposed, unicode=True))


def raw_questions(spark, sf):
    rows = Q.normalise_questions(I.question_documents(spark, sf, "map"), normalise=False)
    return rows.select("doc", "category", "category_pos", "q_pos", "question")


def category_block_last_wins(spark, sf):
    kept = Q.last_block_wins(Q.question_blocks(I.question_documents(spark, sf, "map")))
    size = F.size(F.try_variant_get("questions", "$", "array<variant>"))
    return kept.select("doc", "category", "category_pos", size.alias("n_questions"))


def question_rejects(spark, sf):
    return Q.question_rejects(I.question_documents(spark, sf, "list"))


def normalised_unicode(spark, sf):
    apart = F.replace(F.col("question"), F.lit("\u00e9"), F.lit("e\u0301"))
    return I.questions(spark, sf).select("qid", normalise_unicode(apart).alias("question"))


# Search


def search_query_text(spark, sf):
    rows = I.questions(spark, sf)
    own = S.prepare_queries(rows, "site:example.net")
    shared = S.prepare_queries(rows, "site:example.net", honour_overrides=False)
    return own.select("qid", F.lit(True).alias("own"), "dorks", "query").unionByName(
        shared.select("qid", F.lit(False).alias("own"), "dorks", "query")
    )


def supplied_url_bypass(spark, sf):
    supplied, _ = S.supplied_urls(S.prepare_queries(I.questions(spark, sf)))
    return supplied.select("qid", F.posexplode("urls").alias("url_pos", "url"))


def page_words(spark, sf):
    return page_index(spark, sf).postings


def word_frequency(spark, sf):
    return page_index(spark, sf).frequency


def bm25_impacts(spark, sf):
    index = page_index(spark, sf)
    counted = index.postings.join(index.frequency, "token")
    return S.bm25_impacts(index, counted).select("token", "page_id", "impact")


def _top(spark, sf, query, k=S.RESULT_COUNT, weigh=S.bm25_impacts, short_lists=S.SHORT_LISTS):
    rows = I.questions(spark, sf).select(F.col("qid").alias("query_id"), query.alias("query"))
    best = S.top_pages(S.with_search_terms(rows), page_index(spark, sf), weigh, k, short_lists)
    return best.withColumnRenamed("query_id", "qid")


def corpus_top_k(spark, sf):
    return _top(spark, sf, F.col("question"))


def corpus_top_k_by_floor(spark, sf):
    """The same ranking with every query taking the way meant for long page lists."""
    return _top(spark, sf, F.col("question"), short_lists=0)


def matches_top_k(spark, sf):
    return _top(spark, sf, F.col("question"), S.SECOND_RESULT_COUNT, S.match_impacts)


def dork_site_filter(spark, sf):
    return _top(spark, sf, F.concat("question", F.lit(" site:example.org")))


def dork_filetype_filter(spark, sf):
    return _top(spark, sf, F.concat("question", F.lit(" site:com filetype:html site:example.com")))


def _results(spark, sf):
    return S.retrieve(I.questions(spark, sf), page_index(spark, sf))


def search_results(spark, sf):
    return _results(spark, sf).select(
        "qid", "category", "question", "dorks", "error", F.posexplode_outer("urls").alias("url_pos", "url")
    )


def retrieved_urls(spark, sf):
    """The retrieval job with an index of its own."""
    found = jobs.retrieve_urls(I.questions(spark, sf), files.read_pages(spark, f"{sf}/pages.parquet"))
    return found.select("qid", "category", "question", "dorks", "error", F.posexplode_outer("urls").alias("url_pos", "url"))


def results_by_category(spark, sf):
    return _results(spark, sf).groupBy("category").agg(
        F.min("qid").alias("category_pos"),
        F.count(F.lit(1)).alias("n_results"),
        F.sum(F.size("urls")).alias("n_urls"),
        F.count("error").alias("n_errors"),
    )


def grouped_results(spark, sf):
    nested = jobs.results_by_category(_results(spark, sf))
    rows = nested.select("category", "category_pos", "block", F.posexplode("results").alias("result_pos", "r"))
    return rows.select("category", "category_pos", "block", "result_pos", "r.question", "r.dorks", F.size("r.urls").alias("n_urls"), "r.error")


def two_engine_union(spark, sf):
    both = S.retrieve_two_engines(I.questions(spark, sf), page_index(spark, sf))
    return both.select("engine", "qid", F.posexplode("urls").alias("url_pos", "url"))


# Pairs


def qna_prompts(spark, sf):
    documents = _stored(spark, sf).select("item_pos", "content_path", "markdown")
    return R.qna_prompts(documents, QNA_TEMPLATE, "Software Engineering")


def decode_status(spark, sf):
    return R.decode_qna(I.qna_replies(spark, sf)).select("prompt_id", "decode_status")


def decode_qna(spark, sf):
    return _pairs(spark, sf)


def prompts_with_replies(spark, sf):
    asked = I.exchanges(spark, sf).select("prompt_id")
    replies = I.qna_replies(spark, sf).where("reply is not null")
    decoded = R.decode_qna(asked.join(replies, "prompt_id", "left"))
    return decoded.select("prompt_id", "decode_status", F.coalesce(F.size("_pairs"), F.lit(0)).alias("n_pairs"))


# Question generation and categories


def topic_prompts(spark, sf):
    topics = I.questions(spark, sf).select("category").distinct().withColumnRenamed("category", "topic")
    return R.question_prompts(topics, TOPIC_TEMPLATE)


def first_good_attempt(spark, sf):
    chosen = R.first_good_attempt(I.question_attempts(spark, sf))
    return chosen.select("topic_id", "attempt", "n_tried", F.col("questions")[0].alias("first_question"))


def exhausted_topics(spark, sf):
    return R.first_good_attempt(I.question_attempts(spark, sf)).where("attempt is null").select("topic_id", "n_tried")


def generated_questions(spark, sf):
    return R.explode_generated(R.first_good_attempt(I.question_attempts(spark, sf)))


def attempt_status(spark, sf):
    return R.decode_question_list(I.question_attempts(spark, sf)).select("topic_id", "attempt", "decode_status")


def _answers(spark, sf):
    return R.decode_categories(I.category_replies(spark, sf))


def category_reply_status(spark, sf):
    return _answers(spark, sf).select("pos", "decode_status")


def running_categories(spark, sf):
    return R.running_vocabulary(R.answered_categories(_answers(spark, sf)))


def category_vocabulary(spark, sf):
    return R.vocabulary(R.answered_categories(_answers(spark, sf)))


def categorisation_prompts(spark, sf):
    asked = I.questions(spark, sf).select(F.col("qid").alias("pos"), "question")
    return R.categorisation_prompts(asked, R.answered_categories(_answers(spark, sf)), INSTRUCTION)


def categorise_fold(spark, sf):
    return G.with_group_position(R.categorised(_answers(spark, sf)), "category", "pos")


def categorised_blocks(spark, sf):
    blocks = G.nested_blocks(R.categorised(_answers(spark, sf)), "category", "pos", ["question"], "questions")
    return blocks.select("category", "category_pos", "block", F.posexplode("questions").alias("q_pos", "question"))


def categorisation_counts(spark, sf):
    return R.categorisation_counts(_answers(spark, sf))


def generated_and_categorised(spark, sf):
    attempts = I.question_attempts(spark, sf)
    asked = R.explode_generated(R.first_good_attempt(attempts)).select(
        "topic_id",
        "q_pos",
        F.col("topic_id").alias("pos"),
        F.concat(
            F.lit('{"response":"{\\"question\\":\\"q'),
            F.col("topic_id"),
            F.lit('\\",\\"category\\":\\"c'),
            F.col("topic_id") % 7,
            F.lit('\\"}"}'),
        ).alias("reply"),
    )
    return jobs.generate_and_categorise(attempts, asked).select("category", "category_pos", "pos", "question")


# Harvest


def harvest_urls(spark, sf):
    return V.harvest_urls(I.nested_documents(spark, sf)).select("doc", "value_pos", "url")


def harvest_urls_pdf(spark, sf):
    return V.harvest_urls_with_pdf(I.nested_documents(spark, sf))


def harvest_status(spark, sf):
    return V.harvest_status(I.url_documents(spark, sf).withColumnRenamed("file_path", "doc"))


# Files


def _fresh(spark: SparkSession, label: str) -> str:
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def url_files_roundtrip(spark, sf):
    """Results written per category slug and read back as URL records."""
    results = I.links(spark, sf).groupBy("category", "question", "conv_id", "turn").agg(
        F.expr("transform(sort_array(collect_list(struct(j, url))), x -> x.url)").alias("urls")
    )
    target = _fresh(spark, "url-files")
    sinks.write_results(results.withColumn("qid", F.expr("conv_id * 1000 + turn")).drop("conv_id", "turn"), target)
    back = files.read_result_tables(spark, target)
    return back.select("slug", "qid", "category", "question", F.posexplode("urls").alias("url_pos", "url"))


def categories_searched_again(spark, sf):
    """All results written, then those of questions with operators once more: only their categories' folders change."""
    results = I.questions(spark, sf).select("qid", "category", "question", "dorks", F.array("dorks").alias("urls"), F.lit(None).cast("string").alias("error"))
    target = _fresh(spark, "category-files")
    sinks.write_results(results, target)
    again = results.where("dorks <> ''").withColumn("error", F.lit("searched again"))
    sinks.write_results(again, target)
    return files.read_result_tables(spark, target).select("slug", "qid", "category", "question", "dorks", "error")


def written_metadata(spark, sf):
    target = _fresh(spark, "metadata")
    sinks.write_blocks(jobs.aggregate_metadata(_metadata(spark, sf)), target)
    entry = "content_path string, question_count bigint, url string, source_type string"
    back = spark.read.schema(f"category string, category_pos bigint, block bigint, entries array<struct<{entry}>>").json(target)
    return back.select("category", "category_pos", "block", F.posexplode("entries").alias("entry_pos", "e")).select(
        "category", "category_pos", "block", "entry_pos", "e.*"
    )


def written_pairs(spark, sf):
    target = _fresh(spark, "pairs")
    sinks.write_pairs(_pairs(spark, sf), target)
    return spark.read.schema("q string, a string").json(target)


def written_questions(spark, sf):
    target = _fresh(spark, "questions")
    sinks.write_questions(generated_questions(spark, sf), target)
    return files.read_generated_questions(spark, target, lines=True)


def recorded_replies(spark, sf):
    target = _fresh(spark, "replies")
    I.qna_replies(spark, sf).write.parquet(target)
    return R.decode_qna(files.read_replies(spark, target)).select("prompt_id", "decode_status")


def markdown_files_roundtrip(spark, sf):
    """Documents written and read back whole: as ``.md`` files where Arrow opens the shared folder, else as a table."""
    rows = C.with_success(_items(spark, sf)).where("is_success")
    named = rows.select(F.concat(F.lit("d"), F.col("item_pos"), F.lit(".md")).alias("content_path"), "markdown")
    target = _fresh(spark, "documents")
    if can_open(target):
        sinks.write_markdown_files(named, target)
        return files.read_markdown(spark, target).select("content_path", "markdown")
    sinks.write_documents(named, target)
    return spark.read.parquet(target)


def _run(spark, sf):
    pages = I.table(spark, sf, "pages")
    answered = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("url").alias("q"), F.col("url").alias("a"))).alias("qnaList")).alias("response")))
    replies = pages.select(F.col("page_id").alias("prompt_id"), answered.alias("reply"))
    return jobs.run_all(I.questions(spark, sf), pages, replies, page_index(spark, sf))


def end_to_end_counts(spark, sf):
    return _run(spark, sf).counts


def end_to_end_pairs(spark, sf):
    return _run(spark, sf).pairs.select("content_path", "prompt_id", "pair_pos", "q", "a")


ALL = [
    url_validity,
    file_status,
    explode_urls,
    split_url_files,
    dedupe_per_file,
    dedupe_in_documents,
    web_urls,
    distinct_urls,
    url_dimension_last_wins,
    duplicates_removed,
    category_slugs,
    slug_collisions,
    safe_url_names,
    content_paths,
    path_collisions,
    html_to_markdown,
    page_metadata,
    capture_metadata,
    capture_tally,
    unmatched_urls,
    stored_documents,
    fetched_pages,
    capture_summary,
    metadata_by_category,
    metadata_blocks,
    question_count_stamp,
    first_category_preview,
    stage_counts,
    aggregated_metadata,
    captured_documents,
    questions_list_form,
    questions_map_form,
    raw_questions,
    category_block_last_wins,
    question_rejects,
    normalised_unicode,
    search_query_text,
    supplied_url_bypass,
    page_words,
    word_frequency,
    bm25_impacts,
    corpus_top_k,
    corpus_top_k_by_floor,
    matches_top_k,
    dork_site_filter,
    dork_filetype_filter,
    search_results,
    retrieved_urls,
    results_by_category,
    two_engine_union,
    qna_prompts,
    decode_status,
    decode_qna,
    prompts_with_replies,
    topic_prompts,
    attempt_status,
    first_good_attempt,
    exhausted_topics,
    generated_questions,
    category_reply_status,
    running_categories,
    category_vocabulary,
    categorisation_prompts,
    categorise_fold,
    categorised_blocks,
    categorisation_counts,
    generated_and_categorised,
    harvest_urls,
    harvest_urls_pdf,
    harvest_status,
    url_files_roundtrip,
    categories_searched_again,
    markdown_files_roundtrip,
    end_to_end_counts,
    end_to_end_pairs,
    written_metadata,
    written_pairs,
    written_questions,
    recorded_replies,
    default_metadata,
    grouped_results,
    questions_normalised_unicode,
]
