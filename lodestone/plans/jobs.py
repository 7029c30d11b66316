"""The composite jobs. Each returns lazy DataFrames; nothing here writes results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from lodestone.operators import capture as C
from lodestone.operators import replies as R
from lodestone.operators import search as S
from lodestone.operators import url_records as U
from lodestone.operators.grouping import nested_blocks, with_group_position
from lodestone.functions.html import to_markdown
from lodestone.session import durable

RESULT_FIELDS = ["question", "dorks", "urls", "error"]
ENTRY_FIELDS = ["content_path", "question_count", "url", "source_type"]


@dataclass(frozen=True)
class Capture:
    """Outcome of a capture run."""

    metadata: DataFrame
    documents: DataFrame
    tally: DataFrame
    unmatched: DataFrame


def index_pages(pages: DataFrame) -> S.PageIndex:
    """Search index over the Markdown of ``pages(page_id, url, html)``."""
    return S.build_index(pages.select("page_id", "url", to_markdown(F.col("html")).alias("body")))


def retrieve_urls(
    questions: DataFrame,
    pages: DataFrame,
    k: int = S.RESULT_COUNT,
    dorks: str | None = None,
    honour_overrides: bool = True,
) -> DataFrame:
    """Questions to search results."""
    return S.retrieve(questions, index_pages(pages), k, dorks, honour_overrides)


def capture(records: DataFrame, files: DataFrame, pages: DataFrame, root: str = "") -> Capture:
    """URL records to stored documents, their metadata and the scrape tally."""
    dimension = durable(U.url_dimension(U.web_only(U.dedupe_per_file(records))), "urls")
    watched, tally = C.counted(C.fetch(dimension, pages))
    items = durable(watched, "scraped")
    metadata = C.capture_metadata(items, dimension, files, root).drop("markdown")
    return Capture(
        metadata=metadata,
        documents=C.stored_documents(items, metadata),
        tally=tally(),
        unmatched=C.unmatched(dimension.select("url"), items),
    )


@dataclass(frozen=True)
class Qna:
    """Prompts of documents, the state of their replies, and the pairs."""

    prompts: DataFrame
    statuses: DataFrame
    pairs: DataFrame


def generate_qna(documents: DataFrame, replies: DataFrame, template: str, domain: str) -> Qna:
    """Documents to prompts of a domain, and recorded replies ``(prompt_id, reply)`` to pairs with their lineage.

    A document's ``item_pos`` is its prompt's identifier; one without a reply has a status.
    """
    asked = documents.select(F.col("item_pos").alias("prompt_id"), "content_path")
    decoded = R.decode_qna(asked.join(replies, "prompt_id", "left"))
    return Qna(
        prompts=R.qna_prompts(documents, template, domain),
        statuses=decoded.select("prompt_id", "content_path", "decode_status"),
        pairs=R.explode_qna(decoded),
    )


def build_qna(documents: DataFrame, replies: DataFrame) -> DataFrame:
    """The pairs alone, where prompts are at hand."""
    return generate_qna(documents, replies, "", "").pairs


def results_by_category(results: DataFrame, pos: str = "qid") -> DataFrame:
    """Search results nested per category in bounded blocks, categories by first appearance."""
    return nested_blocks(results, "category", pos, RESULT_FIELDS, "results")


def aggregate_metadata(metadata: DataFrame, qna: DataFrame | None = None) -> DataFrame:
    """Metadata per category, in bounded blocks; the pair total is stamped on when given."""
    rows = metadata if qna is None else C.stamp_question_count(metadata, qna)
    return nested_blocks(C.entry_defaults(rows), "category", "item_pos", ENTRY_FIELDS, "entries")


def stage_counts(n_urls: DataFrame, documents: DataFrame, qna: DataFrame) -> DataFrame:
    """One row: URLs retrieved, documents stored, pairs generated."""
    return (
        n_urls.agg(F.coalesce(F.sum("n_urls"), F.lit(0)).cast("long").alias("n_urls"))
        .crossJoin(documents.agg(F.count(F.lit(1)).alias("n_documents")))
        .crossJoin(qna.agg(F.count(F.lit(1)).alias("n_pairs")))
    )


def generate_and_categorise(attempts: DataFrame, category_replies: DataFrame) -> DataFrame:
    """Recorded attempts and categorisations to a question table in first-seen order.

    ``category_replies`` is ``(topic_id, q_pos, pos, reply)``, one row per question
    that was put to the model, ``pos`` being its place in the sequence.
    """
    generated = R.explode_generated(R.first_good_attempt(attempts))
    asked = generated.select("topic_id", "q_pos").join(category_replies, ["topic_id", "q_pos"])
    rows = R.categorised(R.decode_categories(asked.select("pos", "reply")))
    return with_group_position(rows, "category", "pos").select(
        "category",
        "category_pos",
        "pos",
        "question",
        F.lit(None).cast("string").alias("dorks"),
        F.lit(None).cast("array<string>").alias("urls"),
    )


@dataclass(frozen=True)
class Run:
    """Outcome of a full run: results as filed, what was captured, pairs, and the final counts."""

    filed: DataFrame
    captured: Capture
    pairs: DataFrame
    counts: DataFrame


def run_all(
    questions: DataFrame, pages: DataFrame, replies: DataFrame, index: S.PageIndex | None = None, pos: str = "qid"
) -> Run:
    """Questions to pairs: search, capture, replies. The URL count is taken as results are written."""
    results = S.retrieve(questions, index or index_pages(pages)).select(pos, "category", "question", "urls")
    seen = Observation()
    filed = durable(U.filed_results(results, pos).observe(seen, F.coalesce(F.sum(F.size("urls")), F.lit(0)).alias("n_urls")), "results")
    n_urls = questions.sparkSession.createDataFrame([seen.get], "n_urls bigint")
    captured = capture(U.result_records(filed, pos), filed.select("file_path"), pages)
    pairs = build_qna(captured.documents, replies)
    return Run(filed, captured, pairs, stage_counts(n_urls, captured.documents, pairs))


def full_run(
    questions: DataFrame, pages: DataFrame, replies: DataFrame, index: S.PageIndex | None = None, pos: str = "qid"
) -> DataFrame:
    """Questions to the final counts: search, capture, pairs, report."""
    return run_all(questions, pages, replies, index, pos).counts
