"""Plans that must hold at any size: checked on the text of the physical plan."""

import re

import pytest
from lodestone.operators import url_records as U
from workload import queries as W

SF = "/root/testdata/sf0.001"

NATIVE = [
    W.explode_urls, W.dedupe_per_file, W.url_dimension_last_wins, W.questions_list_form, W.question_rejects, W.decode_qna, W.first_good_attempt, W.running_categories, W.harvest_urls, W.harvest_urls_pdf, W.split_url_files,
    W.corpus_top_k, W.search_results,
]

# These read every page in one Arrow step, and run nothing else in Python.
CONVERTED = [W.html_to_markdown, W.capture_metadata, W.metadata_by_category, W.metadata_blocks]


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", [*NATIVE, *CONVERTED], ids=lambda q: q.__name__)
def test_no_python_and_no_global_window(spark, query):
    text = plan(query(spark, SF))
    python = re.findall(r"ArrowEvalPython \[\w+|BatchEvalPython|MapInPandas|MapInArrow|CartesianProduct", text)
    assert set(python) == ({"ArrowEvalPython [_page"} if query in CONVERTED else set())
    for window in re.findall(r"Window \[.*", text):
        assert "windowspecdefinition(" in window
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            # only a total without keys, or a sorted head of one row, may end in one task
            assert re.search(r"Aggregate\(keys?=\[\]", lines[i + 1]) or "LocalLimit" in lines[i + 1], lines[i + 1]


def test_top_k_is_cut_before_the_shuffle(spark):
    text = plan(W.corpus_top_k(spark, SF))
    assert re.search(r"WindowGroupLimit.*Partial", text) and re.search(r"WindowGroupLimit.*Final", text)


def test_aggregates_start_before_the_shuffle(spark):
    text = plan(W.url_dimension_last_wins(spark, SF))
    assert "partial_max_by" in text and "partial_min" in text


def test_files_are_deduplicated_without_a_shuffle(spark):
    documents = spark.createDataFrame([("a.json", "[]")], "file_path string, content string")
    assert "Exchange" not in plan(U.dedupe_in_documents(U.read_url_documents(documents)))


def test_unused_text_is_not_read(spark):
    text = plan(W.page_metadata(spark, SF).select("item_pos", "sourceURL"))
    scans = re.findall(r"ReadSchema: (\S+)", text)
    assert scans and all("html" not in s for s in scans)
    text = plan(W.category_slugs(spark, SF))
    assert all("text" not in s for s in re.findall(r"ReadSchema: (\S+)", text))
    assert "PushedFilters: [IsNotNull(role), EqualTo(role,user)]" in text


def test_markdown_is_computed_once(spark):
    assert plan(W.capture_tally(spark, SF)).count("ArrowEvalPython") == 1
