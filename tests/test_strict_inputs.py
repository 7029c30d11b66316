"""Inputs that other readers reject or keep apart."""

from lodestone.operators import harvest as V
from lodestone.operators import url_records as U
from lodestone.sources import files

GOOD = '{"A": [{"url": "http://a/x", "question": "q"}]}'


def test_map_files_are_strict_json(spark):
    texts = {
        "good": GOOD,
        "single quotes": GOOD.replace('"', "'"),
        "text after it": GOOD + "x",
        "closes the array": '{"A": []}],[{}',
        "closes it with a value": '{"A": []},0],[0',
        "two values": GOOD + "," + GOOD,
    }
    documents = spark.createDataFrame(list(texts.items()), "file_path string, content string")
    status = {r.file_path: r.status for r in U.read_url_documents(documents).collect()}
    assert status == {name: "ok" if name == "good" else "invalid_json" for name in texts}


def test_harvest_takes_only_json_and_ends_on_nothing(spark):
    texts = [("good", '["http://a/x"]'), ("text", 'see "http://b/x"'), ("open", '["http://c/x"'), ("lone", '["\\ud83d", "http://d/x"]')]
    texts.append(("deep", "[" * 100_000 + "]" * 100_000))
    documents = spark.createDataFrame(texts, "doc string, content string")
    assert {r.url for r in V.harvest_urls(documents.where("doc <> 'deep'")).collect()} == {"http://a/x", "http://d/x"}
    assert {r.url for r in V.harvest_urls_with_pdf(documents).collect()} == {"http://a/x", "http://d/x"}


def test_equal_json_lines_stay_apart(spark, tmp_path):
    (tmp_path / "lines.json").write_text('{"A": ["x"]}\n{"A": ["x"]}\n{"A": ["y"]}\n')
    rows = files.read_json_lines(spark, str(tmp_path / "lines.json")).collect()
    assert len({r.doc for r in rows}) == 3
    assert [r.content for r in sorted(rows, key=lambda r: r.doc)][2] == '{"A": ["y"]}'


def test_null_category_keeps_its_results(spark):
    rows = spark.createDataFrame([(1, None, "q", ["http://a/x"]), (2, "B", "q", [])], "qid long, category string, question string, urls array<string>")
    assert {r.qid for r in U.filed_results(rows, "qid").collect()} == {1, 2}
