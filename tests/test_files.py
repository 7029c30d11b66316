import json
import os

import pytest

from lodestone.operators import questions as Q
from lodestone.operators import url_records as U
from lodestone.sources import files, sinks
from lodestone.sources.document_files import NamedFilesReader


def put(folder, name, content):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode("utf-8"))
    return str(path)


def test_json_documents_are_found_below_the_root(spark, tmp_path):
    root = tmp_path / "in put+%41"
    put(root, "b.json", json.dumps([{"category": "B", "urls": ["http://b"]}]))
    put(root, "sub/a é.json", json.dumps({"A": [{"url": "http://a"}]}))
    put(root, "sub/x.txt", "no")
    put(root, ".hidden.json", "[]")
    found = files.read_json_documents(spark, str(root))
    assert sorted(r.file_path for r in found.collect()) == ["b.json", "sub/a é.json"]
    records = U.explode_urls(U.read_url_documents(found))
    assert sorted((r.file_path, r.category, r.url) for r in records.collect()) == [("b.json", "B", "http://b"), ("sub/a é.json", "A", "http://a")]


def test_all_but_dot_names_are_read(spark, tmp_path):
    for name in ("_x.json", "sub/_y.json", "_d/z.json", "a.json", ".h.json", "n.txt"):
        put(tmp_path, name, '{"A":[{"url":"http://' + name.replace("/", "-") + '"}]}')
    put(tmp_path, "e.json", "")
    put(tmp_path, "l.json", b"\xff")
    found = files.read_named_json(spark, str(tmp_path))
    read = U.read_url_documents(found)
    assert sorted((r.file_path, r.status) for r in read.collect()) == [
        ("_d/z.json", "ok"), ("_x.json", "ok"), ("a.json", "ok"), ("e.json", "invalid_json"), ("l.json", "invalid_json"), ("sub/_y.json", "ok"),
    ]
    with pytest.raises(FileNotFoundError):
        files.read_named_json(spark, str(tmp_path / "none"))


def test_missing_folders(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_json_documents(spark, str(tmp_path / "none"))
    assert files.read_json_documents(spark, str(tmp_path / "none"), strict=False).count() == 0
    assert files.read_markdown(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "empty").mkdir()
    assert files.read_json_documents(spark, str(tmp_path / "empty")).count() == 0


def test_question_files(spark, tmp_path):
    whole = put(tmp_path, "q.json", json.dumps([{"category": "A", "questions": ["x\ny"]}], indent=4))
    assert [r.question for r in Q.normalise_questions(files.read_json_file(spark, whole)).collect()] == ["x\ny"]
    lines = put(tmp_path, "lines.json", '[{"category":"A","questions":["a"]}]\n{"A":["b"]}\n')
    assert sorted(r.question for r in Q.normalise_questions(files.read_json_lines(spark, lines)).collect()) == ["a", "b"]
    generated = put(tmp_path, "generated.json", json.dumps([{"question": "a"}, {"question": None}], indent=4))
    assert [r.question for r in files.read_generated_questions(spark, generated).collect()] == ["a", None]


def test_markdown_round_trip_skips_other_encodings(spark, tmp_path):
    root = tmp_path / "out"
    rows = [("a/x.md", "one\r\ntwo é\n"), ("y.md", "two")]
    sinks.write_markdown_files(spark.createDataFrame(rows, "content_path string, markdown string"), str(root))
    put(root, "bad.md", b"\xff\xfe")
    put(root, "note.txt", "no")
    assert sorted(tuple(r) for r in files.read_markdown(spark, str(root)).collect()) == rows
    assert sorted(os.listdir(root)) == ["a", "bad.md", "note.txt", "y.md"]


def test_named_files_are_shared_by_bytes(spark, tmp_path):
    sizes = [40, 3, 20, 20, 1, 0]
    for k, mb in enumerate(sizes):
        put(tmp_path, f"_{k}/f{k}.json", "x" * (mb << 20))
    reader = NamedFilesReader(str(tmp_path), ".json")
    shares = [share.names for share in reader.partitions()]
    assert sorted(sum(shares, [])) == [f"_{k}/f{k}.json" for k in range(6)] and len(shares) >= 3
    assert shares[0] == ["_0/f0.json"]
    read = files.read_named_json(spark, f"file://{tmp_path}")
    assert sorted((r.file_path, r.n) for r in read.selectExpr("file_path", "length(content) as n").collect()) == [
        (f"_{k}/f{k}.json", mb << 20) for k, mb in enumerate(sizes)
    ]


def test_a_failed_job_leaves_no_file(spark, tmp_path):
    root = tmp_path / "out"
    good = [(f"a/{k}.md", f"text {k}") for k in range(40)]
    documents = spark.createDataFrame(good, "content_path string, markdown string")
    for bad in ("../escaped.md", "/absolute.md", "folder/", ""):
        rows = documents.union(spark.createDataFrame([(bad, "no")], documents.schema)).repartition(5)
        with pytest.raises(Exception, match="below the target"):
            sinks.write_markdown_files(rows, str(root))
        assert [p for p in tmp_path.rglob("*") if p.is_file()] == []
    sinks.write_markdown_files(documents.repartition(5), f"file://{root}")
    assert sorted(tuple(r) for r in files.read_markdown(spark, str(root)).collect()) == sorted(good)
    assert sorted(os.listdir(root)) == ["a"]


def test_documents_are_added_replaced_or_overwritten(spark, tmp_path):
    root, schema = str(tmp_path / "out"), "content_path string, markdown string"
    sinks.write_markdown_files(spark.createDataFrame([("a.md", "1"), ("b/c.md", "2")], schema), root)
    sinks.write_markdown_files(spark.createDataFrame([("a.md", "3"), ("d.md", None)], schema), root)
    assert {r.content_path: r.markdown for r in files.read_markdown(spark, root).collect()} == {"a.md": "3", "b/c.md": "2"}
    assert (tmp_path / "out" / "d.md").read_text() == ""
    sinks.write_markdown_files(spark.createDataFrame([("e.md", "5")], schema), root, "overwrite")
    assert os.listdir(root) == ["e.md"]
    sinks.write_markdown_files(spark.createDataFrame([], schema), root)
    assert os.listdir(root) == ["e.md"]


def test_writing_one_category_leaves_the_others(spark, tmp_path):
    schema = "qid long, category string, question string, dorks string, urls array<string>, error string"
    target = str(tmp_path / "r")
    sinks.write_results(spark.createDataFrame([(1, "A", "q1", None, ["http://a"], None), (2, "B", "q2", None, [], "none"), (3, "B", "q3", None, [], None)], schema), target)
    sinks.write_results(spark.createDataFrame([(9, "B", "again", None, ["http://b"], None), (10, "C", "new", None, [], None)], schema), target)
    back = files.read_result_tables(spark, target).orderBy("qid").collect()
    assert [(r.slug, r.qid, r.question) for r in back] == [("a", 1, "q1"), ("b", 9, "again"), ("c", 10, "new")]
    engines = str(tmp_path / "e")
    for engine, qid in (("one", 1), ("two", 2), ("one", 3)):
        sinks.write_engine_results(spark.createDataFrame([(qid, "A", "q", None, [], None)], schema).selectExpr("*", f"'{engine}' as engine"), engines)
    assert sorted((r.engine, r.qid) for r in spark.read.json(engines).collect()) == [("one", 3), ("two", 2)]


def test_results_are_filed_by_slug(spark, tmp_path):
    rows = [(1, "A &", "q1", None, ["http://a"], None), (2, "A !", "q2", "d", ["http://b"], None), (3, "B", "q3", None, [], "no results found")]
    results = spark.createDataFrame(rows, "qid long, category string, question string, dorks string, urls array<string>, error string")
    sinks.write_results(results, str(tmp_path / "r"))
    back = files.read_result_tables(spark, str(tmp_path / "r")).orderBy("qid").collect()
    assert [(r.slug, r.qid, r.category, r.dorks, r.urls, r.error) for r in back] == [
        ("a", 2, "A !", "d", ["http://b"], None),
        ("b", 3, "B", None, [], "no results found"),
    ]
    sinks.write_engine_results(results.selectExpr("*", "if(qid = 3, 'one', 'two') as engine"), str(tmp_path / "e"))
    back = spark.read.json(str(tmp_path / "e")).orderBy("qid").collect()
    assert [(r.engine, r.slug, r.qid) for r in back] == [("two", "a", 2), ("one", "b", 3)]


def test_json_sinks(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "a", None)], "prompt_id long, q string, a string")
    sinks.write_pairs(pairs, str(tmp_path / "p"))
    sinks.write_questions(spark.createDataFrame([("x",)], "question string"), str(tmp_path / "q"))
    sinks.write_blocks(spark.createDataFrame([(None, 0, ["x"])], "category string, block int, questions array<string>"), str(tmp_path / "b"))
    sinks.write_documents(spark.createDataFrame([("p.md", "m")], "content_path string, markdown string"), str(tmp_path / "d"))
    text = lambda name: "".join(p.read_text() for p in (tmp_path / name).glob("part-*"))
    assert json.loads(text("p")) == {"q": "a", "a": None}
    assert json.loads(text("q")) == {"question": "x"}
    assert json.loads(text("b")) == {"category": None, "block": 0, "questions": ["x"]}
    assert spark.read.parquet(str(tmp_path / "d")).first().markdown == "m"
