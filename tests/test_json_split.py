"""Arrays read in pieces give what the same texts give when they are read whole."""

import json
import random

import pytest

from lodestone.operators import url_records as U
from lodestone.sources import files

ENTRY = {"category": 'A "}{][" \\', "question": "q\n}", "urls": ["http://a/}", "http://b/\\u007d", "no url"]}
TEXTS = {
    "one": json.dumps([ENTRY]),
    "many": json.dumps([{**ENTRY, "question": f"q{k}"} for k in range(200)]),
    "indented": json.dumps([{**ENTRY, "question": f"q{k}"} for k in range(60)], indent=4),
    "nested": json.dumps([{"category": "N", "question": "q", "urls": {"http://x/{": {"a": [{}]}, "http://y": 1}}, ENTRY]),
    "empty list": " [ ] \n",
    "no objects": "[1, \"x\", [2, 3]]",
    "scalar between": '[{"urls":["http://a"]}, 5, {"urls":["http://b"]}]',
    "scalar last": '[{"urls":["http://a"]}, "x"]',
    "array of arrays": '[[{"urls":["http://a"]}],{"urls":[]}]',
    "map": json.dumps({"A": [{"url": "http://m/}", "question": "q"}], "B": []}),
    "map then text": '{"A":[]} x',
    "no comma": '[{"urls":[]}{"urls":[]}]',
    "comma last": '[{"urls":[]},]',
    "comma first": '[,{"urls":[]}]',
    "two commas": '[{"urls":[]},,{"urls":[]}]',
    "two arrays": '[{"urls":[]}] [{"urls":[]}]',
    "text after": '[{"urls":[]}] x',
    "not ended": '[{"urls":[]}',
    "not ended in a string": '[{"urls":["http://a}',
    "stray quote": '[{"urls":["http://a"]}, {"urls":["http://b""]}, {"urls":["http://c"]}]',
    "closed too often": '[{"urls":[]}]]',
    "escape outside": '[{"urls":[]}, \\{"urls":[]}]',
    "bare text": "hello",
    "blank": "  \n",
    "number": "5",
    "bad url": '[{"urls":["http://a", 7]}]',
    "missing urls": '[{"category":null},{"urls":"text"},{"urls":["http://a"],"category":"C"}]',
}


def split(spark, texts, per_block):
    """Pieces as a reader gives them: parts between braces, and where in the file a range begins."""
    rows = []
    for name, text in texts.items():
        data = text.encode()
        parts = data.split(b"}")
        if parts[-1] == b"":
            parts.pop()
        for k, part in enumerate(parts):
            rows.append((name, k // per_block * 1_000, k, len(data), part.decode()))
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, files.PIECES).repartition(3)


def shown(documents):
    statuses = {(r.file_path, r.status) for r in documents.select("file_path", "status").collect()}
    records = sorted(map(tuple, U.explode_urls(documents).collect()), key=repr)
    return statuses, records


@pytest.mark.parametrize("per_block", [1, 3, 10_000])
def test_pieces_equal_whole_files(spark, per_block):
    whole = spark.createDataFrame(list(TEXTS.items()), "file_path string, content string")
    want, got = shown(U.read_url_documents(whole)), shown(U.read_url_pieces(split(spark, TEXTS, per_block)))
    # A list in which a value is no object is skipped in both; whole files that are no JSON at all are too.
    assert got[0] == want[0]
    assert got[1] == want[1] and len(got[1]) > 400


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    entries = [{"category": f"C{k % 7}", "question": f"question {k} }}{{ \\\"", "urls": [f"http://h{k % 50}.x/{k}", f"http://y/{k}"]} for k in range(20_000)]
    (tmp_path / "large.json").write_text(json.dumps(entries, indent=1))
    (tmp_path / "small.json").write_text(json.dumps({"M": [{"url": "http://m"}]}))
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "200k")
    try:
        pieces = files.read_json_pieces(spark, str(tmp_path))
        assert pieces.rdd.getNumPartitions() > 10
        got = U.explode_urls(U.read_url_pieces(pieces))
        rows = sorted((r.file_path, r.entry_pos, r.url_pos, r.category, r.question, r.url) for r in got.collect())
    finally:
        spark.conf.set(size, before)
    want = [("large.json", k, j, e["category"], e["question"], u) for k, e in enumerate(entries) for j, u in enumerate(e["urls"])]
    assert rows == sorted([*want, ("small.json", 0, 0, "M", None, "http://m")], key=lambda r: r[:3])


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_json_pieces(spark, str(tmp_path / "none"))
    assert U.read_url_pieces(files.read_json_pieces(spark, str(tmp_path / "none"), strict=False)).count() == 0
    assert U.read_url_pieces(files.read_json_pieces(spark, str(tmp_path))).count() == 0
