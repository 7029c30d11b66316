import json
import random

import pytest
from pyspark.sql import functions as F

from lodestone.operators import url_records as U


def test_files_in_one_row_are_deduplicated_alike(spark):
    texts = [
        ("a.json", '{"A":[{"url":"http://u1","question":"q1"},{"url":"http://u2"},{"url":"bad"}],"B":[{"url":"http://u1","question":"q2","is_pdf":true}]}'),
        ("b.json", '[{"category":"C","question":"q","urls":["http://u1","http://u1","http://u3",null]},{"urls":["http://u3"]}]'),
        ("c.json", "[]"), ("d.json", "{oops"), ("e.json", '{"A":[]}'),
    ]
    documents = U.read_url_documents(spark.createDataFrame(texts, "file_path string, content string"))
    one, two = U.dedupe_in_documents(documents), U.dedupe_per_file(U.explode_urls(documents))
    assert one.columns == two.columns
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr) and one.count() == 4


def documents(spark, *contents):
    rows = [(f"f{i}.json", c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "file_path string, content string")


def records(spark, *contents):
    found = U.explode_urls(U.read_url_documents(documents(spark, *contents)))
    return [tuple(r) for r in found.orderBy("file_path", "entry_pos", "url_pos").collect()]


def statuses(spark, *contents):
    return [r.status for r in U.read_url_documents(documents(spark, *contents)).orderBy("file_path").collect()]


def test_list_form(spark):
    got = records(spark, [{"category": "C", "question": "q", "urls": ["http://a", "", None, "bad", 0, "http://b"]}, {"urls": ["http://c"]}, {"category": None}])
    assert got == [
        ("f0.json", 0, 0, "C", "q", "http://a", False),
        ("f0.json", 0, 5, "C", "q", "http://b", False),
        ("f0.json", 1, 0, "Uncategorized", None, "http://c", False),
    ]


def test_null_category_stays_null(spark):
    assert [r[3] for r in records(spark, [{"category": None, "urls": ["http://a"]}])] == [None]


def test_object_urls_are_read_by_key(spark):
    assert [r[5] for r in records(spark, [{"category": "C", "urls": {"http://k": 1}}, {"urls": "http://text"}])] == ["http://k"]


def test_map_form(spark):
    got = records(
        spark,
        '{"B": [{"url":"http://a","question":"q","is_pdf":"x"},{"url":"http://b","is_pdf":0},{"question":"no url"}], "": [{"url":"http://c"}], "E": [], "F": "", "G": {}}',
    )
    assert [r[1:] for r in got] == [
        (0, 0, "B", "q", "http://a", True),
        (0, 1, "B", None, "http://b", False),
        (1, 0, "", None, "http://c", False),
    ]


def test_repeated_map_key_keeps_first_place_and_last_value(spark):
    got = records(spark, '{"A":[{"url":"http://old"}],"B":[{"url":"http://b"}],"A":[{"url":"http://new"}]}')
    assert [(r[1], r[3], r[5]) for r in got] == [(0, "A", "http://new"), (1, "B", "http://b")]


@pytest.mark.parametrize(
    "content, status",
    [
        ("{oops", "invalid_json"),
        ("[1] x", "invalid_json"),
        ('{"a":[]} {"b":[]}', "invalid_json"),
        ('"text"', "unsupported_structure"),
        ("5", "unsupported_structure"),
        ([5], "bad_entry"),
        ([{"urls": None}], "bad_entry"),
        ([{"urls": 7}], "bad_entry"),
        ([{"urls": [7]}], "bad_entry"),
        ([{"urls": [{"a": 1}]}], "bad_entry"),
        ([{"urls": [0, False, [], {}]}], "ok"),
        ({"A": None}, "bad_entry"),
        ({"A": ["x"]}, "bad_entry"),
        ({"A": "x"}, "bad_entry"),
        ({"A": {"x": 1}}, "bad_entry"),
        ({"A": [{"url": 5}]}, "bad_entry"),
        ("[]", "ok"),
        ("{}", "ok"),
    ],
)
def test_a_bad_file_is_skipped_whole(spark, content, status):
    good = [{"category": "C", "urls": ["http://a"]}]
    assert statuses(spark, content, good) == [status, "ok"]


def test_late_pdf_flag_removes_the_url(spark):
    found = U.explode_urls(U.read_url_documents(documents(spark, {"A": [{"url": "http://u1"}, {"url": "http://u2"}, {"url": "http://u1", "is_pdf": True}]})))
    assert [r.url for r in U.web_only(U.dedupe_per_file(found)).collect()] == ["http://u2"]


def test_last_file_names_the_url(spark):
    found = U.explode_urls(
        U.read_url_documents(documents(spark, [{"category": "A", "question": "x", "urls": ["http://u1"]}], [{"category": "B", "question": None, "urls": ["http://u1"]}]))
    )
    (row,) = U.url_dimension(U.web_only(U.dedupe_per_file(found))).collect()
    assert (row.first_file, row.category, row.question, row.input_file) == ("f0.json", "B", None, "f1.json")


def test_dedupe_is_a_dict_per_file(spark):
    random.seed(3)
    rows = [
        (f"f{random.randint(0, 3)}", e, u, random.choice(["A", None]), random.choice(["q1", "q2", None]), f"http://{random.randint(0, 9)}", random.random() < 0.3)
        for e in range(20)
        for u in range(10)
    ]
    frame = spark.createDataFrame(rows, "file_path string, entry_pos int, url_pos int, category string, question string, url string, is_pdf boolean")
    kept, urls, dimension = {}, [], {}
    for row in rows:
        first = kept.get((row[0], row[5]), (row[1:3], None))[0]
        kept[(row[0], row[5])] = (first, row)
    expected = {(f, u, *first, r[3], r[4], r[6]) for (f, u), (first, r) in kept.items()}
    deduped = U.dedupe_per_file(frame)
    assert {tuple(r) for r in deduped.collect()} == expected
    for (f, u), (first, r) in sorted(kept.items(), key=lambda item: (item[0][0], item[1][0])):
        if not r[6]:
            urls.append(u)
            dimension[u] = (r[3], r[4], f)
    web = U.web_only(deduped)
    ordered = U.distinct_urls(web).orderBy("file_path", "entry_pos", "url_pos").collect()
    assert [r.url for r in ordered] == list(dict.fromkeys(urls))
    assert {r.url: (r.category, r.question, r.input_file) for r in U.url_dimension(web).collect()} == dimension
    (counts,) = U.duplicates_removed(web).collect()
    assert tuple(counts) == (len(urls), len(set(urls)), len(urls) - len(set(urls)))


def test_list_lengths_stop_at_a_member_without_length(spark):
    got = U.url_list_lengths(
        documents(
            spark,
            [{"urls": ["a", "b"]}, 5, {"urls": "xyz"}, {"urls": {"k": 1}}, {"q": 1}],
            [{"urls": ["a"]}, {"urls": None}, {"urls": ["b"]}],
            {"urls": ["a", "b", "c"]},
            {"A": [{"url": "http://a"}]},
            "{oops",
            ["http://a", "http://b"],
        )
    )
    assert [r.n_urls for r in got.orderBy("file_path").collect()] == [6, 1, 3, 0, 0, 0]


def test_later_category_takes_the_slug(spark):
    rows = spark.createDataFrame(
        [(1, "A &", "q1", ["http://a"]), (2, "A !", "q2", ["http://b", "bad"]), (3, "A &", "q3", ["http://c"]), (4, "B", "q4", [])],
        "qid long, category string, question string, urls array<string>",
    )
    filed = U.filed_results(rows, "qid")
    assert sorted((r.qid, r.file_path) for r in filed.collect()) == [(2, "a.json"), (4, "b.json")]
    assert [(r.entry_pos, r.url) for r in U.result_records(filed, "qid").collect()] == [(2, "http://b")]
