import json

import pytest

from lodestone.operators import questions as Q


def documents(spark, *contents):
    rows = [(f"d{i}", c if isinstance(c, str) else json.dumps(c)) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "doc string, content string")


def loaded(spark, *contents, **options):
    rows = Q.normalise_questions(documents(spark, *contents), **options).orderBy("doc", "category_pos", "q_pos").collect()
    return [(r.category, r.question, r.dorks, r.urls) for r in rows]


def rejects(spark, *contents, **options):
    rows = Q.question_rejects(documents(spark, *contents), **options).collect()
    return sorted((r.doc, r.block_pos, -1 if r.q_pos is None else r.q_pos, r.reject) for r in rows)


def test_repeated_block_keeps_first_place(spark):
    blocks = [{"category": "A", "questions": ["a1"]}, {"category": "B", "questions": ["b1"]}, {"category": "A", "questions": ["a2"]}]
    assert [r[:2] for r in loaded(spark, blocks)] == [("A", "a2"), ("B", "b1")]


def test_repeated_map_key_keeps_first_place(spark):
    assert [r[:2] for r in loaded(spark, '{"A":["a1"],"B":["b1"],"A":["a2"]}')] == [("A", "a2"), ("B", "b1")]


def test_object_elements(spark):
    elements = [{"question": None, "q": "z"}, {"q": "z"}, {}, {"question": "x", "dorks": "d", "urls": ["u", None]}, {"question": "y", "dorks": None, "urls": None}, '{"q":"text"}']
    assert loaded(spark, {"": elements}) == [
        ("", None, None, None),
        ("", "z", None, None),
        ("", "", None, None),
        ("", "x", "d", ["u", None]),
        ("", "y", None, None),
        ("", '{"q":"text"}', None, None),
    ]


def test_missing_questions_is_an_empty_block(spark):
    assert loaded(spark, [{"category": "A"}]) == []
    assert rejects(spark, [{"category": "A"}]) == []


def test_rejects(spark):
    assert rejects(spark, [{"category": "", "questions": []}, {"questions": ["q"]}, 5, {"category": "A", "questions": None}, {"category": "B", "questions": ["q", 5, None, [1]]}]) == [
        ("d0", 0, -1, "missing_category"),
        ("d0", 1, -1, "missing_category"),
        ("d0", 2, -1, "not_an_object"),
        ("d0", 3, -1, "questions_not_a_list"),
        ("d0", 4, 1, "invalid_question"),
        ("d0", 4, 2, "invalid_question"),
        ("d0", 4, 3, "invalid_question"),
    ]


@pytest.mark.parametrize("content", ['"text"', "5", "null", "{oops", "[1] x"])
def test_other_documents_are_rejected(spark, content):
    assert rejects(spark, content) == [("d0", 0, -1, "unsupported_structure")]


def test_empty_documents(spark):
    assert rejects(spark, "[]", "{}") == [] and loaded(spark, "[]", "{}") == []


def test_raw_form_takes_strings_only(spark):
    document = {"A": ["q", {"question": "x"}]}
    assert [r[1] for r in loaded(spark, document, normalise=False)] == ["q"]
    assert rejects(spark, document, normalise=False) == [("d0", 0, 1, "invalid_question")]


def test_strict_load_fails_at_a_reject(spark):
    good = documents(spark, {"A": ["q"]})
    assert [r.question for r in Q.strict_questions(good).collect()] == ["q"]
    with pytest.raises(Exception, match="invalid_question"):
        Q.strict_questions(documents(spark, {"A": ["q", 5]})).collect()
