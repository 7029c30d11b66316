import json
import random

import pytest

from lodestone.operators import replies as R

PAIR = {"q": "x", "a": "y"}


def frame(spark, replies, schema="pos long, reply string"):
    return spark.createDataFrame(list(enumerate(replies)), schema)


@pytest.mark.parametrize(
    "reply, status, pairs",
    [
        (None, "no_reply", []),
        ("{oops", "bad_reply", []),
        ("[]", "bad_reply", []),
        ("{}", "no_response", []),
        (json.dumps({"response": json.dumps({"qnaList": [PAIR]})}), "ok", [("x", "y")]),
        (json.dumps({"response": {"qnaList": [PAIR, PAIR]}}), "ok", [("x", "y")] * 2),
        (json.dumps({"response": "not json"}), "bad_json", []),
        (json.dumps({"response": '{"qnaList":[]} x'}), "bad_json", []),
        (json.dumps({"response": json.dumps({"pairs": []})}), "no_list", []),
        (json.dumps({"response": None}), "no_list", []),
        (json.dumps({"response": "[1]"}), "no_list", []),
        (json.dumps({"response": {"qnaList": "x"}}), "bad_list", []),
        (json.dumps({"response": {"qnaList": None}}), "bad_list", []),
        (json.dumps({"response": {"qnaList": []}}), "ok", []),
        (json.dumps({"response": {"qnaList": [{"q": 1}, {"a": {"k": 2}}, {}]}}), "ok", [("1", None), (None, '{"k":2}'), (None, None)]),
    ],
)
def test_qna_shapes(spark, reply, status, pairs):
    decoded = R.decode_qna(frame(spark, [reply], "prompt_id long, reply string"))
    assert [r.decode_status for r in decoded.collect()] == [status]
    assert [(r.q, r.a) for r in R.explode_qna(decoded).orderBy("pair_pos").collect()] == pairs


def attempt(response):
    return json.dumps({"response": response})


def test_first_good_attempt(spark):
    good = lambda *names: attempt(json.dumps([{"question": n} for n in names]))
    rows = [
        (1, 1, attempt("{oops")), (1, 2, attempt("[]")), (1, 3, good("c", "d")), (1, 4, good("late")),
        (2, 6, good("too late")), (2, 1, None), (2, 2, "{}"), (2, 3, attempt(None)), (2, 4, attempt(["x"])), (2, 5, attempt('{"a":1}')),
        (3, 2, good("b")), (3, 1, good("a")),
    ]
    chosen = R.first_good_attempt(spark.createDataFrame(rows, "topic_id long, attempt int, reply string"))
    assert {r.topic_id: (r.attempt, r.n_tried) for r in chosen.collect()} == {1: (3, 4), 2: (None, 5), 3: (1, 2)}
    found = R.explode_generated(chosen).orderBy("topic_id", "q_pos").collect()
    assert [(r.topic_id, r.q_pos, r.question) for r in found] == [(1, 0, "c"), (1, 1, "d"), (3, 0, "a")]


@pytest.mark.parametrize(
    "reply, status",
    [
        (None, "no_reply"),
        ("x", "bad_reply"),
        ("{}", "no_response"),
        (attempt(""), "no_response"),
        (attempt(None), "no_response"),
        (attempt({"question": "q", "category": "c"}), "bad_json"),
        (attempt("{oops"), "bad_json"),
        (attempt("{}"), "empty"),
        (attempt("null"), "empty"),
        (attempt("[1]"), "no_category"),
        (attempt('{"question":"q"}'), "no_category"),
        (attempt('{"category":"c"}'), "no_question"),
        (attempt('{"question":"q","category":""}'), "empty_category"),
        (attempt('{"question":"q","category":null}'), "empty_category"),
        (attempt('{"question":"q","category":"c"}'), "ok"),
    ],
)
def test_category_reply_status(spark, reply, status):
    assert [r.decode_status for r in R.decode_categories(frame(spark, [reply])).collect()] == [status]


def named(category):
    return attempt(json.dumps({"question": "said", "category": category}))


def vocabularies(categories):
    known = {}
    for category in categories:
        yield list(known)
        if category:
            known[category] = True


def test_running_vocabulary_equals_the_fold(spark):
    categories = ["N", "S", None, "N", "", "X", "S"]
    assert list(vocabularies(categories)) == [[], ["N"], ["N", "S"], ["N", "S"], ["N", "S"], ["N", "S"], ["N", "S", "X"]]
    random.seed(5)
    categories += [random.choice(["N", "it's", "é", "", None, "a\"'b", "z\\"]) for _ in range(60)]
    decoded = R.decode_categories(frame(spark, [named(c) for c in categories]))
    questions = spark.createDataFrame([(i, f"q{i}") for i in range(len(categories))], "pos long, question string")
    answers = R.answered_categories(decoded)
    expected = [f"Instruction: Sort. Question: q{i}\nExisting categories: {v}" for i, v in enumerate(vocabularies(categories))]
    for block in (1, 2, 256):
        got = R.categorisation_prompts(questions, answers, "Sort.", block).orderBy("pos").collect()
        assert [r.prompt for r in got] == expected
    final = list(dict.fromkeys(c for c in categories if c))
    assert [(r.category_pos, r.category) for r in R.vocabulary(answers).orderBy("category_pos").collect()] == list(enumerate(final))
    (counts,) = R.categorisation_counts(decoded).collect()
    assert tuple(counts) == (len(categories), len(final))


def test_the_reply_names_the_question(spark):
    (row,) = R.categorised(R.decode_categories(frame(spark, [named("c")]))).collect()
    assert (row.pos, row.category, row.question) == (0, "c", "said")


def test_prompts_keep_other_braces(spark):
    documents = spark.createDataFrame([("p.md", "text {x}")], "content_path string, markdown string")
    (row,) = R.qna_prompts(documents, "As {domain_of_expertise}: {json}", "Law").collect()
    assert (row.prompt, row.n_chars) == ("As Law: {json}\ntext {x}", 8)
    topics = spark.createDataFrame([("T",)], "topic string")
    assert R.question_prompts(topics, "About {topic} {x}").collect()[0].prompt == "About T {x}"
