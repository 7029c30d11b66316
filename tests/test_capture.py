import random

from pyspark.sql import functions as F

from lodestone.functions import html as H
from lodestone.operators import capture as C
from lodestone.operators import grouping as G
from lodestone.operators.skew import count_before, salted_join
from lodestone.plans import jobs

ITEM = "item_pos long, markdown string, metadata struct<sourceURL:string,title:string,description:string,language:string>"
DIMENSION = "url string, category string, question string, input_file string"


def test_html_becomes_markdown(spark):
    page = (
        '<html lang="de"><head><title>A &amp;amp; B</title><meta name="description" content="D &lt;"></head><body><nav>menu</nav><!-- <p>no</p> -->'
        '<script>var t="</p>";</script><div class="ad">buy</div><h1 id="x">Head</h1><p><b>One<br>two&nbsp;&lt;3<p>Three<ul><li>x<li>y</ul>'
        "<footer>&copy;</footer></body></html>"
    )
    row = spark.createDataFrame([(page,)], "html string").select(
        H.to_markdown(F.col("html")).alias("m"), H.title(F.col("html")).alias("t"), H.description(F.col("html")).alias("d"), H.language(F.col("html")).alias("l")
    ).first()
    assert row.m == "# Head\n\n**One\ntwo <3**\n\nThree\n\n- x\n- y"
    assert (row.t, row.d, row.l) == ("A &amp; B", "D <", "de")


def items(spark, *rows):
    return spark.createDataFrame(list(rows), ITEM)


def meta(url):
    return (url, "t", None, None)


def test_tally_counts_returned_items_only(spark):
    scraped = items(spark, (1, "a", meta("http://a")), (2, "", meta("http://b")), (3, "c", None))
    assert tuple(C.tally(scraped).first()) == (2, 1)
    assert tuple(C.tally(scraped.limit(0)).first()) == (0, 0)
    assert tuple(C.failed_scrape_tally(spark.range(5)).first()) == (0, 5)


def test_metadata_defaults_replace_whole_structs_only(spark):
    got = C.with_metadata_defaults(items(spark, (1, "a", None), (2, "b", meta("http://b")))).orderBy("item_pos").collect()
    assert tuple(got[0].metadata) == (None, "", "", "en")
    assert tuple(got[1].metadata) == ("http://b", "t", None, None)


def test_capture_rules(spark):
    scraped = items(
        spark,
        (1, "a", meta("http://h/a/b")),
        (2, "b", meta("http://h/a_b")),
        (3, "c", meta("http://redirect")),
        (4, "", meta("http://h/a/b")),
        (5, "e", meta("")),
        (6, "f", None),
        (7, "g", meta("http://null")),
    )
    dimension = spark.createDataFrame(
        [("http://h/a/b", "A", "q", "x/b.json"), ("http://h/a_b", "A", "q2", "x/b.json"), ("http://null", None, None, "z.json")], DIMENSION
    )
    files = spark.createDataFrame([("z.json",), ("a.json",)], "file_path string")
    rows = C.capture_metadata(scraped, dimension, files)
    got = [tuple(r) for r in rows.drop("markdown").orderBy("item_pos").collect()]
    assert got == [
        (1, "A", "q", "x/b/h_a_b.md", "http://h/a/b", "web", 0),
        (2, "A", "q2", "x/b/h_a_b.md", "http://h/a_b", "web", 0),
        (3, "Uncategorized", "No Question", "a/redirect.md", "http://redirect", "web", 0),
        (7, None, None, "z/null.md", "http://null", "web", 0),
    ]
    kept = G.last_write_wins(rows, "content_path", "item_pos")
    assert sorted((r.content_path, r.markdown) for r in kept.collect()) == [("a/redirect.md", "c"), ("x/b/h_a_b.md", "b"), ("z/null.md", "g")]
    assert [tuple(r) for r in G.collisions(rows, "content_path", "url").collect()] == [("x/b/h_a_b.md", 2, 2)]
    assert [r.url for r in C.unmatched(dimension.select("url"), scraped).collect()] == []
    stamped = C.stamp_question_count(rows, spark.range(4))
    assert {r.question_count for r in stamped.collect()} == {4}


def test_entry_defaults_fill_absent_columns_only(spark):
    bare = spark.createDataFrame([(1, None)], "item_pos long, category string")
    row = C.entry_defaults(bare).first()
    assert (row.category, row.question_count, row.source_type, row.url) == (None, 0, "unknown", None)
    assert C.entry_defaults(bare.drop("category")).first().category == "Uncategorized"


def test_groups_keep_first_seen_order_in_bounded_blocks(spark):
    random.seed(2)
    rows = [(i, random.choice(["hot"] * 6 + ["b", "c", None]), f"q{i}") for i in random.sample(range(5000), 400)]
    frame = spark.createDataFrame(rows, "pos long, category string, question string").repartition(3)
    expected = {}
    for _, category, question in sorted(rows):
        expected.setdefault(category, []).append(question)
    blocks = G.nested_blocks(frame, "category", "pos", ["question"], "questions", block_rows=64).orderBy("category_pos", "block").collect()
    got = {}
    for block in blocks:
        assert len(block.questions) <= 64
        got.setdefault(block.category, []).extend(block.questions)
    assert list(got.items()) == list(expected.items())
    flat = {}
    for row in G.with_group_position(frame, "category", "pos").orderBy("category_pos", "pos").collect():
        flat.setdefault(row.category, []).append(row.question)
    assert list(flat.items()) == list(expected.items())
    first = min(rows)[1]
    assert sorted(r.question for r in G.first_group(frame, "category", "pos").collect()) == sorted(expected[first])


def test_count_before_over_all_levels(spark):
    random.seed(6)
    positions = sorted(random.sample(range(100), 40) + [random.randrange(1 << 20) + 200 for _ in range(300)] + [random.randrange(1 << 62) for _ in range(300)] + [(1 << 63) - 1])
    positions = sorted(set(positions))
    rows = [(p, random.random() < 0.4) for p in positions]
    got = count_before(spark.createDataFrame(rows, "pos long, f boolean").repartition(5), "pos", F.col("f"), "n").orderBy("pos").collect()
    seen, expected = 0, []
    for p, f in rows:
        expected.append((p, f, seen))
        seen += f
    assert [tuple(r) for r in got] == expected


def test_salted_join_equals_plain_join(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else ["a", "b", None][i % 9 // 3]) for i in range(200)], "i long, k string")
    right = spark.createDataFrame([("hot", 1), ("a", 2), ("a", 3), ("x", 4)], "k string, v int")
    for how in ("left", "inner", "left_semi", "left_anti"):
        plain = left.join(right, "k", how)
        salted = salted_join(left, right, ["k"], ["i"], how)
        assert salted.columns == plain.columns
        assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_jobs_run_end_to_end(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.x/1", "<html><p>alpha beta</p></html>"), (2, "http://b.x/2", "<p>beta gamma gamma</p>"), (3, "http://c.x/3", "")],
        "page_id long, url string, html string",
    )
    questions = spark.createDataFrame(
        [(1, "A", "alpha", None, None), (2, "A", "gamma beta", None, None), (3, "B", "zeta", None, None), (4, "B", "own", None, ["http://c.x/3", "http://gone"])],
        "qid long, category string, question string, dorks string, urls array<string>",
    )
    reply = '{"response":{"qnaList":[{"q":"a","a":"b"},{"q":"c","a":"d"}]}}'
    replies = spark.createDataFrame([(2, reply)], "prompt_id long, reply string")
    (counts,) = jobs.full_run(questions, pages, replies).collect()
    # page 1 answers question 1, pages 2 and 1 question 2; page 3 is empty, the other supplied URL is no page
    assert tuple(counts) == (5, 2, 2)


def test_capture_job(spark):
    pages = spark.createDataFrame([(1, "http://a/1", "<p>x</p>"), (2, "http://a/2", ""), (3, "http://other", "<p>y</p>")], "page_id long, url string, html string")
    records = spark.createDataFrame(
        [("f.json", 0, i, "C", "q", u, False) for i, u in enumerate(["http://a/1", "http://a/2", "http://gone"])],
        "file_path string, entry_pos int, url_pos int, category string, question string, url string, is_pdf boolean",
    )
    done = jobs.capture(records, records.select("file_path"), pages)
    assert tuple(done.tally.first()) == (1, 1)
    assert [r.url for r in done.unmatched.collect()] == ["http://gone"]
    assert [tuple(r) for r in done.documents.collect()] == [(1, "f/a_1.md", "x")]
    (block,) = jobs.aggregate_metadata(done.metadata, spark.range(3)).collect()
    assert (block.category, [tuple(e) for e in block.entries]) == ("C", [("f/a_1.md", 3, "http://a/1", "web")])


def test_generated_questions_close_the_loop(spark):
    import json

    wrap = lambda v: json.dumps({"response": json.dumps(v)})
    attempts = spark.createDataFrame([(1, 1, wrap([{"question": "a"}, {"question": "b"}, {"question": "c"}]))], "topic_id long, attempt int, reply string")
    answers = [(1, i, i, wrap({"question": q.upper(), "category": c})) for i, (q, c) in enumerate([("a", "Y"), ("b", "X"), ("c", "Y")])]
    replies = spark.createDataFrame(answers, "topic_id long, q_pos int, pos long, reply string")
    rows = jobs.generate_and_categorise(attempts, replies).orderBy("category_pos", "pos").collect()
    assert [(r.category, r.question, r.dorks, r.urls) for r in rows] == [("Y", "A", None, None), ("Y", "C", None, None), ("X", "B", None, None)]
