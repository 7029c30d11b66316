import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators import search as S
from lodestone.session import run_dir


def tokens(text):
    return re.findall(r"[^\W_]+", text.lower())


def bm25(pages):
    lists = {p: tokens(t) for p, _, t in pages}
    mean = sum(map(len, lists.values())) / len(lists)
    df = {}
    for found in lists.values():
        for token in set(found):
            df[token] = df.get(token, 0) + 1
    impacts = {}
    for page, found in lists.items():
        for token in set(found):
            tf, idf = found.count(token), math.log(1 + (len(pages) - df[token] + 0.5) / (df[token] + 0.5))
            weight = idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(found) / mean))
            impacts[token, page] = max(1, math.floor(weight * 10_000_000_000 + 0.5))
    return impacts


def matches(pages):
    return {(t, p): S.MATCH_UNIT + tokens(text).count(t) for p, _, text in pages for t in set(tokens(text))}


def brute_force(pages, queries, impacts, k, allowed=lambda page: True):
    best = {}
    for query, text in queries:
        scores = {}
        for page, url, _ in pages:
            score = sum(impacts.get((t, page), 0) for t in set(tokens(text)))
            if score > 0 and allowed(url):
                scores[page] = score
        best[query] = sorted(scores.items(), key=lambda item: (-item[1], item[0]))[:k]
    return best


def corpus(seed, n_pages, n_words, length):
    random.seed(seed)
    names = [f"w{i}" for i in range(n_words)]
    weights = [1 / (i + 1) ** 1.1 for i in range(n_words)]
    text = lambda n: " ".join(random.choices(names, weights, k=n))
    pages = [(i, f"http://{random.choice('abc')}.x{i % 3}.org/{i}.{random.choice(['html', 'txt'])}", text(random.randint(1, length))) for i in range(n_pages)]
    return pages, text


def ranked(spark, pages, queries, weigh, k, **options):
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    rows = S.with_search_terms(spark.createDataFrame(queries, "query_id long, query string"))
    best = {q: [] for q, _ in queries}
    for row in S.top_pages(rows, index, weigh, k, **options).orderBy("query_id", "rank").collect():
        best[row.query_id].append((row.page_id, row.score))
        assert row["rank"] == len(best[row.query_id])
    return best


@pytest.mark.parametrize("seed, k, engine", [(1, 3, "matches"), (2, 10, "bm25")])
@pytest.mark.parametrize("way", ["short", "floor", "floor_split"])
def test_top_pages_equal_brute_force(spark, monkeypatch, seed, k, engine, way):
    pages, text = corpus(seed, 400, 120, 40)
    queries = [(i, text(random.randint(1, 12))) for i in range(60)]
    queries += [(100, "w0"), (101, "w0 w1"), (102, "w119"), (103, "nothing"), (104, ""), (105, "w0 nothing w1 w2"), (106, "w3")]
    weigh, impacts = (S.bm25_impacts, bm25(pages)) if engine == "bm25" else (S.match_impacts, matches(pages))
    if way == "floor_split":
        monkeypatch.setattr(S, "SPLIT_ROWS", 16)
        monkeypatch.setattr(S, "READ_ALL_FACTOR", 0)
    if way == "short":
        monkeypatch.setattr(S, "SPLIT_PAIRS", 50)
    options = {} if way == "short" else {"short_lists": 0}
    assert ranked(spark, pages, queries, weigh, k, **options) == brute_force(pages, queries, impacts, k)


def test_ties_go_to_the_smaller_page(spark, monkeypatch):
    monkeypatch.setattr(S, "READ_ALL_FACTOR", 0)
    random.seed(9)
    pages = [(i, f"http://h/{i}", random.choice(["a b", "b a", "a c", "a", "b"])) for i in range(200)]
    random.shuffle(pages)
    queries = [(1, "a"), (2, "a b"), (3, "b c"), (4, "a b c")]
    assert ranked(spark, pages, queries, S.bm25_impacts, 7, short_lists=0) == brute_force(pages, queries, bm25(pages), 7)
    assert ranked(spark, pages, queries, S.match_impacts, 7, short_lists=0) == brute_force(pages, queries, matches(pages), 7)


def test_operators_filter_before_ranking(spark, monkeypatch):
    monkeypatch.setattr(S, "READ_ALL_FACTOR", 0)
    pages, text = corpus(4, 300, 60, 30)
    host = lambda url: url.split("/")[2]
    cases = {
        " site:x1.org": lambda u: host(u).endswith(".x1.org"),
        " filetype:html": lambda u: u.endswith(".html"),
        " site:org site:A.x2.org filetype:txt": lambda u: host(u) == "a.x2.org" and u.endswith(".txt"),
        " site:x1.org site:x2.org": lambda u: False,
        " filetype:html filetype:txt": lambda u: False,
        " site:1.org": lambda u: False,
    }
    impacts, queries, expected = bm25(pages), [], {}
    for i, (operators, allowed) in enumerate(cases.items()):
        asked = [(i * 10 + j, text(5)) for j in range(5)]
        queries += [(q, t + operators) for q, t in asked]
        expected |= brute_force(pages, asked, impacts, 5, allowed)
    assert ranked(spark, pages, queries, S.bm25_impacts, 5, short_lists=0) == expected
    assert ranked(spark, pages, queries, S.bm25_impacts, 5) == expected


def test_results_keep_every_question(spark):
    pages, _ = corpus(5, 50, 20, 20)
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    rows = [
        (1, "C", "w0 w1", None, None), (2, "C", "w1 W0", "", []), (3, "D", "nothing here", None, None), (4, "D", None, None, None),
        (5, "E", "w0", "site:x1.org", None), (6, "E", "w0", "site:x1.org", ["http://own", "x"]),
    ]
    questions = spark.createDataFrame(rows, "qid long, category string, question string, dorks string, urls array<string>")
    best = brute_force(pages, [(1, "w0 w1"), (5, "w0")], bm25(pages), 4)
    urls = {p: u for p, u, _ in pages}
    got = {r.qid: (r.dorks, r.urls, r.error) for r in S.retrieve(questions, index, 4).collect()}
    top = [urls[p] for p, _ in best[1]]
    assert got[1] == (None, top, None) and got[2] == (None, top, None)
    assert got[3] == (None, [], S.NO_RESULTS) and got[4] == (None, [], S.NO_QUESTION)
    assert got[5][0] == "site:x1.org" and all(".x1.org/" in u for u in got[5][1]) and got[5][2] is None
    assert got[6] == ("site:x1.org", ["http://own", "x"], None)
    plain = {r.qid: (r.dorks, len(r.urls), r.error) for r in S.retrieve(questions, index, 4, "filetype:pdf", honour_overrides=False).collect()}
    assert plain[6] == ("filetype:pdf", 0, S.NO_RESULTS)
    both = S.retrieve_two_engines(questions, index, 2).groupBy("engine").count().collect()
    assert {r.engine: r["count"] for r in both} == {"bm25": 6, "matches": 6}


def test_no_task_reads_a_whole_common_word(spark, monkeypatch):
    """The floor keeps a word that is on every page from being read page by page."""
    monkeypatch.setattr(S, "READ_ALL_FACTOR", 0)
    rows = [(i, f"http://h/{i}", "common " * (1 + i % 3) + (f"rare{i % 500}" if i < 1500 else "")) for i in range(3000)]
    index = S.build_index(spark.createDataFrame(rows, "page_id long, url string, body string"))
    asked = [(q, f"common rare{q}") for q in range(100)]
    seen = {}
    original = S._above_shares
    monkeypatch.setattr(S, "_above_shares", lambda *a: seen.setdefault("found", original(*a)))
    queries = S.with_search_terms(spark.createDataFrame(asked, "query_id long, query string"))
    assert S.top_pages(queries, index, S.bm25_impacts, 3, short_lists=0).count() == 300
    assert seen["found"].count() < 100 * 10


def test_a_word_on_all_pages_of_a_large_corpus_keeps_them(spark):
    documents = spark.range(2_000_000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.lit(4).cast("long").alias("n_words"))
    postings = documents.where("page_id < 50").select(F.lit("every").alias("token"), "page_id", F.lit(1).cast("long").alias("tf"), "n_words")
    counted = postings.withColumn("df", F.lit(2_000_000).cast("long"))
    index = S.PageIndex(documents, postings, counted.select("token", "df").distinct())
    impacts = [r.impact for r in S.bm25_impacts(index, counted).collect()]
    assert len(impacts) == 50 and min(impacts) > 1_000


def test_no_row_for_a_pair_of_a_query_and_a_page(spark, monkeypatch):
    """Every page has the words of every query; only the best of a group of pages leave a task."""
    rows = [(i, f"http://h/{i}", "common word " * (1 + i % 7)) for i in range(3000)]
    index = S.build_index(spark.createDataFrame(rows, "page_id long, url string, body string"))
    queries = S.with_search_terms(spark.createDataFrame([(q, f"common word rare{q}") for q in range(200)], "query_id long, query string"))
    seen, meet = [], S._meet
    monkeypatch.setattr(S, "_meet", lambda *a: seen.append(meet(*a)) or seen[-1])
    assert S.top_pages(queries, index, S.bm25_impacts, 3).count() == 600
    assert seen[0].count() <= 200 * 3 * 2


def test_repeated_rows_count_as_often_as_they_come(spark):
    """Repeated pages and queries add up; one query_id may ask in several scopes; a null one is a query too."""
    pages = [(1, "http://a.org/1", "x y"), (1, "http://a.org/1", "x y"), (2, "http://b.org/2", "x"), (3, "http://b.org/3", "z"), (None, "http://b.org/4", "x")]
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    asked = [(1, "x"), (1, "x"), (2, "x site:b.org"), (2, "y site:a.org"), (None, "z"), (3, "x y")]
    queries = S.with_search_terms(spark.createDataFrame(asked, "query_id long, query string"))
    unit = S.MATCH_UNIT + 1
    expected = {(1, 1, 8 * unit), (1, 2, 2 * unit), (2, 2, unit), (2, 1, 4 * unit), (None, 3, unit), (3, 1, 8 * unit), (3, 2, unit)}
    for short_lists in (0, 100):
        got = S.top_pages(queries, index, S.match_impacts, 5, short_lists).select("query_id", "page_id", "score").collect()
        assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_scores_beyond_the_range_of_exact_doubles(spark):
    huge = lambda index, postings: postings.withColumn("impact", F.lit(1 << 54) + F.col("page_id"))
    index = S.build_index(spark.createDataFrame([(i, "u", "a b") for i in range(20)], "page_id long, url string, body string"))
    queries = S.with_search_terms(spark.createDataFrame([(1, "a b")], "query_id long, query string"))
    got = [(r.page_id, r.score) for r in S.top_pages(queries, index, huge, 2).orderBy("rank").collect()]
    assert got == [(19, (1 << 55) + 38), (18, (1 << 55) + 36)]


def test_rows_that_leave_tasks_do_not_grow_with_the_pages(spark, monkeypatch):
    """Twelve times the blocks of pages: a query still gives its best of two groups of them."""
    monkeypatch.setattr(S, "SPLIT_ROWS", 64)
    monkeypatch.setattr(S, "LEAST_TASKS", 2)
    monkeypatch.setattr(S, "SPLIT_PAIRS", 16 * S.BLOCK_PAGES)
    queries = S.with_search_terms(spark.createDataFrame([(q, f"common word rare{q}") for q in range(64)], "query_id long, query string"))
    meet, left = S._meet, []
    monkeypatch.setattr(S, "_meet", lambda *a: left.append(meet(*a)) or left[-1])
    for n in (250, 3000):
        rows = [(i, f"http://h/{i}", "common word " * (1 + i % 7)) for i in range(n)]
        index = S.build_index(spark.createDataFrame(rows, "page_id long, url string, body string"))
        assert S.top_pages(queries, index, S.bm25_impacts, 3).count() == 64 * 3
    assert max(f.count() for f in left) <= 64 * 3 * 2


@pytest.mark.parametrize("weigh, impacts", [(S.bm25_impacts, bm25), (S.match_impacts, matches)])
def test_rounds_give_the_same_pages(spark, monkeypatch, weigh, impacts):
    monkeypatch.setattr(S, "ROUND_ROWS", 50)
    monkeypatch.setattr(S, "SPLIT_ROWS", 100)
    pages, text = corpus(6, 300, 80, 30)
    queries = [(i, text(random.randint(1, 8))) for i in range(30)]
    assert ranked(spark, pages, queries, weigh, 4) == brute_force(pages, queries, impacts(pages), 4)


def test_two_engines_share_their_page_blocks(spark, monkeypatch):
    pages, text = corpus(8, 200, 60, 20)
    asked = [(i, text(4)) for i in range(20)] + [(50, "w0 w1"), (51, "w0 w1"), (52, None), (53, "nowhere")]
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    questions = spark.createDataFrame([(*a, None, None) for a in asked], "qid long, question string, dorks string, urls array<string>")
    labels, write = [], S.durable
    monkeypatch.setattr(S, "durable", lambda df, label, *more: labels.append(label) or write(df, label, *more))
    got = {(r.engine, r.qid): (r.urls, r.error) for r in S.retrieve_two_engines(questions, index, 3).collect()}
    assert labels.count("page-blocks") == labels.count("used") == 1
    urls = {p: u for p, u, _ in pages}
    for engine, impacts in (("bm25", bm25(pages)), ("matches", matches(pages))):
        best = brute_force(pages, [(q, t or "") for q, t in asked], impacts, 3)
        for q, t in asked:
            expected = [urls[p] for p, _ in best[q]]
            assert got[engine, q] == (expected, S.NO_QUESTION if t is None else None if expected else S.NO_RESULTS)
    assert len(got) == 2 * len(asked)


def tables_of(spark):
    at = Path(run_dir(spark).removeprefix("file:"))
    return {f for f in at.iterdir()} if at.exists() else set()


@pytest.mark.parametrize("short_lists", [0, S.SHORT_LISTS])
def test_a_search_leaves_only_what_its_result_reads(spark, monkeypatch, short_lists):
    """Tables of earlier steps would stay on disk next to all that the session does later."""
    monkeypatch.setattr(S, "SHORT_LISTS", short_lists)
    monkeypatch.setattr(S, "READ_ALL_FACTOR", 0)
    pages, text = corpus(9, 60, 30, 10)
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    rows = spark.createDataFrame([(i, text(3), text(3)) for i in range(9)], "query_id long, question string, query string")
    before = tables_of(spark)
    asked = rows.selectExpr("query_id as qid", "question", "cast(null as string) as dorks", "cast(null as array<string>) as urls")
    assert S.retrieve(asked, index, 3).count() == S.retrieve_two_engines(asked, index, 3).count() / 2 == 9
    left = tables_of(spark) - before
    assert sorted(t.name.rsplit("-", 1)[0] for t in left) == ["ranked", "ranked"]
    assert all(f.name.endswith(".zstd.parquet") for t in left for f in t.glob("part-*"))


def test_what_a_round_has_looked_up_goes_when_it_is_packed(spark, monkeypatch):
    """Page blocks hold counts, not impacts, and are never on disk next to all that was looked up."""
    monkeypatch.setattr(S, "ROUND_ROWS", 50)
    monkeypatch.setattr(S, "SPLIT_ROWS", 100)
    pages, text = corpus(11, 300, 80, 30)
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    queries = S.with_search_terms(spark.createDataFrame([(i, text(4)) for i in range(30)], "query_id long, query string"))
    before, present, columns, write = tables_of(spark), [], [], S.durable

    def watched(df, label, *more):
        out = write(df, label, *more)
        if label == "page-blocks":
            columns.extend(c for c in out.columns if c.startswith("impact"))
            present.append([t.name.rsplit("-", 1)[0] for t in tables_of(spark) - before])
        return out

    monkeypatch.setattr(S, "durable", watched)
    assert S.top_pages(queries, index, S.bm25_impacts, 3).count() > 0
    assert len(present) > 4 and not columns
    assert [names.count("used") for names in present] == list(range(len(present), 0, -1))


def test_tasks_weigh_as_columns_do(spark):
    """Impacts made in tasks are those of the expression, to the last unit."""
    rows = [(f"t{i}", i, 1 + i % 9, 1 + (i * 7919) % 997, 1 + (i * 104729) % 5000) for i in range(4000)]
    counted = spark.createDataFrame(rows, "token string, page_id long, tf long, n_words long, df long")
    index = S.PageIndex(counted.select("page_id", F.lit("u").alias("url"), "n_words"), counted, counted.select("token", "df").distinct())
    for weigh in (S.bm25_impacts, S.match_impacts):
        found = weigh(index, counted).withColumn("weight", S._idf(F.col("df"), F.lit(4000).cast("long"))).toPandas()
        got = S._rankings(index, [weigh])[0].impacts(found.tf.to_numpy(), found.n_words.to_numpy(), found.weight.to_numpy())
        assert (got == found.impact.to_numpy()).all()


def test_page_blocks_are_sorted_when_they_are_packed(spark, monkeypatch):
    """A block meets every block of queries, so it holds each word once and its numbers are bytes that Spark hands on whole."""
    pages, text = corpus(12, 300, 80, 30)
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    queries = S.with_search_terms(spark.createDataFrame([(i, text(4)) for i in range(30)], "query_id long, query string"))
    blocks, write = [], S.durable
    monkeypatch.setattr(S, "durable", lambda df, label, *more: (blocks if label == "page-blocks" else []).append(t := write(df, label, *more)) or t)
    assert S.top_pages(queries, index, S.bm25_impacts, 3).count() > 0
    assert {c for c, kind in blocks[0].dtypes if kind != "binary"} == {"lead", "page_scopes"}
    for block in (row for table in blocks for row in table.collect()):
        ids, words, lengths, rows, counts = (np.frombuffer(block[c], np.int64) for c in ("page_ids", "page_words", "word_lengths", "word_rows", "tf"))
        assert (np.diff(ids) > 0).all() and (np.diff(words) > 0).all()
        assert lengths.sum() == len(rows) == len(counts) and (counts > 0).all()


def test_repeated_pages_of_other_lengths(spark):
    """Words of a page are weighed by the row that they come from."""
    pages = [(i % 7, f"http://h/{i}", "x " * (1 + i % 3) + "y " * (i % 5) + "z" * (i % 2)) for i in range(40)]
    index = S.build_index(spark.createDataFrame(pages, "page_id long, url string, body string"))
    queries = S.with_search_terms(spark.createDataFrame([(1, "x"), (2, "x y"), (3, "z y")], "query_id long, query string"))
    in_columns = lambda index, postings: S.bm25_impacts(index, postings)
    found = [sorted(map(tuple, S.top_pages(queries, index, weigh, 5).collect())) for weigh in (S.bm25_impacts, in_columns)]
    assert found[0] == found[1] and len(found[0]) == 15
