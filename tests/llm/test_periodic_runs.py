"""Runs against a search of every period, and the operator's edge rows."""

import hashlib
import random
import zlib

import numpy as np

from fixtures import AWKWARD, documents, empty
from lodestone.llm import queries as Q
from lodestone.llm.periodic_runs import periodic_runs, runs_of
from lodestone.llm.suffix_tree import Extensions, SuffixTree

SF = "/root/testdata/sf0.001"


def every_run(words, least, exponent):
    found = []
    for q in range(1, len(words) // exponent + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end + q - at
            if length >= max(least, exponent * q):
                shorter = any(words[at : at + length - r] == words[at + r : at + length] for r in range(1, q))
                if not shorter:
                    found.append((at, length, q))
            at = max(end, at + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_equal_a_search_of_every_period():
    rng = random.Random(3)
    for _ in range(600):
        words = [b"%d" % rng.randint(1, rng.choice((1, 2, 3))) for _ in range(rng.randint(1, 90))]
        if rng.random() < 0.6:
            start, period = rng.randrange(len(words)), rng.randint(1, 20)
            for i in range(start, len(words)):
                words[i] = words[start + (i - start) % period]
        for least, exponent in ((24, 3), (2, 2), (6, 2), (5, 3)):
            assert runs_of(words, least, exponent) == every_run(words, least, exponent)


def test_a_word_may_lie_in_two_runs():
    words = b"a b c d e f g h".split() * 3 + b"x y".split() * 12
    mixed = b"a b".split() * 12 + b"a b c".split() * 8
    assert runs_of(words, 24, 3) == [(0, 24, 8), (24, 24, 2)]
    assert runs_of(mixed, 24, 3) == every_run(mixed, 24, 3) and len(runs_of(mixed, 24, 3)) == 2


def test_extensions_equal_a_comparison():
    rng = np.random.default_rng(5)
    for n in (1, 2, 5, 60):
        text = rng.integers(1, 3, n)
        common = Extensions(SuffixTree(text)).common
        pairs = [(i, j) for i in range(n + 1) for j in range(n + 1) if i != j]
        want = [next((k for k in range(n) if max(i, j) + k >= n or text[i + k] != text[j + k]), 0) for i, j in pairs]
        assert common(*np.array(pairs).T).tolist() == want


def test_awkward_rows(spark):
    found = periodic_runs(documents(spark))
    rows = found.collect()
    assert found.columns == [*documents(spark).columns, "n_words", "runs", "strongest", "collapsed"]
    assert len(rows) == len(AWKWARD)
    assert sorted((r.doc_id or -1, r.text or "") for r in rows) == sorted((i or -1, t or "") for i, t in AWKWARD)
    by_text = {r.text: r for r in rows}
    assert [tuple(r) for r in by_text["word " * 60_000].runs] == [(0, 60_000, 1)]
    assert by_text["word " * 60_000].collapsed == "word"
    assert by_text[None].n_words == 0 and by_text[None].collapsed == "" and by_text[None].strongest is None
    assert by_text[" \t\n "].collapsed == ""
    assert by_text["ÀÉ ß 漢字 🙂 ▁ mixed"].collapsed == "ÀÉ ß 漢字 🙂 ▁ mixed"
    assert periodic_runs(empty(spark)).count() == 0


def test_results_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "a " * 30, "x", "y")], "doc_id long, text string, Runs string, box string")
    found = periodic_runs(docs)
    assert found.columns == ["doc_id", "text", "box", "n_words", "runs", "strongest", "collapsed"]
    assert found.first().box == "y" and tuple(found.first().strongest) == (0, 30, 1)


def expected(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = every_run(words, 24, 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    digests = hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


def test_op11_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r) for r in Q.op11_periodic_runs(spark, SF).collect()}
    assert found == {r.doc_id: expected(r.doc_id, r.text) for r in docs}
    assert sum(r[1] > 0 for r in found.values()) > 5
