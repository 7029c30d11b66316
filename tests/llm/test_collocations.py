"""Counts from longest windows against plain counts, with buckets so small that borders matter."""

import re
from collections import Counter, defaultdict

import pytest

from fixtures import AWKWARD, documents, empty
from lodestone.llm import collocations as C

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = "The cat sat on the mat. the cat sat; a Dog ran on the mat on the mat, É é x\ty".split(" ")


def plain(rows, longest, least, cover, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {}
        for phrase, a in f.items():
            if len(phrase) > 1 and a >= least:
                cuts = [(2_000_000 * a // (f[phrase[:k]] + f[phrase[k:]]), k) for k in range(1, len(phrase))]
                score, k = min(cuts)
                found[phrase] = (score, a, f[phrase[:k]], f[phrase[k:]])
        inside = Counter()
        for phrase, (_, a, _, _) in found.items():
            for m in range(2, len(phrase)):
                for s in range(len(phrase) - m + 1):
                    inside[phrase[s : s + m]] = max(inside[phrase[s : s + m]], a)
        left = [(p, v) for p, v in found.items() if not (inside[p] and 100 * inside[p] >= cover * v[1])]
        left.sort(key=lambda x: (-x[1][0], -x[1][1], " ".join(x[0]).encode()))
        out += [(lang, k + 1, " ".join(p), a, l, r, totals[lang], score) for k, (p, (score, a, l, r)) in enumerate(left[:top])]
    return sorted(out)


def corpus():
    rows = []
    for k in range(400):
        words = [WORDS[(k * k + j * (k % 7 + 1)) % len(WORDS)] for j in range(k % 40)]
        rows.append((("en", "de", None, "")[k % 4], " ".join(words)))
    return rows + [("en", "of the hot pair " * 3_000), ("en", None), (None, ""), ("de", "\n\n..")]


@pytest.mark.parametrize("bucket", [500_000, 40])
@pytest.mark.parametrize("least, cover, top", [(30, 80, 2000), (3, 50, 7)])
def test_equals_plain_counts(spark, monkeypatch, bucket, least, cover, top):
    monkeypatch.setattr(C, "BUCKET", bucket)
    monkeypatch.setattr(C, "HELD", 5_000)
    docs = spark.createDataFrame(corpus(), "lang string, text string").repartition(5)
    found = C.collocations(docs, least=least, cover=cover, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain(corpus(), 4, least, cover, top)


def test_windows_are_cut_only_where_no_count_changes(spark, monkeypatch):
    monkeypatch.setattr(C, "BUCKET", 100)
    docs = spark.createDataFrame(corpus(), "lang string, text string")
    windows = C.top_windows(docs, least=30).collect()
    want = Counter()
    for lang, text in corpus():
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for i in range(len(words)):
                for k in range(1, min(4, len(words) - i) + 1):
                    want["und" if lang is None else lang, tuple(words[i : i + k])] += 1
    got = Counter()
    for r in windows:
        words = [w for w in r[1:5] if w is not None]
        for k in range(1, len(words) + 1):
            got[r[0], tuple(words[:k])] += r[5]
    assert {k: v for k, v in got.items() if v >= 30} == {k: v for k, v in want.items() if v >= 30}
    assert len(windows) < 0.7 * len(want)


def test_awkward_rows(spark):
    found = C.collocations(documents(spark), least=2)
    want = plain([("en", t) for _, t in AWKWARD], 4, 2, 80, 2000)
    assert sorted(map(tuple, found.collect())) == want
    assert C.collocations(empty(spark)).count() == 0
    clash = spark.createDataFrame([("en", "a b " * 40, 1, "x")], "lang string, text string, w1 int, count string")
    assert sorted(map(tuple, C.collocations(clash).collect())) == plain([("en", "a b " * 40)], 4, 30, 80, 2000)


def test_scores_pass_64_bits(spark):
    a, b = 5 * 10**12, 7 * 10**12
    windows = spark.createDataFrame([("en", "x", "y", None, None, a), ("en", "x", None, None, None, b - a), ("en", "y", None, None, None, b - a)],
                                    "lang string, w1 string, w2 string, w3 string, w4 string, count long")
    counts = {(r.size, r.phrase): r.f for r in C.phrase_counts(windows, 30).collect()}
    assert counts == {(0, ""): 2 * b - a, (1, "x"): b, (1, "y"): b - a, (2, "x y"): a}


def test_parts_of_phrases_are_not_broadcast(spark, monkeypatch):
    """A table of frequent phrases has small files; its rows, copied for the salted joins, fill the driver."""
    plans, write = {}, C.durable

    def watched(df, label, *more):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, label, *more)

    monkeypatch.setattr(C, "durable", watched)
    C.collocations(spark.createDataFrame(corpus(), "lang string, text string"))
    assert plans["collocation-scores"].count("SortMergeJoin") == 2
    assert "Broadcast" not in plans["collocation-scores"]
