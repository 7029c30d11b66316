import math
import random

import numpy as np
import pytest

from lodestone.llm import topk


def plain(rows, k, every):
    whole = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(256 * x) for x in v]))
    out = []
    for i, q in {i: q for i, q in reversed(whole) if i % every == 0}.items():
        best = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i and len(v) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(best[:k], 1)]
    return sorted(out)


def found(spark, rows, k=5, every=5):
    table = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, q string, b int")
    return sorted(tuple(r) for r in topk.top_k(table, k, every).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("case", ["random", "ties", "few", "awkward", "large"])
def test_equals_brute_force(spark, case, monkeypatch):
    rng = random.Random(case)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(60)]
    if case == "ties":
        rows = [(i, [0.5, rng.choice((0.25, -0.25))]) for i in range(80)]
    if case == "few":
        rows = rows[:4]
    if case == "awkward":
        rows += [(70, None), (71, [None, 1.0, 0.0, 0.0]), (75, [float("nan")] * 4), (80, [float("inf"), 0.0, 0.0, 0.0])]
        rows += [(None, [1.0] * 4), (85, []), (90, [1.0, 2.0]), (91, [3.0, 4.0]), (7, rows[7][1]), (8, rows[9][1]), (95, [0.0] * 4)]
    if case == "large":
        rows = [(i, [x * 1e6 for x in v]) for i, v in rows]
    if case in ("random", "ties"):
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 20)
        monkeypatch.setattr(topk, "QUERY_BLOCK", 5)
    assert found(spark, rows) == plain(rows, 5, 5)


def test_empty(spark):
    assert found(spark, []) == []


def test_scores_beyond_floats_are_exact():
    a = np.array([[2**40 + 1, 3]], np.int64)
    b = np.array([[2**20 + 1, 7], [2**30, -5]], np.int64)
    assert topk.scores(a, b).tolist() == [[(2**40 + 1) * (2**20 + 1) + 21, min(2**63 - 1, (2**40 + 1) * 2**30 - 15)]]
