import math
import random

import numpy as np
import pytest

from lodestone.llm import embedding_dedup as E


def plain(rows, cosine):
    usable = [k for k, (i, v, l) in enumerate(rows) if i is not None and l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    unit = {k: E.unit(np.array([rows[k][1]], float))[0] for k in usable}
    links = {k: [j for j in usable if j != k and rows[j][2] == rows[k][2] and len(unit[j]) == len(unit[k]) and (rows[j][1] == rows[k][1] or unit[k] @ unit[j] >= cosine)] for k in usable}
    out = []
    for k, (i, _, _) in enumerate(rows):
        seen, stack = {k}, [k]
        while stack:
            for j in links.get(stack.pop(), []):
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        least = i if k not in links else min(rows[j][0] for j in seen)
        out.append((i, len(links.get(k, [])), least, i is not None and least == i))
    return sorted(out, key=repr)


def found(spark, rows, cosine=0.98):
    table = spark.createDataFrame([(*r, 1, "q") for r in rows], "vec_id long, embedding array<double>, label int, rep int, x string")
    result = E.near_duplicates(table, cosine).select("vec_id", "n_links", "component_id", "kept").collect()
    return sorted((tuple(r) for r in result), key=repr)


@pytest.mark.parametrize("case", ["clusters", "many cells", "pieces"])
def test_equals_brute_force(spark, monkeypatch, case):
    rng = random.Random(case)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(20)]
    rows = []
    for i in range(220):
        c = rng.choice(centres)
        rows.append((i * 3, [x + rng.gauss(0, 0.08) for x in c], rng.choice((1, 1, 2))))
    rows += [(1000 + k, rows[0][1], 1) for k in range(9)]
    if case == "many cells":
        monkeypatch.setattr(E, "CELL", 8)
    if case == "pieces":
        monkeypatch.setattr(E, "PIECE", 16)
        monkeypatch.setattr(E, "CELL", 40)
    assert found(spark, rows) == plain(rows, 0.98)


def test_awkward_rows(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1e300, 0.0], 1), (4, [1e-300, 0.0], 1), (5, [1.0, 0.0], None)]
    rows += [(6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [float("nan"), 1.0], 1), (10, [float("inf"), 1.0], 1), (11, [None, 1.0], 1)]
    rows += [(12, [1.0, 0.0, 0.0], 1), (None, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (13, [1.0, 0.0], 2), (14, [-1.0, 0.0], 1)]
    assert found(spark, rows) == plain(rows, 0.98)


def test_a_repeated_vec_id_keeps_the_links_of_each_vector(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.001], 1), (3, [0.001, 1.0], 1), (1, [1.0, 0.0], 2)]
    got = found(spark, rows)
    assert got == plain(rows, 0.98)
    assert (2, 1, 1, False) in got and (3, 1, 1, False) in got


def test_empty(spark):
    assert found(spark, []) == []


def test_every_neighbour_meets_in_the_home_cell():
    rng = np.random.default_rng(1)
    points = E.unit(rng.normal(size=(400, 5)))
    centres = E.spherical_kmeans(points, 30)
    home, copied = E.cells_of(points, centres, 0.9)
    near = points @ points.T >= 0.9
    for a, b in zip(*np.nonzero(near)):
        assert copied[b, home[a]]
