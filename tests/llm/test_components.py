import random

from lodestone.llm.components import components


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(k, k + 1) for k in range(200, 290)]
    edges += [(300, 300), (None, 4), (310, 300), (310, 300)]
    names = {}

    def root(x):
        while names.setdefault(x, x) != x:
            x = names[x]
        return x

    for u, v in edges:
        if u is not None and u != v:
            a, b = root(u), root(v)
            names[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted((r.node, r.root) for r in found) == sorted((x, root(x)) for x in list(names))


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
