import json
import random

from pyspark.sql import functions as F

from lodestone.operators import harvest as V


def harvested(spark, operator, *values):
    rows = [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return operator(spark.createDataFrame(rows, "doc int, content string")).orderBy("doc", "value_pos").collect()


NESTED = {
    "http://key": "http://a",
    "list": ["http://b", ["http://c", 5, None, "no"], {"x": "http://d\"\\é"}],
    "again": "http://a",
    "colon:": "say \"http://no\": http://no",
    "deep": {"url": "http://e", "is_pdf": 1, "more": {"url": 7, "k": [{"url": "http://f"}]}},
}


def walk(value):
    if isinstance(value, dict):
        for item in value.values():
            yield from walk(item)
    elif isinstance(value, list):
        for item in value:
            yield from walk(item)
    elif isinstance(value, str) and value.startswith("http://"):
        yield value


def test_all_values_in_document_order(spark):
    got = [r.url for r in harvested(spark, V.harvest_urls, NESTED)]
    assert got == list(walk(NESTED)) == ["http://a", "http://b", "http://c", 'http://d"\\é', "http://a", "http://e", "http://f"]


def test_long_strings_do_not_overflow(spark):
    got = harvested(spark, V.harvest_urls, {"t": "\\\"" * 200_000, "u": "http://a"})
    assert [r.url for r in got] == ["http://a"]


def test_objects_show_twice(spark):
    assert [(r.url, r.is_pdf) for r in harvested(spark, V.harvest_urls_with_pdf, {"url": "http://a.b", "is_pdf": True})] == [("http://a.b", True), ("http://a.b", False)]
    got = [(r.url, r.is_pdf) for r in harvested(spark, V.harvest_urls_with_pdf, NESTED)]
    assert got[5:] == [("http://e", True), ("http://e", False), ("http://f", False), ("http://f", False)]
    plain = [r.url for r in harvested(spark, V.harvest_urls, NESTED)]
    assert [u for u, _ in got if u not in ("http://e", "http://f")] == plain[:5]


def test_broken_documents_yield_nothing(spark):
    assert harvested(spark, V.harvest_urls_with_pdf, "{oops") == []


def plain_walk(node, out):
    """Strings and objects in document order; a repeated key counts once, at its last place."""
    if isinstance(node, list) and node and node[0] == "object":
        last = {k: i for i, (k, _) in enumerate(node[1])}
        kept = [(k, v) for i, (k, v) in enumerate(node[1]) if last[k] == i]
        named = dict(kept)
        if isinstance(named.get("url"), str):
            flag = named.get("is_pdf", False)
            truth = bool(flag[1]) if isinstance(flag, list) else bool(flag)
            out.append((named["url"], truth, True))
        for _, v in kept:
            plain_walk(v, out)
    elif isinstance(node, list):
        for v in node[1]:
            plain_walk(v, out)
    elif isinstance(node, str):
        out.append((node, False, False))


def written(node):
    if isinstance(node, list) and node[0] == "object":
        return "{" + " , ".join(f"{json.dumps(k)} : {written(v)}" for k, v in node[1]) + "}"
    if isinstance(node, list):
        return "[" + ",".join(map(written, node[1])) + "]"
    return json.dumps(node)


def any_node(rng, depth):
    kind = rng.random()
    if depth and kind < 0.35:
        keys = ["url", "is_pdf", "x", 'q"{', "ur\\l"]
        return ["object", [(rng.choice(keys), any_node(rng, depth - 1)) for _ in range(rng.randint(0, 4))]]
    if depth and kind < 0.55:
        return ["list", [any_node(rng, depth - 1) for _ in range(rng.randint(0, 3))]]
    return rng.choice([f"http://h{rng.randint(0, 99)}/", 'http://q/"]}{é', "http://b\\u", "text", "", 0, 1, -0.0, 2.5, True, False, None])


def test_any_document_equals_a_plain_walk(spark):
    rng = random.Random(11)
    nodes = [any_node(rng, 6) for _ in range(900)]
    both, strings = [], []
    for doc, node in enumerate(nodes):
        out = []
        plain_walk(node, out)
        both += [(doc, k, u, p) for k, (u, p, _) in enumerate(out) if u.startswith("http://")]
        only = [u for u, _, is_object in out if not is_object]
        strings += [(doc, k, u) for k, u in enumerate(only) if u.startswith("http://")]
    texts = [written(n) for n in nodes]
    assert len(both) > 300
    assert [tuple(r) for r in harvested(spark, V.harvest_urls_with_pdf, *texts)] == both
    assert [tuple(r) for r in harvested(spark, V.harvest_urls, *texts)] == strings


def test_both_harvests_take_the_last_of_a_repeated_key(spark):
    text = '{"a":"http://1","a":"http://2","b":{"url":"http://3"},"b":[{"url":"http://4","is_pdf":0,"is_pdf":[0]}]}'
    assert [r.url for r in harvested(spark, V.harvest_urls, text)] == ["http://2", "http://4"]
    assert [(r.url, r.is_pdf) for r in harvested(spark, V.harvest_urls_with_pdf, text)] == [("http://2", False), ("http://4", True), ("http://4", False)]


def test_deep_documents(spark):
    text = '{"k":[' * 300 + '{"url":"http://deep","is_pdf":true}' + "]}" * 300
    assert [(r.url, r.is_pdf) for r in harvested(spark, V.harvest_urls_with_pdf, text)] == [("http://deep", True), ("http://deep", False)]


def test_bad_documents_have_a_status(spark):
    rows = spark.createDataFrame([(1, '{"a":1}'), (2, "{oops"), (3, None), (4, ""), (5, '"http://a"')], "doc int, content string")
    assert dict(map(tuple, V.harvest_status(rows).collect())) == {1: "ok", 2: "invalid_json", 3: "invalid_json", 4: "invalid_json", 5: "ok"}
    assert [(r.doc, r.url) for r in V.harvest_urls(rows).collect()] == [(5, "http://a")]


def test_tokens_are_dealt_by_the_size_of_the_documents(spark, monkeypatch):
    """Tokens are sorted in tasks of bounded size, however few partitions the session shuffles into."""
    monkeypatch.setattr(V, "PART_BYTES", 1_000)
    content = '{"hits":[{"url":"http://a.b/1","is_pdf":true},{"url":"http://a.b/2"}],"more":"' + "x" * 400 + '"}'
    documents = spark.range(40).select(F.col("id").alias("doc"), F.lit(content).alias("content"))
    found = V.harvest_urls(documents)
    assert found.count() == 80 and found.rdd.getNumPartitions() >= 15
    assert V.harvest_urls_with_pdf(documents.limit(0)).count() == 0
