import pytest
from pyspark.sql import functions as F

from lodestone.operators import capture as C
from lodestone.operators import membership as M


@pytest.mark.parametrize("n, every", [(40_000, 7), (1_000, 1), (500, 10_000)])
def test_no_match_is_lost_and_few_others_stay(spark, n, every):
    keys = spark.range(0, n * every, every).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(200_000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    kept = M.may_match(rows, "key", M.bit_table(keys, "key"))
    true = min(n, -(-200_000 // every))
    assert kept.columns == ["id", "key"]
    assert kept.join(keys, "key", "left_semi").count() == true
    assert kept.count() - true <= 5 + 3 * 200_000 * n / M.BITS


def test_nulls_and_no_keys(spark):
    rows = spark.createDataFrame([(1, None), (2, "a")], "id int, key string")
    none = spark.createDataFrame([], "key string")
    assert M.may_match(rows, "key", M.bit_table(none, "key")).count() == 0
    keys = spark.createDataFrame([(None,), ("a",)], "key string")
    assert [r.id for r in M.may_match(rows, "key", M.bit_table(keys, "key")).collect()] == [2]


def test_texts_of_other_pages_are_not_moved(spark, tmp_path):
    """Rows that go into the exchange of texts are those of the pages asked for."""
    pages = spark.range(5_000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.lit("<p>x").alias("html"))
    pages.write.parquet(str(tmp_path / "pages"))
    requested = spark.range(0, 5_000, 50).select(F.concat(F.lit("http://h/"), "id").alias("url"))
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "-1")
    try:
        items = C.fetch(requested, spark.read.parquet(str(tmp_path / "pages")))
        assert items.count() == 100
        items.collect()
        nodes = items._jdf.queryExecution().executedPlan()
        text = nodes.toString()
        assert "SortMergeJoin" in text and "Exchange" in text
        moved = []

        def walk(node):
            name = node.nodeName()
            if "Exchange" in name and "Broadcast" not in name and any(node.output().apply(k).name() == "html" for k in range(node.output().size())):
                moved.append(node.metrics().apply("shuffleRecordsWritten").value())
            if name in ("AdaptiveSparkPlan",):
                walk(node.executedPlan())
            if name.endswith("QueryStage"):
                walk(node.plan())
            for k in range(node.children().size()):
                walk(node.children().apply(k))

        walk(nodes)
        assert moved and sum(moved) == 100
    finally:
        spark.conf.set(conf, before)
