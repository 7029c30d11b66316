import math

from fixtures import documents, empty
from pyspark.sql import functions as F

from lodestone.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = language.fold("doc_id")
    found = language.predict(docs, language.fit(docs, fold != 2)).where((fold == 2) & (F.col("lang_pred") != "und"))
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert found.count() > 200 and right >= 0.97


def test_awkward_rows(spark):
    net = language.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), F.lit(True))
    rows = language.predict(documents(spark), net).collect()
    by = {(r.doc_id, r.text): r for r in rows}
    assert len(rows) == 12
    for key in ((7, None), (3, ""), (4, " \t\n ")):
        assert (by[key].lang_pred, by[key].score) == ("und", 0.0)
    assert all(r.lang_pred in net.languages and 0 < r.score <= 1 for k, r in by.items() if r.text and r.text.strip())


def test_lang_and_source_are_no_inputs(spark):
    net = language.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), F.lit(True))
    one, two = documents(spark), documents(spark).withColumns({"lang": F.lit("de"), "doc_id": F.lit(1)})
    a, b = (sorted(map(tuple, language.predict(d, net).select("text", "lang_pred", "score").na.fill("").collect())) for d in (one, two))
    assert a == b


def test_nothing_to_learn_from(spark):
    assert language.fit(empty(spark), F.lit(True)) is None
    assert language.predict(empty(spark), None).count() == 0
    assert {(r.lang_pred, r.score) for r in language.predict(documents(spark), None).collect()} == {("und", 0.0)}


def forward(net, data):
    """The network's posterior of one window, number by number."""
    data = data.ljust(language.WINDOW, b"\0")
    pooled = []
    for width, table in zip(language.WIDTHS, net.tables):
        for f in range(language.FILTERS):
            places = range(language.WINDOW - width + 1)
            pooled.append(max(sum(float(table[k][data[at + k]][f]) for k in range(width)) for at in places))
    hidden = [max(0.0, z + float(b)) for z, b in zip(pooled, net.bias)]
    logits = [sum(h * float(w) for h, w in zip(hidden, net.out[:, j])) + float(net.out_bias[j]) for j in range(len(net.languages))]
    powers = [math.exp(x - max(logits)) for x in logits]
    return [x / sum(powers) for x in powers]


def test_scores_equal_a_plain_forward_pass(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    net = language.fit(docs, F.lit(True))
    texts = [r.text for r in docs.where("length(text) < 1200 and text rlike '[a-z]'").limit(5).collect()] + ["é", "a" * 256 + "bcd", "x" * 700]
    found = language.predict(spark.createDataFrame([(t,) for t in texts], "text string"), net).collect()
    for row in found:
        data = row.text.encode()
        windows = [data[at : at + language.WINDOW] for at in range(0, len(data), language.WINDOW)]
        means = [sum(len(w) * p for w, p in zip(windows, column)) / len(data) for column in zip(*(forward(net, w) for w in windows))]
        assert row.lang_pred == net.languages[means.index(max(means))] and abs(row.score - max(means)) < 1e-4


def test_whole_text_counts(spark):
    """The end of a text decides as much as its start."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = language.fit(docs, F.lit(True))
    by = {r.lang: r.text for r in docs.where("length(text) between 1500 and 2500").collect()}
    text = by["en"] + by["de"] * 8
    found = language.predict(spark.createDataFrame([(text,)], "text string"), net).first()
    assert found.lang_pred == "de" and found.score < 0.99


def test_a_language_whose_rows_repeat_one_id(spark):
    rows = [(1, f"der text nummer {k} ist deutsch und anders", "de") for k in range(3_000)] + [(k, f"the text number {k} is english", "en") for k in range(300)]
    rows += [(7, "immer derselbe text hier", "fr")] * 3_000
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = language.fit(table, F.lit(True))
    assert {"de", "en"} <= set(net.languages)
    found = language.predict(table, net)
    right = found.where("lang <> 'fr'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
