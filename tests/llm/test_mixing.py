import numpy as np
import pytest
from fixtures import AWKWARD, documents, empty
from pyspark.sql import functions as F

from lodestone.llm import mixing

TARGETS = {"high": 0.6, "low": 0.3, "toxic": 0.1}
SF = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_targets_are_met(spark):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    mixed, fit = mixing.mix(docs, known, TARGETS)
    rows = mixed.select("n_tokens", "posterior", "rate", "copies").collect()
    totals = sum(r.n_tokens * r.rate * np.array(r.posterior) for r in rows)
    all_tokens = sum(r.n_tokens for r in rows)
    assert np.allclose(totals / all_tokens, [0.6, 0.3, 0.1], atol=5e-3)
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    kept = sum(r.n_tokens * r.copies for r in rows)
    assert abs(kept / sum(r.n_tokens * r.rate for r in rows) - 1) < 0.1


@pytest.mark.parametrize("wanted", [{"high": 0.82, "low": 0.13, "toxic": 0.05}, {"high": 0.92, "low": 0.06, "toxic": 0.02}])
def test_rare_targets_are_met_to_a_hundredth(spark, wanted):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    mixed, fit = mixing.mix(docs, known, wanted, columns=["doc_id"])
    assert fit.gap < mixing.CLOSE and len(fit.residuals) < 100
    rows = mixed.select("n_tokens", "posterior", "rate").collect()
    totals = sum(r.n_tokens * r.rate * np.array(r.posterior) for r in rows) / sum(r.n_tokens for r in rows)
    assert np.allclose(totals / [wanted[d] for d in mixing.DOMAINS], 1, atol=0.01)


def test_targets_out_of_reach_are_told(spark):
    rated = spark.createDataFrame([(10, [0.5, 0.3, 0.2]), (30, [0.6, 0.3, 0.1])], "n_tokens long, posterior array<double>")
    with pytest.warns(UserWarning, match="missed"):
        fit = mixing.fit_rates(rated, {"toxic": 1.0})
    assert fit.gap > 0.1 and len(fit.residuals) < mixing.STEPS


def test_rates_equal_a_direct_solution():
    """The steps end where a solver for the few multipliers ends."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet([2, 1, 0.5], 500)
    t = rng.integers(1, 100, 500) / 1.0
    t /= t.sum()
    wanted = np.array([0.3, 0.5, 0.2])
    residuals = np.zeros((0, 3))
    for _ in range(400):
        _, ahead = mixing.rates(p, residuals)
        residuals = np.concatenate([residuals, ((t * ahead) @ p - wanted)[None, :]])
    rate, _ = mixing.rates(p, residuals)
    y = np.zeros(3)
    for _ in range(200_000):
        direct = np.maximum(0, 1 - p @ y / mixing.HOLD)
        y += 1e-3 * ((t * direct) @ p - wanted - y)
    assert np.allclose(rate, np.maximum(0, 1 - p @ y / mixing.HOLD), atol=0.05)


def test_classifier_learns_labels(spark):
    docs, known = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    model = mixing.fit_classifier(docs, known.where(fold != 0))
    held = mixing.posteriors(docs.join(known.where(fold == 0), "doc_id"), model).withColumn("domain", mixing.domain("quality", "toxic"))
    rows = held.select("domain", "posterior").collect()
    right = sum(mixing.DOMAINS[int(np.argmax(r.posterior))] == r.domain for r in rows)
    assert right / len(rows) >= 0.75


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STEPS", 6)
    known = labels(spark, [(5, 1, 0), (5, 1, 0), (2, 0, 1), (9, None, 0), (7, 0, 0), (None, 1, 1), (99, 1, 1)])
    mixed, _ = mixing.mix(documents(spark), known, TARGETS)
    assert mixed.columns == [*documents(spark).columns, "n_tokens", "posterior", "rate", "copies"]
    rows = mixed.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert r.n_tokens == len((r.text or "").split()) and abs(sum(r.posterior) - 1) < 1e-9 and r.rate >= 0


@pytest.mark.parametrize("known", [[], [(1, None, None)]])
def test_without_labels(spark, monkeypatch, known):
    monkeypatch.setattr(mixing, "STEPS", 6)
    mixed, _ = mixing.mix(documents(spark), labels(spark, known), TARGETS)
    assert {tuple(r.posterior) for r in mixed.collect()} == {(1 / 3, 1 / 3, 1 / 3)}


def test_empty(spark):
    assert mixing.mix(empty(spark), labels(spark, [(1, 1, 0)]), TARGETS)[0].count() == 0
