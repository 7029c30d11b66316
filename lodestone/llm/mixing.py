"""Soft-membership mixing: document rates whose expected domain totals match targets."""

from __future__ import annotations

import re
import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodestone.llm.rows import free_name
from lodestone.session import discard, durable

#: Places of hashed tokens, and labelled rows of each domain that the classifier learns from (about).
PLACES = 1 << 18
SAMPLE = 2_000
#: Tokens of fewer labelled rows are not learned from.
LEAST = 3
EPOCHS, BATCH, STEP = 12, 64, 0.5
#: How strongly rates are held to 1 by default, and in a fit to targets.
HOLD, FIT_HOLD = 1e-3, 1e-5
#: Steps end when each domain is this close to its target, relative to it; or when PATIENCE
#: steps brought nothing, as no rates reach the targets; or, with a warning, after STEPS.
CLOSE = 5e-4
PATIENCE = 40
STEPS = 400
DOMAINS = ("high", "low", "toxic")
TOKEN = re.compile(rb"[a-z\x80-\xff]+|[^\sa-z\x80-\xff]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


class Classifier(NamedTuple):
    weights: np.ndarray  # (PLACES + 1, domains); the last row is the bias
    domains: tuple[str, ...]


class Fit(NamedTuple):
    """What makes a document's rate follow from its posterior: the weighed residual before every step."""

    residuals: np.ndarray  # (steps, domains)
    totals: np.ndarray  # expected tokens of each domain at the rates reached
    targets: np.ndarray

    @property
    def gap(self) -> float:
        """The largest distance of a domain from its target, relative to it."""
        return float(_gap(self.totals, self.targets))


def _gap(reached: np.ndarray, wanted: np.ndarray) -> float:
    whole = wanted.sum()
    return np.max(np.abs(reached - wanted) / np.where(wanted > 0, wanted, whole)) if whole > 0 else 0.0


def features(text: str | None) -> np.ndarray:
    """Distinct places of the whole text's letter runs and sign runs, lower-cased."""
    tokens = set(TOKEN.findall((text or "").encode("utf-8", "surrogatepass").translate(LOWER)))
    return np.unique(np.fromiter(map(zlib.crc32, tokens), np.int64, len(tokens)) % PLACES)


def domain(quality: str, toxic: str) -> Column:
    """A labelled row's domain: toxic before all, else by quality; null if a label is null."""
    known = F.col(quality).isNotNull() & F.col(toxic).isNotNull()
    return F.when(known, F.when(F.col(toxic) == 1, "toxic").when(F.col(quality) == 1, "high").otherwise("low"))


def train(rows: list[np.ndarray], labels: np.ndarray, domains: tuple[str, ...], seed: int = 5) -> Classifier:
    """Softmax regression on feature presence, scaled by the text's number of features, by AdaGrad."""
    rng = np.random.default_rng(seed)
    weights, seen = np.zeros((PLACES + 1, len(domains))), np.full((PLACES + 1, 1), 1e-8)
    shares = np.bincount(labels, minlength=len(domains)) / max(1, len(labels))
    weights[-1] = np.log(np.maximum(shares, 1e-3))
    held = np.bincount(np.concatenate(rows), minlength=PLACES)
    rows = [places[held[places] >= LEAST] for places in rows]
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            error = np.stack([_posterior(weights, rows[k]) for k in part])
            error[np.arange(len(part)), labels[part]] -= 1
            sizes = [len(rows[k]) for k in part]
            touched, inverse = np.unique(np.concatenate([*(rows[k] for k in part), [PLACES]]), return_inverse=True)
            slope = np.zeros((len(touched), len(domains)))
            np.add.at(slope, inverse[:-1], np.repeat(error * _scale(np.array(sizes))[:, None], sizes, axis=0))
            slope[-1] = error.sum(axis=0) * 0.1
            slope += 1e-4 * weights[touched]
            seen[touched] += (slope * slope).mean(axis=1, keepdims=True)
            weights[touched] -= STEP * slope / np.sqrt(seen[touched])
    return Classifier(weights.astype(np.float32), domains)


def _scale(n: np.ndarray) -> np.ndarray:
    return 8.0 / np.sqrt(np.maximum(n, 16))


def _posterior(weights: np.ndarray, places: np.ndarray) -> np.ndarray:
    x = weights[places].sum(axis=0, dtype=np.float64) * _scale(np.array(len(places))) + weights[-1]
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_classifier(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", quality: str = "quality", toxic: str = "toxic"
) -> Classifier | None:
    """Learn domains from about SAMPLE labelled rows of each, chosen by a hash of doc_id.

    The chosen labels are few, so documents are not shuffled to find their texts. None if
    no document has labels.
    """
    named = labels.select(F.col(doc_id).alias("doc_id"), domain(quality, toxic).alias("domain")).where("doc_id is not null and domain is not null")
    counts = {r["domain"]: r["n"] for r in named.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    ticket, chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(21)), F.lit(1 << 30)), F.lit(False)
    for name, n in counts.items():
        chosen |= (F.col("domain") == name) & (ticket < min(1 << 30, -(-(SAMPLE << 30) // n)))
    few = durable(named.where(chosen).distinct(), "mixing-labels")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(few, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t.as_py()).astype(np.int32) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.int32())), batch.column(2)], names=["doc_id", "places", "domain"])

    sample = texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "domain").mapInArrow(run, "doc_id long, places array<int>, domain string").toArrow()
    discard(few)
    if not sample.num_rows:
        return None
    rows = sorted(zip(sample.column("doc_id").to_pylist(), sample.column("domain").to_pylist(), sample.column("places").to_pylist()))
    return train([np.array(p, np.int64) for _, _, p in rows], np.array([DOMAINS.index(d) for _, d, _ in rows]), DOMAINS)


def posteriors(docs: DataFrame, model: Classifier | None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, its number of words, and ``posterior``, one probability for each domain."""

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [_posterior(model.weights, features(t.as_py())) for t in column]
            yield pa.array(found, pa.list_(pa.float64()))

    even = F.array(*[F.lit(1.0 / len(DOMAINS)) for _ in DOMAINS])
    content = F.col(text).cast("string")
    words = F.coalesce(F.size(F.filter(F.split(F.trim(content), "[\\t-\\r ]+"), lambda w: w != "")), F.lit(0))
    words = F.when(content.isNull(), 0).otherwise(words).cast("long")
    return docs.withColumns({"n_tokens": words, "posterior": F.arrow_udf(run, "array<double>")(content) if model else even})


def rates(p: np.ndarray, residuals: np.ndarray, hold: float = HOLD) -> tuple[np.ndarray, np.ndarray]:
    """Rates and their look-ahead point after the given steps, for rows of posteriors ``p``.

    Accelerated projected gradient on ``|A(r) - target|^2 / 2 + hold |r - 1|^2 / 2`` with
    rates weighted by tokens: what a step does to a document depends on its posterior and
    on the global residual only. So a task that is run again finds the same rates. The
    squares may weigh domains, if the residuals come with their weights.
    """
    rate = ahead = np.ones(len(p))
    pace, pull = 1.0 / (1.0 + hold), 1.0
    for residual in residuals:
        moved = np.maximum(0.0, ahead - pace * (p @ residual + hold * (ahead - 1.0)))
        following = (1.0 + np.sqrt(1.0 + 4.0 * pull * pull)) / 2.0
        ahead = moved + (pull - 1.0) / following * (moved - rate)
        rate, pull = moved, following
    return rate, ahead


def fit_rates(rated: DataFrame, targets: dict[str, float]) -> Fit:
    """Steps that bring expected domain totals to their shares of all tokens.

    ``rated`` has ``n_tokens`` and ``posterior``. Every step is one pass that sums a few
    numbers per task; nothing of a document is kept between steps. The squares of the
    least-squares sum are weighed by the inverse of the posteriors' second moments, so
    rare domains count as much as common ones and a few steps suffice. Where no rates reach
    the targets the fit is the nearest in that measure; ``Fit.gap`` says how near.
    """
    total = rated.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    wanted = np.array([targets.get(name, 0.0) for name in DOMAINS])
    wanted = wanted / wanted.sum()
    residuals, size = np.zeros((0, len(DOMAINS))), len(DOMAINS)
    if not total:
        return Fit(residuals, np.zeros(size), wanted * total)

    def summed(of) -> np.ndarray:
        """Sums over all documents of rows of numbers made from token shares and posteriors."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((size, size))
            for batch in batches:
                if batch.num_rows:
                    t = batch.column(0).to_numpy(zero_copy_only=False) / total
                    p = batch.column(1).flatten().to_numpy().reshape(-1, size)
                    made = of(t, p)
                    sums[: len(made)] += made
            yield pa.record_batch([pa.array(np.repeat(np.arange(size), size)), pa.array([*range(size)] * size), pa.array(sums.ravel())], names=["k", "d", "x"])

        # Summed as decimals, so that the order of tasks changes nothing.
        part = rated.select("n_tokens", "posterior").mapInArrow(run, "k long, d long, x double")
        out = np.zeros((size, size))
        for row in part.groupBy("k", "d").agg(F.sum(F.col("x").cast("decimal(30,18)")).alias("x")).collect():
            out[row["k"], row["d"]] = float(row["x"])
        return out

    weights = np.linalg.pinv(summed(lambda t, p: (t[:, None] * p).T @ p), rcond=1e-9, hermitian=True)
    nearest, idle = np.inf, 0
    for _ in range(STEPS):
        reached, ahead = summed(lambda t, p: np.stack([(t * r) @ p for r in rates(p, residuals, FIT_HOLD)]))[:2]
        gap = _gap(reached, wanted)
        idle = 0 if gap < 0.99 * nearest else idle + 1
        nearest = min(nearest, gap)
        if gap < CLOSE or idle >= PATIENCE:
            break
        residuals = np.concatenate([residuals, (weights @ (ahead - wanted))[None, :]])
    fit = Fit(residuals, reached * total, wanted * total)
    if fit.gap >= CLOSE:
        warnings.warn(f"domain targets are missed by up to {fit.gap:.2%}: {dict(zip(DOMAINS, fit.totals))} instead of {dict(zip(DOMAINS, fit.targets))}")
    return fit


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    doc_id: str = "doc_id",
    text: str = "text",
    columns: list[str] | None = None,
) -> tuple[DataFrame, Fit]:
    """``docs``, or the named columns of it, with ``n_tokens``, ``posterior``, ``rate`` and ``copies``, and the fit.

    Domain posteriors come from a classifier learned on the labelled table; rates are
    nonnegative and make the expected tokens of each domain match its target share of all
    tokens, as far as posteriors allow. ``copies`` rounds the rate up or down by a hash of
    doc_id, so that it is right on average. Null and empty texts have no tokens and take
    part with the posterior of no features; without any labels posteriors are even. Rows
    that repeat a document get the same values; columns of these names are replaced, all
    others stay; an empty table gives no rows.
    """
    model = fit_classifier(docs, labels, doc_id, text)
    new = ("n_tokens", "posterior", "rate", "copies")
    kept = [c for c in (docs.columns if columns is None else columns) if c not in new]
    # Written once, as texts are costly to read; every step reads its two narrow columns only.
    drawn = free_name(docs, "_ticket")
    ticket = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit(33)), F.lit(1 << 30)).alias(drawn)
    rated = posteriors(docs, model, text).select(*kept, "n_tokens", "posterior", ticket)
    rated = durable(rated, "mixing-posteriors")
    fit = fit_rates(rated, targets)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            p = column.flatten().to_numpy().reshape(-1, len(DOMAINS))
            yield pa.array(rates(p, fit.residuals, FIT_HOLD)[0])

    rated = rated.withColumn("rate", F.arrow_udf(run, "double")("posterior"))
    whole = F.floor("rate")
    copies = whole + (F.col(drawn) / float(1 << 30) < F.col("rate") - whole).cast("long")
    return rated.withColumn("copies", copies.cast("int")).drop(drawn), fit
