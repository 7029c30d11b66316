"""Language identification with a small byte convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodestone.llm.rows import free_name

#: Bytes of a window, widths of the filters, and filters of each width.
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
#: The labelled sample: about this many rows of each language, and windows of each row.
SAMPLE_ROWS = 400
SAMPLE_WINDOWS = 4
STEPS, BATCH, RATE = 400, 96, 0.02
#: Windows that are scored at once.
AT_ONCE = 384
UNKNOWN = "und"


class Network(NamedTuple):
    languages: list[str]
    tables: list[np.ndarray]  # for each width: (width, 256, FILTERS)
    bias: np.ndarray  # one for each filter
    out: np.ndarray  # (filters, languages)
    out_bias: np.ndarray


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Fit filters and output weights by Adam on the cross-entropy of window labels.

    Only the place of each filter's largest response takes part in its gradient.
    """
    rng = np.random.default_rng(seed)
    total = FILTERS * len(WIDTHS)
    net = Network(
        languages,
        [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        rng.normal(0, 0.2, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    values = [*net.tables, net.bias, net.out, net.out_bias]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    for step in range(1, STEPS + 1):
        # Every language has an equal part in a batch, however many windows it has.
        wanted = rng.integers(0, len(languages), BATCH)
        pick = np.array([rng.choice(np.flatnonzero(labels == k)) for k in wanted])
        x, y = windows[pick].astype(np.int64), labels[pick]
        pooled, places = [], []
        for w, table in zip(WIDTHS, net.tables):
            n = WINDOW - w + 1
            response = sum(table[k][x[:, k : k + n]] for k in range(w))
            at = response.argmax(axis=1)
            places.append(at)
            pooled.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0, :])
        z = np.concatenate(pooled, axis=1) + net.bias
        a = np.maximum(z, 0)
        error = _softmax(a @ net.out + net.out_bias)
        error[np.arange(BATCH), y] -= 1
        error /= BATCH
        back = (error @ net.out.T) * (z > 0)
        slopes = []
        for number, (w, table) in enumerate(zip(WIDTHS, net.tables)):
            slope, part = np.zeros_like(table), back[:, number * FILTERS : (number + 1) * FILTERS]
            for k in range(w):
                seen = np.take_along_axis(x, places[number] + k, axis=1)
                np.add.at(slope[k], (seen, np.arange(FILTERS)[None, :]), part)
            slopes.append(slope)
        slopes += [back.sum(axis=0), a.T @ error, error.sum(axis=0)]
        pace = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for v, m, s, g in zip(values, first, second, slopes):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            v -= pace * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
    return net


class Scorer:
    """A network made ready for many windows: filters read two bytes per table look-up."""

    def __init__(self, net: Network):
        self.net, self.steps = net, []
        for w, table in zip(WIDTHS, net.tables):
            parts = []
            for k in range(0, w, 2):
                pair = k + 1 < w
                parts.append((k, pair, (table[k][:, None, :] + table[k + 1][None, :, :]).reshape(-1, FILTERS) if pair else table[k]))
            self.steps.append((w, parts))

    def posteriors(self, windows: np.ndarray) -> np.ndarray:
        single = windows.astype(np.int64)
        double = single[:, :-1] * 256 + single[:, 1:]
        pooled = []
        for w, parts in self.steps:
            n = WINDOW - w + 1
            response = None
            for k, pair, table in parts:
                part = table.take((double if pair else single)[:, k : k + n], axis=0)
                response = part if response is None else np.add(response, part, out=response)
            pooled.append(response.max(axis=1))
        a = np.maximum(np.concatenate(pooled, axis=1) + self.net.bias, 0)
        return _softmax((a @ self.net.out + self.net.out_bias).astype(np.float64))


def fold(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(4))


def fit(docs: DataFrame, allowed: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """Learn from rows for which ``allowed`` holds; None if there are none with text and language.

    A bounded sample is collected: SAMPLE_ROWS rows of each language at most, those of the
    smallest hashes of doc_id and text, and SAMPLE_WINDOWS windows of each, at places spread
    over its text. Rows that repeat another's doc_id and text add nothing to it.
    """
    content = F.encode(F.col(text).cast("string"), "UTF-8")
    rows = docs.where(allowed & F.col(lang).isNotNull() & (F.octet_length(F.col(text).cast("string")) > 0))
    counts = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    seed = F.xxhash64(F.col(doc_id).cast("string"), F.col(text).cast("string"), F.lit(11))
    ticket, chosen = F.pmod(seed, F.lit(1 << 30)), F.lit(False)
    for name in languages:
        # Twice as many as wanted pass, so that the cut below finds enough.
        chosen |= (F.col(lang) == name) & (ticket < min(1 << 30, -(-(2 * SAMPLE_ROWS << 30) // counts[name])))
    size = F.octet_length(content)
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(SAMPLE_WINDOWS - 1)),
        lambda k: F.pmod(F.xxhash64(seed, k), F.greatest(F.lit(1), size - WINDOW + 1)).cast("int"),
    )
    cut = F.transform(starts, lambda at: F.substring(content, at + 1, F.lit(WINDOW)))
    drawn = rows.where(chosen).select(F.col(lang).alias("lang"), ticket.alias("ticket"), F.array_distinct(cut).alias("windows")).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("ticket", "windows"))
    sample = drawn.withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS).select("lang", F.explode("windows").alias("window")).toArrow()
    if not sample.num_rows:
        return None
    languages = sorted(set(sample.column("lang").to_pylist()))  # those with windows
    pairs = sorted(zip(sample.column("lang").to_pylist(), sample.column("window").to_pylist()))
    windows = np.stack([_window(w) for _, w in pairs])
    return train(windows, np.array([languages.index(name) for name, _ in pairs]), languages)


def _window(data: bytes) -> np.ndarray:
    return np.frombuffer(data.ljust(WINDOW, b"\0"), np.uint8)


def predict(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, from the text alone.

    The whole text is cut into windows; the mean posterior, each window weighted by its
    bytes, decides, and is the score. Equal means go to the first language by name. A
    null text, one without a letter, and all texts where there was nothing to learn from
    get ``und`` and score 0. An empty table gives no rows.
    """
    names = net.languages if net else []

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(net)
        for column in columns:
            sums = np.zeros((len(column), len(names)))
            sizes = np.ones(len(column))
            held, rows, weights = [], [], []

            def settle() -> None:
                grid = np.frombuffer(b"".join(held), np.uint8).reshape(-1, WINDOW)
                np.add.at(sums, np.array(rows), scorer.posteriors(grid) * np.array(weights)[:, None])
                held.clear(), rows.clear(), weights.clear()

            for row, value in enumerate(column):
                data = (value.as_py() or "").encode("utf-8", "surrogatepass")
                sizes[row] = max(1, len(data))
                for at in range(0, len(data), WINDOW):
                    piece = data[at : at + WINDOW]
                    held.append(piece.ljust(WINDOW, b"\0"))
                    rows.append(row)
                    weights.append(len(piece))
                    if len(held) == AT_ONCE:
                        settle()
            if held:
                settle()
            means = sums / sizes[:, None]
            best = means.argmax(axis=1)
            score = np.minimum(1.0, means[np.arange(len(best)), best])
            yield pa.StructArray.from_arrays([pa.array([names[k] for k in best], pa.string()), pa.array(score)], ["lang", "score"])

    content = F.col(text).cast("string")
    known = content.isNotNull() & content.rlike("\\p{L}") if names else F.lit(False)
    if not names:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    label = F.arrow_udf(run, "lang string, score double")
    columns, made = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")], free_name(docs, "_found")
    found = docs.select(*columns, F.when(known, label(content)).alias(made))
    return found.select(
        *columns, F.coalesce(f"{made}.lang", F.lit(UNKNOWN)).alias("lang_pred"), F.coalesce(f"{made}.score", F.lit(0.0)).alias("score")
    )
