import random

import numpy as np
import pytest
from fixtures import AWKWARD, documents, empty
from pyspark.sql import functions as F

from lodestone.llm import repeats
from lodestone.llm.suffix_sort import permuted_common_prefixes, suffix_array


def plain(rows, width):
    seen, out = set(), []
    texts = {(2**63 - 1 if i is None else i, t): (t or "").encode() for i, t in rows}
    marks = {}
    for (i, t), data in sorted(texts.items(), key=lambda x: x[0][0]):
        gone = bytearray(len(data))
        for k in range(len(data) - width + 1):
            if data[k : k + width] in seen:
                gone[k : k + width] = b"\1" * width
            else:
                seen.add(data[k : k + width])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        marks[(i, t)] = (len(data), sum(gone), spans, kept)
    for i, t in rows:
        out.append((i, *marks[(2**63 - 1 if i is None else i, t)]))
    return sorted(out, key=repr)


def found(spark, rows, width=100):
    result = repeats.remove_repeats(documents(spark, rows), width)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in result.collect()), key=repr)


def test_awkward_rows(spark):
    assert found(spark, AWKWARD) == plain(AWKWARD, 100)


@pytest.mark.parametrize("case", ["passages", "periodic", "small chunks", "hot anchors", "narrow"])
def test_equals_brute_force(spark, monkeypatch, case):
    rng = random.Random(case)
    letters = "ab" if case == "periodic" else "abcdefgé "
    passages = ["".join(rng.choices(letters, k=rng.randint(60, 400))) for _ in range(6)]
    texts = []
    for i in range(30):
        parts = [rng.choice(passages)[rng.randint(0, 30) :] if rng.random() < 0.5 else "".join(rng.choices(letters, k=rng.randint(0, 150))) for _ in range(5)]
        text = "".join(parts)
        if case == "periodic":
            text = "abc" * rng.randint(0, 120) + text
        texts.append((rng.randint(0, 10**6), text))
    if case in ("small chunks", "hot anchors"):
        monkeypatch.setattr(repeats, "CHUNK", 300)
        monkeypatch.setattr(repeats, "SHARD", 500)
    if case == "hot anchors":
        monkeypatch.setattr(repeats, "HOT", 2)
    width = 40 if case == "narrow" else 100
    assert found(spark, texts, width) == plain(texts, width)


def test_empty(spark):
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_suffix_array_and_prefixes_equal_sorting():
    rng = np.random.default_rng(2)
    for trial in range(150):
        n, letters = int(rng.integers(1, 150)), int(rng.integers(1, 5))
        s = rng.integers(1, letters + 1, n)
        if trial % 3 == 0:
            s = np.tile(s[: int(rng.integers(1, 9))], n // 3 + 1)
        s = np.r_[s, 0]
        order = suffix_array(s)
        assert order.tolist() == sorted(range(len(s)), key=lambda k: s[k:].tolist())
        for most in (3, 10, 500):
            common = permuted_common_prefixes(s, order, most)
            for a, b in zip(order, order[1:]):
                x, y = s[a:], s[b:]
                same = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
                assert common[b] == min(same, most)


def test_large_alphabets_are_sorted_too():
    rng = np.random.default_rng(5)
    s = np.r_[np.repeat(rng.integers(1, 5_000, 60), 3), 0]
    assert suffix_array(s).tolist() == sorted(range(len(s)), key=lambda k: s[k:].tolist())


def test_no_task_gets_all_places_of_a_hot_window(spark, monkeypatch):
    """A passage between differing neighbours: its leads stay open, but none of its windows reaches a suffix array."""
    monkeypatch.setattr(repeats, "HOT", 5)
    rng = random.Random(6)

    def fresh(n):
        return "".join(rng.choice("abcdefghij klmnop") for _ in range(n))

    passage = fresh(180)
    texts = [(k, fresh(50) + passage + fresh(50)) for k in range(30)]
    docs = documents(spark, texts)
    rows = docs.select(F.col("doc_id").alias("doc"), F.hash(F.encode("text", "UTF-8")).alias("mark"), F.encode("text", "UTF-8").alias("data"))
    mixed = repeats._sorted_out(repeats.anchors(rows, 100), 100).where("off is not null")
    hot = repeats._hot(mixed)
    assert not hot.isEmpty()
    sizes = [r["count"] for r in repeats._regions(mixed, rows, 100, hot).groupBy("h").count().collect()]
    assert max(sizes, default=0) <= 5
    seen, want = set(), {}
    for doc_id, text in texts:
        gone = set()
        for k in range(len(text) - 99):
            if text[k : k + 100] in seen:
                gone |= set(range(k, k + 100))
            seen.add(text[k : k + 100])
        want[doc_id] = "".join(c for k, c in enumerate(text) if k not in gone)
    assert {r.doc_id: bytes(r.kept).decode() for r in repeats.remove_repeats(docs, 100).collect()} == want
