import re

import numpy as np
import pytest
import xxhash

from fixtures import AWKWARD, documents, empty
from lodestone.llm import simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text, words=4):
    tokens = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not tokens:
        return 0
    shingles = [" ".join(tokens[k : k + words]) for k in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, radius):
    names = list(range(len(values)))

    def root(k):
        while names[k] != k:
            k = names[k]
        return k

    for a in range(len(values)):
        for b in range(a):
            if bin(int(values[a]) ^ int(values[b])).count("1") <= radius:
                x, y = root(a), root(b)
                names[max(x, y)] = min(x, y)
    return [root(k) for k in range(len(values))]


@pytest.mark.parametrize("text", ["", "a", "A b", "a b c d e", "Ab\tcd\nef gh ij Äk", "x " * 200, "Hello, World! it is " * 3])
def test_fingerprint_equals_plain(text):
    assert simhash.fingerprint(text, 4) == plain(text)


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(f"w{k * k % 97}" for k in range(500))
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert simhash.fingerprint(text, 4) == plain(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
@pytest.mark.parametrize("size", [1, 2, 20, 70, 300])
def test_links_within_equal_brute_force(radius, size):
    rng = np.random.default_rng(size * 10 + radius)
    base = rng.integers(0, 2**63, 6, dtype=np.uint64)
    values = base[rng.integers(0, 6, size)]
    for _ in range(3):
        values = values ^ (np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64))
    a, b = simhash.links_within(np.zeros(size, np.int64), values, radius)
    roots = np.arange(size)
    simhash.merge(roots, a, b)
    assert roots.tolist() == groups(values, radius)
    assert len(a) == size - len(set(roots.tolist()))


def test_lanes_are_counted_exactly():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 130, dtype=np.uint64) & rng.integers(0, 2**63, 130, dtype=np.uint64)
    planes = simhash.bit_planes(values)
    for radius in (0, 5, 11, 16, 31):
        near = simhash._unpacked(simhash.lanes_within(iter(planes), radius, planes[0].shape), 130)
        assert near.tolist() == [bin(int(v)).count("1") <= radius for v in values]


def test_components_of_awkward_rows(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    assert len(found) == len(AWKWARD)
    values = [plain(t) for _, t in AWKWARD]
    roots = groups(values, 4)
    least = {r: min((i for (i, _), x in zip(AWKWARD, roots) if x == r and i is not None), default=None) for r in roots}
    want = sorted((str(i), v, str(least[r])) for (i, _), v, r in zip(AWKWARD, values, roots))
    assert sorted((str(r.doc_id), r.fp & (2**64 - 1), str(r.component_id)) for r in found) == want


def test_large_buckets_are_dealt_into_pieces(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 16)
    rng = np.random.default_rng(8)
    base = int(rng.integers(0, 2**62))
    values = sorted({base ^ (1 << int(x)) ^ (1 << int(y)) for x, y in rng.integers(0, 60, (150, 2))})
    marks = spark.createDataFrame([(v,) for v in values], "fp long")
    pairs = simhash.near_links(marks, 2, 4).collect()
    roots, at = np.arange(len(values)), {v: k for k, v in enumerate(values)}
    simhash.merge(roots, np.array([at[p.u] for p in pairs]), np.array([at[p.v] for p in pairs]))
    assert roots.tolist() == groups(values, 2)


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    kept = simhash.keep_one(documents(spark))
    assert kept.columns == documents(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(9) == 1 and ids.count(None) == 1
    assert 2 in ids and 5 not in ids  # equal texts
    assert sum(i in ids for i in (3, 4, 7)) == 1  # no words


def test_kept_rows_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    texts = []
    for size in (3, 60, 200, 500):
        for _ in range(5):
            base = [f"w{x}" for x in rng.integers(0, 5_000, size)]
            texts.append(" ".join(base))
            for _ in range(4):
                copy = list(base)
                copy[rng.integers(0, size)] = f"x{rng.integers(0, 10**9)}"
                texts.append(" ".join(copy))
    rows = [(int(k), texts[at]) for k, at in enumerate(rng.permutation(len(texts)))]
    roots = groups([simhash.fingerprint(t, 4) for _, t in rows], 4)
    kept = simhash.keep_one(documents(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(roots))
    assert len(set(roots)) < len(rows) - 10


def test_repeated_ids_with_other_texts_all_stay(spark):
    one, two, three = (" ".join(f"{p}{k}" for k in range(80)) for p in "abc")
    rows = [(1, one), (1, two), (1, two), (None, three), (None, three), (None, one), (2, two)]
    kept = simhash.keep_one(documents(spark, rows))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, one), (1, two), (None, three)], key=repr)


def test_of_rows_that_differ_elsewhere_the_same_one_stays(spark):
    table = spark.createDataFrame([(1, "a b c d e", k, {"m": k}) for k in range(20)], "doc_id long, text string, row int, m1 map<string,int>")
    kept = [simhash.keep_one(table.repartition(n)).collect() for n in (1, 7)]
    assert len(kept[0]) == 1 and kept[0] == kept[1]
