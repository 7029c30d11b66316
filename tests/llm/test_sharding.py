import random
import zlib

import numpy as np
import pytest
from fixtures import AWKWARD, documents, empty

from lodestone.llm import sharding


@pytest.mark.parametrize("ways", [1, 2, 3, 7])
def test_differencing_beats_greedy_and_places_every_item(ways):
    rng = random.Random(ways)
    sizes = np.array([rng.randint(1, 10**6) for _ in range(400)])
    parts = sharding.difference(sizes, ways)
    sums = np.bincount(parts, weights=sizes, minlength=ways)
    greedy = np.zeros(ways)
    for size in sorted(sizes.tolist(), reverse=True):
        greedy[greedy.argmin()] += size
    assert len(sums) == ways and sums.sum() == sizes.sum()
    assert np.ptp(sums) <= max(np.ptp(greedy), 1)


def test_known_two_way_example():
    # 8 7 6 5 4 leaves a difference of 2 by differencing.
    parts = sharding.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert abs(sum(s if p else -s for s, p in zip([8, 7, 6, 5, 4], parts))) == 2


def plain_differencing(sizes, ways):
    """Karmarkar-Karp on lists of (sum, items): largest spread first, ties to the earlier partition."""
    parts = [(k, [(0, ())] * (ways - 1) + [(size, (k,))]) for k, size in enumerate(sizes)]
    fresh = len(sizes)
    while len(parts) > 1:
        parts.sort(key=lambda p: (-(p[1][-1][0] - p[1][0][0]), p[0]))
        (_, one), (_, two), *parts = parts
        joined = [(a + b, x + y) for (a, x), (b, y) in zip(one, reversed(two))]
        parts.append((fresh, sorted(joined, key=lambda part: part[0])))
        fresh += 1
    return [total for total, _ in parts[0][1]]


@pytest.mark.parametrize("ways", [2, 3, 5])
def test_differencing_equals_a_plain_one(ways):
    rng = random.Random(ways)
    for n in (1, 4, 20, 120):
        sizes = [rng.randint(1, 10**4) for _ in range(n)]
        parts = sharding.difference(np.array(sizes), ways)
        assert sorted(np.bincount(parts, weights=sizes, minlength=ways).astype(int).tolist()) == plain_differencing(sizes, ways)


def test_few_items_and_none():
    assert sharding.difference(np.zeros(0, np.int64), 4).tolist() == []
    assert len(set(sharding.difference(np.array([5, 5, 5]), 4).tolist())) == 3


def check(rows, texts, shards):
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in texts)
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in rows)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    homes = {}
    for r in rows:
        homes.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_awkward_rows(spark):
    check(sharding.assign_shards(documents(spark), 3).collect(), AWKWARD, 3)


def test_balance_with_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 10)
    rng = random.Random(1)
    texts = [(i, "x" * rng.randint(0, 300)) for i in range(600)] + [(1000 + i, "copy" * 40) for i in range(100)]
    rows = sharding.assign_shards(documents(spark, texts), 4).collect()
    check(rows, texts, 4)
    sums = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(sums) - min(sums) < 0.02 * sum(sums)


def test_empty(spark):
    assert sharding.assign_shards(empty(spark)).count() == 0
