"""The trie by itself, and groups of equal texts against a dictionary."""

import hashlib
import random

import pytest

from fixtures import AWKWARD, documents, empty
from lodestone.llm.exact_dedup import deduplicate, exact_duplicates
from lodestone.llm.patricia import Trie


def texts(seed, n):
    rng = random.Random(seed)
    return [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_trie_keeps_whole_strings():
    trie, want = Trie(), {}
    for k, text in enumerate(texts(1, 2_000)):
        node = trie.find(text)
        node.held = min(k, k if node.held is None else node.held)
        want.setdefault(text, k)
    assert dict(trie.items()) == want


def test_what_is_spilled_is_turned_away_and_nothing_is_lost():
    trie, out, turned = Trie(), {}, []
    for k, text in enumerate(texts(2, 2_000)):
        node = trie.find(text)
        if node is None:
            turned.append(text)
        else:
            node.held = k if node.held is None else node.held
        if k % 50 == 49:
            given = trie.spill()
            assert (given or len(dict(trie.items())) == 1) and not set(dict(given)) & set(out)
            out |= dict(given)
            assert all(trie.find(t) is None for t, _ in given)
    held = dict(trie.items())
    assert held and not set(held) & set(out)
    assert set(held) | set(out) | set(turned) == set(texts(2, 2_000))


def test_one_string_is_never_spilled():
    trie = Trie()
    trie.find(b"alone").held = 1
    assert trie.spill() == [] and trie.find(b"alone").held == 1


def expected(rows, keep):
    pick = max if keep == "largest" else min
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        best = pick((i for i in ids if i is not None), default=None)
        out += [(i, best, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return out, len(groups)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("limits", [{}, {"near": 1_500, "full": 2_000, "share": 3_000}])
def test_equals_a_dictionary(spark, keep, limits):
    rng = random.Random(5)
    rows = [(k, "".join(rng.choice("aBé ") for _ in range(rng.randint(0, 4)))) for k in range(600)]
    rows += [(k, "The hot text") for k in range(600, 900)] + [(None, "the HOT text"), (None, None), (None, None)] + AWKWARD
    found = exact_duplicates(documents(spark, rows).repartition(5), keep=keep, columns=["doc_id"], **limits).collect()
    want, groups = expected(rows, keep)
    order = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found], key=order) == sorted(want, key=order)
    kept = [r for r in found if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_awkward_rows_and_clashing_names(spark):
    docs = documents(spark)
    stays = deduplicate(docs)
    assert stays.columns == docs.columns and stays.count() == len(expected(AWKWARD, "smallest")[0]) - 3
    named = spark.createDataFrame([(1, "a", "x", "b", 2), (2, "A", "y", "c", 3)], "doc_id long, text string, KEPT string, box string, slot int")
    found = exact_duplicates(named, keep="largest")
    assert found.columns == ["doc_id", "text", "box", "slot", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((r.doc_id, r.box, r.slot, r.keep_id, r.kept) for r in found.collect()) == [(1, "b", 2, 2, False), (2, "c", 3, 2, True)]
    assert exact_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        exact_duplicates(docs, keep="first")
