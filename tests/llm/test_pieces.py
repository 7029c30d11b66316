import random

import pyarrow as pa
import pytest
from fixtures import AWKWARD, documents, empty

from lodestone.llm import pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def words():
    return pieces.load(MODEL)


def all_ways(chunk, words):
    if not chunk:
        return [(0.0, ())]
    out, below, covered = [], words.trie, False
    for end, c in enumerate(chunk, 1):
        if c not in below:
            break
        below, piece = below[c]
        if piece:
            number, score = piece
            covered = covered or end == 1
            out += [(score + s, (number, *ids)) for s, ids in all_ways(chunk[end:], words)]
    if not covered:
        spelled = tuple(words.bytes_at[b] for b in chunk[0].encode())
        out += [(words.penalty + s, spelled + ids) for s, ids in all_ways(chunk[1:], words)]
    return out


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_n_best_equal_all_segmentations(words, n):
    rng = random.Random(n)
    for _ in range(60):
        chunk = "".join(rng.choice("▁thae inoné漢") for _ in range(rng.randint(1, 8)))
        found = pieces.segmentations(chunk, words, n)
        every = all_ways(chunk, words)
        assert [s for s, _ in found] == sorted((s for s, _ in every), reverse=True)[:n]
        assert len(set(found)) == len(found) and set(found) <= set(every)


@pytest.mark.parametrize("n", [1, 4])
def test_whole_texts_equal_one_lattice(words, n):
    """Cutting into chunks and keeping segmentations changes no score."""
    rng = random.Random(n)
    encoder = pieces.Encoder(words, n)
    for _ in range(150):
        text = "".join(rng.choice("thae. ,in(oné漢\n'") for _ in range(rng.randint(1, 9)))
        one = pieces.segmentations("▁" + text.replace(" ", "▁"), words, n)
        assert [s for s, _ in encoder.n_best(text)] == [s for s, _ in one]


@pytest.mark.parametrize("text", [t for _, t in AWKWARD if t is not None] + [" ", "  a ", "▁", "▁ ▁x", "a\n\tb\r\n", "<s> </s>", "\x00", "🙂é"])
def test_exact_round_trip(words, text):
    for _, ids in pieces.Encoder(words, 3).n_best(text[:3_000]):
        assert pieces.decode(ids, words) == text[:3_000]


def test_full_cache_changes_nothing(words, monkeypatch):
    text = "this is a text, and that is a test. " * 4
    whole = pieces.Encoder(words, 2).n_best(text)
    monkeypatch.setattr(pieces, "CACHED", 2)
    assert pieces.Encoder(words, 2).n_best(text) == whole


def test_table_of_awkward_rows(spark, words):
    coded = pieces.encode(documents(spark), MODEL, 2)
    assert coded.columns[: len(documents(spark).columns)] == documents(spark).columns
    rows = coded.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        if r.text is None:
            assert r.piece_ids is None and r.decodes is None and r.piece_score is None
            continue
        best = pieces.Encoder(words, 2).n_best(r.text)
        assert (r.piece_ids, r.decodes, r.piece_score) == (best[0][1], True, best[0][0])
        assert r.next_score == (best[1][0] if len(best) > 1 else None)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_encode_gives_the_n_best(spark, words, n):
    rows = pieces.encode(documents(spark), MODEL, n).collect()
    for r in rows:
        if r.text is None:
            assert r.next_best is None
            continue
        lattice = pieces.segmentations("▁" + r.text.replace("▁", "").replace(" ", "▁"), words, n) if 0 < len(r.text) < 100 else []
        found = [(r.piece_score, r.piece_ids), *((x.score, x.ids) for x in r.next_best)]
        assert found == pieces.Encoder(words, n).n_best(r.text)
        assert len({tuple(ids) for _, ids in found}) == len(found) and (len(found) == n or not r.text.strip())
        assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
        assert all(pieces.decode(ids, words) == r.text for _, ids in found)
        if lattice and "▁" not in r.text:
            assert [s for s, _ in found] == pytest.approx([s for s, _ in lattice])


def test_empty(spark):
    assert pieces.encode(empty(spark), MODEL).count() == 0


def test_first_path_is_the_first_ranked_one():
    """Ties, characters without a piece, and scores whose sums depend on their order."""
    random.seed(11)
    for exact in (True, False):
        scores = {a: -random.randint(1, 9) / (1 if exact else 7) for a in {"".join(random.choices("abc", k=random.randint(1, 4))) for _ in range(25)} - {"b"}}
        found = {piece: (k, float(score)) for k, (piece, score) in enumerate(scores.items())}
        reverse = {piece[::-1]: x for piece, x in found.items()}
        words = pieces.Vocabulary(pieces._trie(found), pieces._trie(reverse), list(range(100, 356)), [], frozenset(), -19.0, "")
        for _ in range(500):
            chunk = "".join(random.choices("abcd", k=random.randint(1, 9)))
            score, ids, following = pieces.first_path(chunk, words)
            ranked = next(pieces.ranked_paths(chunk, words))
            assert (score, ids) == ranked[:2] and following == pytest.approx(ranked[2], abs=1e-9) if ranked[2] is not None else following is None


def test_no_more_than_a_slice_of_a_batch_is_made_at_once(spark, words):
    n = 2 * pieces.AT_ONCE + 3
    texts = [f"text number {k}" if k % 7 else None for k in range(n)]
    slices = list(pieces._in_slices(pieces.Encoder(words, 2), iter([pa.array(texts), pa.array([], pa.string())])))
    assert [len(x) for x in slices] == [pieces.AT_ONCE, pieces.AT_ONCE, 3, 0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = pieces.encode(docs, MODEL, n=2).orderBy("doc_id").collect()
    assert [r.piece_ids and pieces.decode(r.piece_ids, words) for r in rows] == texts


def test_chunks_on_arrays_have_their_first_paths(words):
    rng = random.Random(5)
    scores = {a: -rng.randint(1, 9) / 7 for a in {"".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(25)} - {"b"}}
    small = {piece: (k, score) for k, (piece, score) in enumerate(scores.items())}
    tries = [(pieces._trie(small), -19.0, "abcd"), (words.trie, words.penalty, "▁thae inoné漢\ud800")]
    for trie, penalty, letters in tries:
        behind = pieces._trie({p[::-1]: x for p, x in small.items()}) if letters == "abcd" else words.behind
        own = words._replace(trie=trie, behind=behind, penalty=penalty)
        chunks = ["".join(rng.choices(letters, k=rng.randint(1, 20))) for _ in range(2_000)]
        found = pieces.PieceTable(trie, penalty).first_paths(chunks)
        assert sum(x is not None for x in found) > 100
        for chunk, got in zip(chunks, found):
            score, ids, following = pieces.first_path(chunk, own)
            assert got is None or got == (score, pieces.array("i", ids).tobytes(), -pieces.math.inf if following is None else following)


def test_texts_together_equal_texts_alone(words, monkeypatch):
    """Only long chunks and characters without a piece are searched alone, whatever a task keeps."""
    rng = random.Random(6)
    texts = [None, "", *("".join(rng.choice("thae. ,in(oné\n▁") for _ in range(rng.randint(1, 60))) for _ in range(200)), "x" * 5_000]
    alone = [None if t is None else pieces.Encoder(words, 3).n_best(t) for t in texts]
    single, first = [], pieces.first_path
    monkeypatch.setattr(pieces, "first_path", lambda chunk, own: single.append(chunk) or first(chunk, own))
    for kept, characters in ((100_000, 1_000_000), (5, 100)):
        monkeypatch.setattr(pieces, "CACHED", kept)
        monkeypatch.setattr(pieces, "CHARACTERS", characters)
        rows = pieces._segmented(pieces.Encoder(words, 3), pa.array(texts)).to_pylist()
        found = [r["ids"] if r["ids"] is None else [(r["score"], r["ids"]), *((x["score"], x["ids"]) for x in r["others"])] for r in rows]
        assert found == alone and all(r["same"] in (True, None) for r in rows)
    assert all(len(chunk) > pieces.LONGEST_CACHED or chunk == "\n" for chunk in single)


def test_what_arrow_frees_goes_back_with_every_slice(words, monkeypatch):
    released = []
    pool = type("Pool", (), {"release_unused": lambda self: released.append(1)})()
    encoder = pieces.Encoder(words, 2)
    monkeypatch.setattr(pieces.pa, "default_memory_pool", lambda: pool)
    monkeypatch.setattr(pieces, "AT_ONCE", 4)
    out = list(pieces._in_slices(encoder, iter([pa.array(["a b"] * 9)])))
    assert [len(x) for x in out] == [4, 4, 1] and len(released) == 3
