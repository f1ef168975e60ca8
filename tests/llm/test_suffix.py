import random

import numpy as np
import pytest
from brute import covered, suffix_row

from textloom.llm import suffix_dedup as S

LENGTH = 48


def _texts(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(rnd.randint(12, 40)) for _ in range(4)]
    texts = [None, "", "short", "x" * 47, "y" * 48, "z" * 49, "ab" * 60, shared[0], shared[0]]
    for _ in range(60):
        parts = [prose(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            cut = rnd.randint(0, 20)
            parts += [s[cut:], prose(rnd.randint(0, 10))]
        texts.append("".join(parts))
    texts += [texts[20], texts[21] + "!", "?" + texts[22]]
    return texts


def _check(spark, texts, **kw):
    rows = [(i, t, "extra") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bytes string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept_bytes))
           for r in S.suffix_dedup(df, length=LENGTH, **kw).collect()}
    want = {i: suffix_row(t, gone) for i, (t, gone) in enumerate(zip(texts, covered(texts, LENGTH), strict=True))}
    assert got == want


def test_against_brute_force(spark):
    _check(spark, _texts(1))


def test_every_token_across_buckets(spark):
    # with no run allowed in the bucket sort, all suffixes take the path that compares across buckets
    _check(spark, _texts(2), hot_runs=0)


def test_long_documents_are_cut_into_pieces(spark, monkeypatch):
    texts = _texts(3)
    monkeypatch.setattr(S, "PIECE", 64)
    data = [np.frombuffer((t or "").encode(), dtype=np.uint8) for t in texts]
    for d in data:
        starts = [(f, n) for piece in S.runs_of(d, LENGTH) for f, n in zip(piece[0], piece[1], strict=True)]
        assert [x for f, n in starts for x in range(f, f + n)] == list(range(max(0, len(d) - LENGTH + 1)))


def test_repeated_rows_null_ids_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(None, long), (7, long + " end"), (8, "other"), (8, "other")], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_removed) for r in S.suffix_dedup(df, length=LENGTH).collect())
    assert got == [(-1, len(long)), (7, len(long)), (8, 0), (8, 0)]
    same = spark.createDataFrame([(1, long), (1, long)], "doc_id long, text string")
    assert [r.n_removed for r in S.suffix_dedup(same, length=LENGTH).collect()] == [len(long)] * 2
    assert S.suffix_dedup(df.limit(0), length=LENGTH).collect() == []
    with pytest.raises(ValueError):
        S.suffix_dedup(df, length=20)


def test_multikey_quicksort_finds_equal_suffixes():
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 99, 3000).astype(np.uint8)
    buf[2000:2200] = buf[100:300]
    starts = np.arange(3000 - 50)
    got = sorted(S.repeated_suffixes(buf, starts, np.zeros(len(starts), dtype=int), 50).tolist())
    seen = {}
    for s in starts.tolist():
        seen.setdefault(buf[s:s + 50].tobytes(), []).append(s)
    assert got == sorted(s for v in seen.values() if len(v) > 1 for s in v)


def test_whole_operator_on_a_text_of_several_pieces(spark):
    """A passage that lies across the border of two pieces, and one in another document."""
    rnd = random.Random(9)
    prose = lambda n: "".join(rnd.choice("abcdefghijklmnop ") for _ in range(n))
    passage = prose(300)
    long = prose(S.PIECE - 150) + passage + prose(S.PIECE)
    df = spark.createDataFrame([(1, long), (2, "x" + passage + "y"), (3, prose(500))], "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in S.suffix_dedup(df, length=LENGTH).collect()}
    # a byte next to the passage may be equal in both by chance
    (s, e), = got[1]
    assert s <= S.PIECE - 150 and e >= S.PIECE + 150 and e - s <= 306
    (s, e), = got[2]
    assert s <= 1 and e >= 301 and got[3] == []


def test_structured_texts_do_not_collide():
    """Two halves of a Thue-Morse text are equal modulo 2**64, not modulo the primes."""
    bits = [bin(i).count("1") & 1 for i in range(2048)]
    data = np.array([[97 + b for b in bits], [98 - b for b in bits]], dtype=np.uint8)
    plain, prime = ([h(d).at(np.array([0]), np.array([2048]))[0] for d in data] for h in (
        lambda d: S.RollingHash(d, 1), S.PrimeHash))
    assert plain[0] == plain[1] and prime[0] != prime[1]


def test_prime_hash_of_equal_substrings():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 4000).astype(np.uint8)
    data[3000:3500] = data[10:510]
    h = S.PrimeHash(data)
    at = np.array([10, 11, 60, 10])
    assert (h.at(at, at + 100) == h.at(at + 2990, at + 3090)).all()
    assert h.at(np.array([10]), np.array([110]))[0] != h.at(np.array([11]), np.array([111]))[0]
    value = lambda a, b, p, base: sum((int(x) + 1) * pow(base, i, p) for i, x in enumerate(data[a:b])) % p
    got = int(h.at(np.array([7]), np.array([57]))[0])
    assert (got >> 31, got & (1 << 31) - 1) == tuple(value(7, 57, p, b) for p, b in zip(S._PRIMES, S._PRIME_BASES, strict=True))
