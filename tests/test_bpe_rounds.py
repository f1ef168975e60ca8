"""Merge learning in rounds: the same merges whatever is merged per round, and to the end."""
import random

import pytest

from test_bpe import as_strings, reference_bpe
from textloom.operators import bpe as B


def _texts(seed):
    rnd = random.Random(seed)
    syll = ["ba", "na", "aa", "thơ", "xi", "lo", "zzz", "é"]
    words = ["".join(rnd.choice(syll) for _ in range(rnd.randint(1, 5))) for _ in range(120)]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(3, 20))) for _ in range(60)]


@pytest.mark.parametrize("segments,limit", [(60, 40), (100_000, 50_000)])
def test_rounds_give_the_sequential_merges(spark, segments, limit):
    texts = _texts(segments)
    _, want = reference_bpe(texts, 50_000)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    counts = B.pretoken_counts(df)
    got = as_strings(B.learn_merges(counts, limit, segments=segments).collect())
    assert got == want[:limit] and len(got) > 20


def test_query_learns_past_twenty_merges(spark, tmp_path):
    from textloom.plans import QUERIES
    texts = _texts(5)
    (spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
     .write.parquet(f"{tmp_path}/documents.parquet"))
    got = as_strings(QUERIES["bpe_merges"](spark, str(tmp_path)).collect())
    assert got == reference_bpe(texts, 50_000)[1] and len(got) > 20


def _tied(n, seed):
    """Words of equal count: every pair of a count level ties."""
    rnd = random.Random(seed)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 7))) for _ in range(n)}
    return [" ".join(sorted(words))] * 3 + ["aaaa aaaaaaa bbbb abab ababab"] * 3


@pytest.mark.parametrize("segments,hot_pairs", [(12, 9), (40, 1), (100, 64)])
def test_tied_pairs_beyond_the_drivers_room(spark, segments, hot_pairs):
    """More tied pairs than the driver may hold: parts of the level, in order."""
    texts = _tied(60, segments)
    _, want = reference_bpe(texts, 40)
    counts = B.pretoken_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert B.pair_counts(B.byte_words(counts)).groupBy("cnt").count().agg({"count": "max"}).first()[0] > segments
    got = as_strings(B.learn_merges(counts, 12 if hot_pairs == 1 else 40, segments=segments, hot_pairs=hot_pairs).collect())
    assert got == want[:12 if hot_pairs == 1 else 40]


def test_driver_holds_no_more_than_segments(spark, monkeypatch):
    texts = _tied(60, 1)
    counts = B.pretoken_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    sizes = []
    collect = type(counts).collect
    monkeypatch.setattr(type(counts), "collect", lambda self: (lambda rows: sizes.append(len(rows)) or rows)(collect(self)))
    B.learn_merges(counts, 12, segments=12, hot_pairs=9)
    assert sizes and max(sizes) <= 13  # one more tells that there are more


def test_delta_counts_equal_the_recount(spark):
    import numpy as np
    texts = _texts(3)
    counts = B.pretoken_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    words = B.byte_words(counts)
    pairs = B.pair_counts(words)
    rows = lambda df: sorted(map(tuple, df.select("left", "right", "cnt").collect()))
    for new, (left, right, _) in enumerate(rows(pairs)[:6], 257):
        moved = words.select("symbols", "n").mapInArrow(B._merge_one(left, right, new), "symbols array<int>, n long, old array<int>")
        pairs = B.update_pair_counts(pairs, B.pair_delta(moved.filter("old is not null")))
        words = moved.select("symbols", "n")
        assert rows(pairs) == rows(B.pair_counts(words))
    flat = [s for r in words.collect() for s in r.symbols]
    assert np.isin([257, 258], flat).any()


def test_lengths_are_those_of_the_ids(spark):
    texts = _texts(7) + ["", None, "x" * 200, f"a{B.SPECIAL}b", "  two  spaces "]
    df = spark.createDataFrame([(i, i % 3, t) for i, t in enumerate(texts)], "doc_id long, part int, text string")
    merges = B.learn_merges(B.pretoken_counts(df), 60)
    want = {r.doc_id: len(r.ids) for r in B.encode(df, merges, ["doc_id"]).collect()}
    assert {r.doc_id: r.tokens for r in B.token_lengths(df, merges, ["doc_id"]).collect()} == want
    got = {r.part: r.tokens for r in B.token_counts(df, merges, ["part"], count_eos=True).collect()}
    assert got == {p: sum(n + 1 for i, n in want.items() if i % 3 == p) for p in range(3)}
    plan = B.token_counts(df, merges, ["part"])._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and plan.count("Aggregate") == 1  # no word is grouped or shuffled


def test_scan_and_heap_agree():
    rnd = random.Random(1)
    rows = [(0, 1, 2, 257), (1, 257, 1, 258), (2, 2, 2, 259), (3, 259, 1, 260), (4, 1, 1, 261)]
    enc = B.WordEncoder(rows)
    for _ in range(300):
        ids = [rnd.choice([1, 2, 3]) for _ in range(rnd.randint(1, 30))]
        assert enc.scan(list(ids)) == enc.heap(list(ids))


def test_words_merged_together_agree_with_one_by_one():
    """Words of all widths, many at a time: the ids that each has by itself; long words and
    the special token too, and no merges at all."""
    import numpy as np
    rnd = random.Random(3)
    a, b, c = (B.BYTE_IDS[ord(x)] for x in "abc")
    rows = [(0, a, b, 257), (1, 257, a, 258), (2, b, b, 259), (3, 259, a, 260), (4, a, a, 261), (5, 261, 261, 262), (6, 258, c, 263)]
    words = list(dict.fromkeys("".join(rnd.choice("abcé") for _ in range(rnd.randint(0, 60))) for _ in range(2000)))
    words += [B.SPECIAL, "a" * B.SHORT, "a" * (B.SHORT + 1)]
    for merges in (rows, []):
        enc = B.WordEncoder(merges)
        want = [[0] if w == B.SPECIAL else enc.heap([B.BYTE_IDS[x] for x in w.encode()]) for w in words]
        found = {}
        for at, flat, size in enc.encode_all(words):
            ends = np.cumsum(size)
            found.update((i, flat[e - n:e].tolist()) for i, e, n in zip(at.tolist(), ends.tolist(), size.tolist(), strict=True))
        assert [found[i] for i in range(len(words))] == want
        assert enc.sizes(words).tolist() == list(map(len, want)) and [enc(w) for w in words] == want


def test_packed_words_carry_their_pair_counts(spark):
    """Words packed four bytes a symbol: the same symbols as ``byte_words``, and beside them the
    pair counts, first in full and then what a rewrite changes."""
    texts = [*_texts(4), f"a{B.SPECIAL}b", "", "x", "é"]
    counts = B.pretoken_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    words = B.byte_words(counts)
    rows = lambda df: sorted(map(tuple, df.select("left", "right", "cnt").collect()))
    start = counts.filter("word != '<|endoftext|>' and octet_length(word) > 1").select("word", "n")
    packed = start.mapInArrow(B._pack_words, B._PACKED)
    plain = sorted((list(r.symbols), r.n) for r in words.collect())

    def unpacked(df):
        return sorted((list(memoryview(r.symbols).cast("i")), r.n) for r in df.filter("symbols is not null").collect())

    assert unpacked(packed) == plain
    pairs = B.update_pair_counts(spark.createDataFrame([], "left int, right int, cnt long"), B._packed_delta(packed))
    assert rows(pairs) == rows(B.pair_counts(words))
    left, right, _ = max(rows(pairs), key=lambda r: r[2])
    one = B._merge_one(left, right, 257)
    moved = packed.filter("symbols is not null").select("symbols", "n").mapInArrow(B._packed(one), B._PACKED)
    want = words.mapInArrow(one, "symbols array<int>, n long, old array<int>")
    assert unpacked(moved) == sorted((list(r.symbols), r.n) for r in want.collect())
    assert rows(B.update_pair_counts(pairs, B._packed_delta(moved))) == rows(B.pair_counts(want))
