"""BPE parity with the `tokenizers` library (used here as a test oracle only)."""
import json
import random

import pytest

from textloom.operators import bpe as B

tokenizers = pytest.importorskip("tokenizers")


def reference_bpe(texts, n_merges):
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.decoder = decoders.ByteLevel()
    tr = trainers.BpeTrainer(vocab_size=257 + n_merges, min_frequency=2, special_tokens=[B.SPECIAL],
                             initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), show_progress=False)
    tok.train_from_iterator(texts, tr)
    merges = [tuple(m) for m in json.loads(tok.to_str())["model"]["merges"]]
    return tok, merges


def as_strings(merges_rows):
    chars = B.byte_chars()
    sym = {i: chars[b] for b, i in enumerate(B.BYTE_IDS)}
    out = []
    for r in sorted(merges_rows, key=lambda r: r["rank"]):
        sym[r["id"]] = sym[r["left"]] + sym[r["right"]]
        out.append((sym[r["left"]], sym[r["right"]]))
    return out


def corpora():
    rnd = random.Random(3)
    words = ["hello", "world", "the", "cat", "aaa", "Việt", "Nam", "thơ", "x1", "42", "!!", "  "]
    out = [["hello hello world", "the cat sat on the mat", "aaa aaa aaa"]]
    for _ in range(2):
        out.append([" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12))) for _ in range(30)])
    return out


@pytest.mark.parametrize("k", [0, 1, 2])
def test_merges_and_encoding_match(spark, k):
    texts = corpora()[k]
    n = 15
    tok, ref_merges = reference_bpe(texts, n)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    merges = B.learn_merges(B.pretoken_counts(df), n)
    assert as_strings(merges.collect()) == ref_merges
    probe = texts[:5] + [f"a{B.SPECIAL}b", "Việt Nam  thơ\n"]
    pdf = spark.createDataFrame([(i, t) for i, t in enumerate(probe)], "doc_id long, text string")
    got = {r.doc_id: list(r.ids) for r in B.encode(pdf, merges, ["doc_id"]).collect()}
    want = {i: tok.encode(t).ids for i, t in enumerate(probe)}
    assert got == want
    rt = B.roundtrip_errors(pdf, merges, ["doc_id"]).collect()[0]
    assert rt.errors == 0


def test_lists_of_words_and_ids(spark):
    """Documents are put together from their different words and ids: empty and null lists,
    unknown ids and broken UTF-8 included."""
    import pyarrow as pa
    merges = spark.createDataFrame([(0, B.BYTE_IDS[97], B.BYTE_IDS[98], 257), (1, 257, B.BYTE_IDS[99], 258)],
                                   "rank int, left int, right int, id int")
    enc = B.WordEncoder([tuple(r) for r in merges.collect()])
    words = [["abc", " ab", "abc"], [], None, [B.SPECIAL, "é"], ["c"] * 3]
    column = pa.array([["dropped"], *words], pa.list_(pa.string())).slice(1)
    assert enc.lists(column).to_pylist() == [[i for w in x or () for i in enc(w)] for x in words]
    assert enc.lists(pa.array([[], None], pa.list_(pa.string()))).to_pylist() == [[], []]
    half = B.BYTE_IDS[0xC3]
    ids = [[258, 257], [], None, [half, 258], [half], [B.BYTE_IDS[0xA9]], [999, -3, None, 0, 258], [half, B.BYTE_IDS[0xA9]]]
    for kind, rows in (("int", ids), ("long", ids), ("int", [None, []])):
        df = spark.createDataFrame(list(enumerate(rows)), f"k long, ids array<{kind}>").coalesce(1)
        for skip in (False, True):
            piece = {r.id: b"" if skip and not r.id else bytes.fromhex(r.hex) for r in B.vocab(spark, merges).collect()}
            got = B.decode(df, B.vocab(spark, merges), "ids", ["k"], skip).collect()
            assert dict(map(tuple, got)) == {k: b"".join(piece.get(i, b"") for i in x or ()).decode("utf-8", "replace")
                                             for k, x in enumerate(rows)}
