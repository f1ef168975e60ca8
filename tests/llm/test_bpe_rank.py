import random
from itertools import chain

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from textloom.llm import rank_bpe, tokens
from textloom.llm.tokens import ChunkEncoder, library_encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
CASES = ["a.\nB, c.\n\nd. e\n f.", "x.\ny.\nz,", "½. ²., a.. b., 3,4, .", "a\n.b \n, c.\n", "one.\n", "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "Hello, world! It's fine.",
         "tab\tsep \t x", "naïve café — ünïcode 漢字 🙂 é", "a<|endoftext|>b <|endoftext|>", "1234 56 %%% &&& ...",
         "x" * 700, "ab" * 400, " nb sp   em", "\x1cfile\x1d sep", "end \n", "\n start", " 'll don't",
         "İ ẞ é", "a \u0085 b", "words " * 300, "漢" * 300]


def _texts():
    rnd = random.Random(5)
    alphabet = "ab é'\n\t 漢🙂1%.  "
    return CASES + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 80))) for _ in range(300)]


def test_rank_array_and_library_cache_equal_the_library(spark):
    tok = Tokenizer.from_file(PATH)
    bpe, lib = rank_bpe.load(PATH), library_encoder(PATH)
    for t in _texts():
        want = tok.encode(t, add_special_tokens=False).ids
        assert bpe.encode(t).tolist() == want, repr(t)
        assert lib.ids(t).tolist() == want, repr(t)
        assert bpe.decode(bpe.encode(t)) == tok.decode(want, skip_special_tokens=False) == t


def test_scan_and_heap_agree():
    bpe, rnd = rank_bpe.load(PATH), random.Random(1)
    for _ in range(200):
        w = "".join(rnd.choice("abcdethino ") for _ in range(rnd.randint(1, 60))).encode()
        assert bpe.word(w) == bpe._long_word(w)


def test_frames(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "a b", "y"), (2, "a b", "z"), (2, "a b", "z")],
                               "doc_id long, text string, ids string")
    out = rank_bpe.encode_decode(df, PATH)
    got = sorted((r.doc_id or 0, list(r.ids), r.decoded) for r in out.collect())
    ab = rank_bpe.load(PATH).encode("a b").tolist()
    assert got == [(0, ab, "a b"), (1, [], ""), (2, ab, "a b"), (2, ab, "a b")]
    again = rank_bpe.decode_ids(out.drop("decoded"), PATH).collect()
    assert sorted(r.decoded for r in again) == ["", "a b", "a b", "a b"]
    assert rank_bpe.encode_decode(df.limit(0), PATH).collect() == []


def test_invalid_bytes_are_replaced():
    bpe = rank_bpe.load(PATH)
    half = bpe.encode("漢")[:1]
    assert bpe.decode(half) == Tokenizer.from_file(PATH).decode(half.tolist(), skip_special_tokens=False)


def test_batches_equal_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 40)  # the cache is cut between batches
    tok, rnd = Tokenizer.from_file(PATH), random.Random(8)
    enc, bpe = library_encoder.__wrapped__(PATH), rank_bpe.load(PATH)
    long = "y" * 70
    texts = _texts() + [f"a {long}. {long} {long}.", f"b {long}", "end.\"''s it.'s x') y!?'t", "one two.\n\nthree  four. ",
                        "Æon ɓy Ǎx, ɓy.", "a \u0085", "tab \t", " lead", "x ''' '.", "². ½) (a) [b]"]
    assert enc.batch([]) == []
    for size in (1, 3, 50, len(texts)):
        rnd.shuffle(texts)
        for at in range(0, len(texts), size):
            some = texts[at:at + size]
            want = [tok.encode(t, add_special_tokens=False).ids for t in some]
            assert [x.tolist() for x in enc.batch(some)] == want
            assert [x.tolist() for x in bpe.encoder.batch(some)] == want


def test_words_go_to_the_model_together_and_tails_alone():
    calls = []

    def encode(strings):
        calls.append(list(strings))
        return [np.frombuffer(s.encode(), np.uint8).astype("<u2").tobytes() for s in strings]

    enc = ChunkEncoder(encode, "<u2", [], encode_words=encode)
    words = ["".join(chr(97 + i // k % 26) for k in (1, 26, 676)) for i in range(1000)]
    texts = ["x " + " ".join(w + tail for w in words) for tail in ("", ".", "###", ").")]
    assert [bytes(x.astype(np.uint8)).decode() for x in enc.batch(texts)] == texts
    assert len(calls) < 10  # not one a word
    sent = list(chain(*calls))
    assert sum(w in s for s in sent for w in words[::50]) == len(words[::50])  # no word again for its tail
