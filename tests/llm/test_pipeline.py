"""The pipeline against a plain version of its five stages, and each filtering
stage on odd rows."""

import random

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from textloom.llm import quality

LENGTH = C.PASSAGE


def _docs(seed=4):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghié") for _ in range(rnd.randint(2, 8)))
    line = lambda: (" ".join(word() for _ in range(rnd.randint(6, 14)))).capitalize() + "."
    prose = lambda n: "\n".join(line() for _ in range(n))
    rows = {i: prose(rnd.randint(2, 25)) for i in range(1, 70)}
    passage = prose(12)
    for i in (3, 9, 27):
        rows[i] = rows[i] + "\n" + passage + "\n" + prose(3)
    rows |= {101: rows[5], 102: "  " + rows[5].replace(" ", "  "), 103: rows[6] + " extra"}
    big = prose(60)
    for i in range(110, 116):  # near copies: one word differs
        w = big.split(" ")
        w[rnd.randrange(len(w))] = word()
        rows[i] = " ".join(w)
    rows |= {200: None, 201: "", 202: "too short", 203: "again " * 80, 204: "\n".join(["a | b | c | d | e | f | g"] * 9),
             205: "\n".join("THE!! " + " ".join(word().upper() + "!!" for _ in range(8)) for _ in range(9)),
             206: rows[8] + "\nClick here to enable javascript"}
    return rows


def _kept_by_quality(text):
    words = (text or "").split()
    repeat = brute.repeat_words(words)
    if len(words) < 10 or 100 * repeat > 20 * len(words):
        return False
    gone = 0
    for line in text.split("\n"):
        punct = sum(1 for c in line if c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
        bad = (len(line.split()) >= 5 and 100 * punct > quality.MAX_PUNCTUATION * len(line)
               or line.count("|") + line.count(">") >= 3 or any(p in line.lower() for p in quality.BOILERPLATE))
        gone += len("".join(line.split())) if bad else 0
    return 100 * gone <= 50 * sum(map(len, words))


def _plain(rows):
    rows = {i: t for i, t in rows.items() if _kept_by_quality(t)}
    groups = {}
    for i, t in rows.items():
        groups.setdefault("".join(t.split()), []).append((-len(t), i))
    rows = {i: rows[i] for g in groups.values() for i in [min(g)[1]]}
    ids = sorted(rows)
    fp = [brute.simhash(rows[i]) for i in ids]
    root = brute.classes(len(ids), lambda a, b: bin(fp[a] ^ fp[b]).count("1") <= 4)
    rows = {ids[k]: rows[ids[k]] for k in range(len(ids)) if root[k] == k}
    ids = sorted(rows)
    gone = brute.covered([rows[i] for i in ids], LENGTH)
    return {i: brute.suffix_row(rows[i], g)[3].decode("utf-8", "ignore") for i, g in zip(ids, gone, strict=True)}


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rows = [(i, t, "en", "s", None if t is None else len(t), i % 3) for i, t in _docs().items()]
    random.Random(1).shuffle(rows)
    folder = str(tmp_path_factory.mktemp("sf"))
    (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept int")
     .repartition(4).write.parquet(f"{folder}/documents.parquet"))
    return folder


def test_run_equals_the_plain_version(spark, table):
    want = _plain(_docs())
    assert {102, 9} <= want.keys() and not {5, 101, 200, 203, 204, 205} & want.keys() and len(want[9]) < len(_docs()[9])
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    parts, per_seq = {}, {}
    for r in C.run(spark, table).collect():
        parts.setdefault(r.doc_id, []).append(r)
        per_seq.setdefault(r.sequence_id, []).append(r)
    assert parts.keys() == want.keys()
    import zlib
    for i, text in want.items():
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(parts[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    assert all(sum(r.length for r in s) <= 1024 for s in per_seq.values())


def test_stages_keep_the_columns_and_take_empty_tables(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    for _, step in C.STAGES[:-1]:
        out = step(spark, docs, table)
        assert out.columns == docs.columns
        assert step(spark, docs.limit(0), table).collect() == []
    assert C.STAGES[-1][1](spark, docs.limit(0), table).collect() == []
    out = C.suffix_stage(spark, docs, table)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())


def test_repeated_rows_and_null_ids(spark):
    text = "\n".join(" ".join(f"word{i}{c}" for c in "abcdefgh") + "." for i in range(12))
    df = spark.createDataFrame([(1, text), (1, text), (2, text + " "), (None, "x" + text), (None, None)],
                               "doc_id long, text string")
    assert sorted(map(tuple, C.exact_stage(spark, df, "").collect()), key=str) == sorted(
        [(2, text + " "), (None, "x" + text), (None, None)], key=str)
    kept = C.quality_stage(spark, df, "").collect()
    assert len(kept) == 4 and all(r.text for r in kept)


@pytest.mark.parametrize("size", [285, 300, 396])
def test_passages_of_over_fifty_words_go(spark, size):
    rnd = random.Random(size)
    word = lambda n: "".join(rnd.choice("abcdefghilmnoprstu") for _ in range(n))
    passage = " ".join(word(4) for _ in range(51))
    while len(passage) < size:
        passage += " " + word(3)
    passage = passage[:size - 1].rstrip() + "."
    prose = lambda: " ".join(word(rnd.randint(2, 9)) for _ in range(120))
    rows = [(i, prose()) for i in range(12)]
    held = [(100 + i, f"{prose()}\n{passage}\n{prose()}") for i in range(3)]
    df = spark.createDataFrame(rows + held, "doc_id long, text string")
    got = {r.doc_id: r.text for r in C.suffix_stage(spark, df, "").collect()}
    assert all(got[i] == t for i, t in rows)          # clean documents stay as they are
    assert all(passage not in got[i] and len(t) - size - 4 <= len(got[i]) <= len(t) - len(passage) for i, t in held)


def test_null_and_repeated_ids_in_the_later_stages(spark):
    rnd = random.Random(8)
    prose = lambda n=60: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    a, b, c, d = (prose() for _ in range(4))
    near = a.split(" ")
    near[30] = "other"
    rows = [(None, a), (None, b), (4, c), (4, d), (4, d), (9, " ".join(near)), (2, " ".join(near[:-1] + ["last"]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    fp = [brute.simhash(t) for _, t in rows]
    root = brute.classes(len(rows), lambda i, j: bin(fp[i] ^ fp[j]).count("1") <= 4)
    kept = C.simhash_stage(spark, df, "").collect()
    # one row per class, of the smallest id where there is one; a class of null ids keeps a row
    classes = {}
    for (i, t), r in zip(rows, root, strict=True):
        classes.setdefault(r, []).append((i is None, i or 0, t))
    assert len(kept) == len(classes)
    for g in classes.values():
        least = min(x[:2] for x in g)
        assert any((r.doc_id is None, r.doc_id or 0) == least and (*least, r.text) in g for r in kept)
    assert (None, b) in [tuple(r) for r in kept]
    cut = C.suffix_stage(spark, df, "").collect()
    assert len(cut) == len(rows) and sum(r.text == "" for r in cut if r.doc_id == 4) == 2  # rows that repeat go both
    pieces = C.packing_stage(spark, df, "").collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(r.length for r in pieces) == want and {r.doc_id for r in pieces} == {None, 2, 4, 9}
