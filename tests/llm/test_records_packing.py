import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textloom.llm import packing as P
from textloom.llm import records as R

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeé 漢") for _ in range(rnd.randint(1, 7)))
    rows = [(i, " ".join(word() for _ in range(rnd.choice([0, 1, 5, 50, 400, 1500])))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, rows[7][1]), (7, rows[7][1]), (None, "null id"), (503, "x" * 5000)]
    rnd.shuffle(rows)
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, offset string").repartition(6)


def _ids(df):
    tok = Tokenizer.from_file(PATH)
    return [(r.doc_id, [*tok.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in df.collect()]


def _crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_frames_detect_damage():
    data = R.frame(b"abc") + R.frame(b"")
    assert R.unframe(data) == (b"abc", len(data) - R.OVERHEAD)
    assert R.unframe(data, len(data) - R.OVERHEAD) == (b"", len(data))
    for i in range(len(data) - R.OVERHEAD):
        bad = bytearray(data)
        bad[i] ^= 1
        with pytest.raises(ValueError):
            R.unframe(bytes(bad))


def test_records_round_trip(spark, docs, tmp_path):
    folder = str(tmp_path / "rec")
    R.write_records(docs, folder, PATH, files=5)
    want = sorted(_ids(docs), key=lambda x: (x[0] is not None, x[0] or 0))
    start, expect = 0, []
    for key, ids in want:
        expect.append((key, start, len(ids), ids))
        start += len(ids)
    for seed in (None, 9):
        got = [(r._id, r.start, r.n_tokens, np.frombuffer(r.ids_u32, "<u4").tolist())
               for r in R.read_records(spark, folder, seed).collect()]
        assert sorted(got, key=lambda x: x[1]) == expect


def test_records_of_an_empty_table(spark, docs, tmp_path):
    folder = str(tmp_path / "none")
    assert R.write_records(docs.limit(0), folder, PATH).collect() == []
    assert R.read_records(spark, folder).collect() == []


def _check_packed(rows, ids_of, limits):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= limits.tokens and len(seq) <= limits.segments
    return by_doc, by_seq


def test_packed_documents_hold_every_id_once(spark, docs):
    limits = P.Limits(tokens=64, segments=5, loss=64)
    once = docs.dropDuplicates(["doc_id"])
    rows = P.pack_documents(once, PATH, limits=limits).collect()
    want = dict(_ids(once))
    by_doc, by_seq = _check_packed(rows, want, limits)
    assert by_doc.keys() == want.keys()
    for key, parts in by_doc.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.crc) == (at, len(want[key]), _crc(want[key][at:at + r.length]))
            at += r.length
        assert at == len(want[key])
    used = sum(r.length for r in rows)
    padded = sum(P.padded_length(sum(r.length for r in s), 64) for s in by_seq.values())
    assert padded - used < 0.02 * used
    # repeated rows are packed each
    assert sum(r.length for r in P.pack_documents(docs, PATH, limits=limits).collect()) == sum(
        len(i) for _, i in _ids(docs))
    assert P.pack_documents(docs.limit(0), PATH).collect() == []


def test_examples_stay_whole_under_three_limits(spark):
    rnd = random.Random(1)
    rows = [(i, rnd.randint(1, 500), rnd.randint(0, 200)) for i in range(400)] + [(900, 2000, 10), (901, 10, 900), (902, None, None)]
    limits = P.Limits(tokens=1000, segments=6, loss=300)
    df = spark.createDataFrame(rows, "ex long, n long, y long")
    got = {r.ex: (r.sequence_id, r.offset) for r in P.pack_examples(df, "ex", "n", "y", limits).collect()}
    assert got.keys() == {r[0] for r in rows}
    seqs = {}
    for i, n, y in rows:
        seqs.setdefault(got[i][0], []).append((got[i][1], n or 0, y or 0, i))
    for s in seqs.values():
        at = 0
        for off, n, _, _ in sorted(s, key=lambda x: (x[0], x[1])):
            assert off == at
            at += n
        if {x[3] for x in s} & {900, 901}:
            assert len(s) == 1
        else:
            assert at <= 1000 and len(s) <= 6 and sum(x[2] for x in s) <= 300
    # the binding limit is nearly used up
    assert len(seqs) <= 2 + 1.15 * max(sum(n or 0 for _, n, _ in rows[:400]) / 1000, sum(y or 0 for *_, y in rows[:400]) / 300)


def test_padding_rule():
    assert [P.padded_length(n) for n in (1, 3, 512, 513, 1024)] == [1, 1024, 512, 1024, 1024]


def test_long_reads_give_every_record(spark, tmp_path, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 7)) for i in range(60)] + [(None, "none")], "doc_id long, text string")
    R.write_records(docs, str(tmp_path), PATH, end_id=0, files=2)
    parts = [(m.file, m.dtype) for m in R.read_manifest(spark, str(tmp_path)).collect()]
    one = [[(k, s, i.tolist()) for k, s, i in R.read_file(f"{tmp_path}/data", *p)] for p in parts]
    for block in (1, 64, 300):  # a record per read, and several
        monkeypatch.setattr(R, "BLOCK", block)
        assert one == [[(k, s, i.tolist()) for k, s, i in R.read_file(f"{tmp_path}/data", *p)] for p in parts]
    shuffled = [sorted([(k, s, i.tolist()) for k, s, i in R.read_file(f"{tmp_path}/data", *p, 3)], key=lambda r: r[1]) for p in parts]
    assert shuffled == one and sum(map(len, one)) == 61


def test_instruction_query_keeps_its_limits(spark):
    from textloom.llm.queries import INSTRUCTIONS, QUERIES
    rows = QUERIES["pack_instructions"](spark, "/root/testdata/sf0.001").collect()
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    tok = Tokenizer.from_file(PATH)
    want = {}
    for t in turns:
        n = len(tok.encode(t.text or "", add_special_tokens=False).ids) + 1
        a, b = want.get(t.conv_id, (0, 0))
        want[t.conv_id] = (a + n, b + n * (t.role == "assistant"))
    assert {r.conv_id: (r.tokens, r.loss) for r in rows} == want and len(rows) == len(want)
    seqs = {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == [sum(x.tokens for x in s[:i]) for i in range(len(s))]
        if len(s) > 1:
            assert (sum(r.tokens for r in s) <= INSTRUCTIONS.tokens and len(s) <= INSTRUCTIONS.segments
                    and sum(r.loss for r in s) <= INSTRUCTIONS.loss)
    # two sequences that would fit into one: at most the last of each group
    assert len(seqs) <= 1.3 * max(sum(r.tokens for r in rows) / INSTRUCTIONS.tokens, len(rows) / INSTRUCTIONS.segments,
                                  sum(r.loss for r in rows) / INSTRUCTIONS.loss) + 1
