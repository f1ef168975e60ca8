"""Queries on ids of the published vocabulary against the tokenizers library."""
import unicodedata

import pytest

from textloom.operators import bpe as B
from textloom.operators.audit import TOKEN_BUDGET
from textloom.plans import QUERIES

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

TEXTS = {1: "The tokenizer reads the whole sentence, then the next sentence of the document.",
         2: "Việt Nam  thơ lục bát: trăm năm trong cõi người ta, chữ tài chữ mệnh",
         3: "numbers 12345 and marks !!! -- don't  stop\tthere; twenty characters and more",
         4: "été à la plage, " + "wordless " * 30}


@pytest.fixture(scope="module")
def encode():
    tok = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def ids(text):
        raw = tok.encode(unicodedata.normalize("NFC", text or ""), add_special_tokens=False).ids
        return [0 if i == 50256 else i + 1 for i in raw]
    return ids


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("real"))
    rows = [(i, t, f"src{10 + i % 2}", len(t)) for i, t in TEXTS.items()]
    (spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
     .write.parquet(f"{path}/documents.parquet"))
    return path


def test_published_merges_are_whole(spark, encode):
    from textloom.plans.q_bpe import published_merges
    merges = published_merges(spark)
    assert merges.count() == 50_000
    df = spark.createDataFrame([*TEXTS.items(), (9, f"a{B.SPECIAL}b"), (10, None)], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in B.encode(df, merges, ["doc_id"]).collect()}
    assert got == {**{i: encode(t) for i, t in TEXTS.items()}, 9: encode(f"a{B.SPECIAL}b"), 10: []}


def test_token_audit_counts_the_vocabulary(spark, folder, encode):
    want = {}
    for i, t in TEXTS.items():
        want[f"src{10 + i % 2}"] = want.get(f"src{10 + i % 2}", 0) + len(encode(t.strip()))
    assert {r.source: r.tokens for r in QUERIES["token_counts_bpe"](spark, folder).collect()} == want
    total = sum(want.values())
    for r in QUERIES["token_audit_bpe"](spark, folder).collect():
        assert (r.tokens, r.weighted_tokens, r.unique_tokens) == (want[r.source], want[r.source], total)
        assert r.repeat_factor == round(TOKEN_BUDGET / total, 2) and r.budget_gap_or_surplus == total - TOKEN_BUDGET
    lines = [r.line for r in QUERIES["audit_summary_bpe"](spark, folder).collect()]
    assert f"Unique tokens after dedup: {total:,}" in lines


def test_summary_reads_the_audit_once(spark, folder):
    """The lines of one audit encode the texts once, not again for the run-wide lines."""
    df = QUERIES["audit_summary_bpe"](spark, folder)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sum(r.line.startswith("Unique tokens") for r in df.collect()) == 1 and df.count() == 5 + len({10, 11})


def test_packing_and_budget_use_the_vocabulary(spark, folder, encode):
    from model import pack_model
    from textloom.plans.q_train import BATCH_DOCS, BLOCK, SHARDS
    blocks = pack_model([[*encode(t), 0] for _, t in sorted(TEXTS.items())], BLOCK, BATCH_DOCS, SHARDS)
    got = QUERIES["pack_blocks_bpe"](spark, folder).orderBy("shard", "batch", "block_idx").collect()
    assert [(r.n_tokens, r.tok_sum, r.tok_wsum, r.first_tok, r.last_tok) for r in got] == [
        (len(b), sum(b), sum(x * (i + 1) for i, x in enumerate(b)), b[0], b[-1]) for b in blocks]
    want = {}
    for i, t in TEXTS.items():
        want[f"src{10 + i % 2}"] = want.get(f"src{10 + i % 2}", 0) + len(encode(t)) + 1
    budget = QUERIES["step_budget_bpe"](spark, folder).collect()
    assert {r.source: r.tokens for r in budget} == want
    assert all(r.max_steps == r.tokens // r.tokens_per_step for r in budget)
    # weight 1, all blocks short: the splits hold every token
    split = QUERIES["train_blocks_bpe"](spark, folder).collect()
    assert {r.split for r in split} == {"eval", "train"} and sum(r.real_tokens for r in split) == sum(want.values())


def test_wrapped_samples_use_the_vocabulary(spark, encode, tmp_path):
    texts = [*TEXTS.values(), None, "", "  lead", "long " * 90]
    rows = [(1, i, "user", t) for i, t in enumerate(texts)]
    (spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
     .write.parquet(f"{tmp_path}/conversations.parquet"))
    got = {r.turn: r for r in QUERIES["mask_labels_bpe"](spark, str(tmp_path)).collect()}
    samples = [encode("thơ:\n" + (t or "") + B.SPECIAL) for t in texts]
    prefix = len(encode("thơ:\n"))
    for i, ids in enumerate(samples):
        kept = ids[:64]
        pad = 64 - len(kept)
        assert got[i].input_ids == ",".join(map(str, kept + [0] * pad))
        assert got[i].attention_mask == ",".join(["1"] * len(kept) + ["0"] * pad)
        labels = [x if k >= prefix else -100 for k, x in enumerate(kept)] + [-100] * pad
        assert got[i].labels == ",".join(map(str, labels))
    stats = QUERIES["stage2_token_stats_bpe"](spark, str(tmp_path)).collect()
    assert sum(r.tokens for r in stats) == sum(min(len(s), 64) for s in samples)
    assert sum(r.samples for r in stats) == len(texts)
