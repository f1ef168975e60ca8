"""Sharding, exact dedup, line dedup and quality rules on odd rows, against
plain definitions."""

import random
import zlib

import brute
import pytest

from textloom.llm import exact_dedup as E
from textloom.llm import line_dedup as L
from textloom.llm import quality as Q
from textloom.llm import sharding as S


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    texts = ["", None, " ", "a\tb", "ab", "a b ", "é 漢", "same text here", "Same text here"]
    texts += ["".join(rnd.choice("ab \n\té") for _ in range(rnd.randint(0, 300))) for _ in range(120)]
    return [(i, rnd.choice(texts), "x") for i in range(400)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows + [(None, "ab", "x"), (3, rows[3][1], "x")],
                                 "doc_id long, text string, shard string").repartition(6)


def test_exact_dedup(docs):
    data = [(r.doc_id, r.text or "") for r in docs.collect()]
    groups = {}
    for i, t in data:
        groups.setdefault(brute.sha("".join(c for c in t if c not in brute.WS)), []).append((-len(t), i is None, i or 0, i))
    got = E.exact_dedup(docs, k=5, tracked=64).collect()
    assert len(got) == len(data)
    for r in got:
        g = groups[r.text_sha256]
        assert (r.keep_id, r.group_size, r.kept) == (min(g)[3], len(g), r.doc_id == min(g)[3])
    assert E.exact_dedup(docs.limit(0)).collect() == []


def _capacity(sizes, shards):
    lo, hi = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while lo < hi:
        mid, used, room = (lo + hi) // 2, 1, (lo + hi) // 2
        for s in sizes:
            if s > room:
                used, room = used + 1, mid
            room -= s
        lo, hi = (lo, mid) if used <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("heavy", [[1 / 3], [0.3, 0.2]])
def test_sharding_around_large_groups(spark, heavy):
    """Texts with a third, or half, of all bytes: no shard is empty, and what lies between
    them is cut evenly."""
    rnd = random.Random(3)
    small = [f"{i} " + "x" * rnd.randint(20, 60) for i in range(400)]
    bytes_ = sum(map(len, small))
    large = [f"large {i} " + "y" * int(bytes_ * h / (1 - sum(heavy))) for i, h in enumerate(heavy)]
    df = spark.createDataFrame(list(enumerate(small + large)), "doc_id long, text string").repartition(5)
    sizes = {}
    for r in S.assign_shards(df, shards=8).collect():
        sizes.setdefault(r.shard, []).append(r["size"])
    assert sorted(sizes) == list(range(8))
    alone = [s for s in sizes.values() if max(s) > 1000]
    assert len(alone) == len(heavy) and all(len(s) == 1 for s in alone)
    total = [sum(s) for s in sizes.values() if max(s) < 1000]
    # the number of shards between two large groups is whole, so shares differ a little
    even = sum(total) / len(total)
    assert max(total) <= 1.5 * even and (len(heavy) > 1 or min(total) >= 0.7 * even)


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_sharding(docs, shards):
    got = S.assign_shards(docs, shards=shards, slot_buckets=7).collect()
    data = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.text_crc32) for r in got) == sorted(
        (-1 if i is None else i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in data)
    where, load, slots = {}, {}, {}
    text = dict(data)
    for r in got:
        where.setdefault(text[r.doc_id], set()).add(r.shard)
        load[r.shard] = load.get(r.shard, 0) + r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(len(s) == 1 for s in where.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = {}
    for _, t in data:
        groups[brute.sha(t)] = groups.get(brute.sha(t), 0) + len(t.encode()) + 1
    assert max(load.values()) <= _capacity([groups[k] for k in sorted(groups)], shards)
    assert max(load) < shards


def test_sharding_finds_the_smallest_capacity(spark):
    rnd = random.Random(2)
    sizes = [rnd.randint(1, 5000) for _ in range(700)]
    cum, rows = 0, []
    for i, s in enumerate(sizes):
        cum += s
        rows.append((f"{i:05d}", s, cum))
    df = spark.createDataFrame(rows, "digest string, size long, cum long").cache()
    cap, cuts = S.minimax_cuts(df, 8)
    assert cap == _capacity(sizes, 8)
    assert max(b - a for a, b in zip([0, *cuts], cuts, strict=False)) == cap and len(cuts) <= 8
    assert S.minimax_cuts(df.limit(0), 8) == (0, [])
    assert S.assign_shards(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_quality_counts(spark):
    rnd = random.Random(6)
    texts = [None, "", "\n", "one", " ".join(["w"] * 4), " ".join(["w"] * 5), " ".join(["w"] * 6), "a b c d e f a b c d e",
             "x\nx\n x\n\n\nx", "#*$%&|<> é漢", "v\x0bt\x0cf\rr", "\x85nel nbsp"]
    texts += [" ".join(rnd.choice("abc") for _ in range(rnd.randint(5, 60))) for _ in range(60)]
    texts += ["\n".join(rnd.choice(["Some words stand in this line here.", "a | b | c | d", "click here now", "p!!! q!!! r!!! s!!! t!!!", ""])
                        for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        t, r = t or "", got[i]
        flat = t
        for c in brute.WS:
            flat = flat.replace(c, " ")
        words = [w for w in flat.split(" ") if w]
        lines = [x for x in t.split("\n") if x.strip(brute.WS)]
        repeat = brute.repeat_words(words)
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeat,
                len(words) < 10 or 100 * repeat > 20 * len(words))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want, repr(t)
        fails = [x for x in t.split("\n") if (len(x.split()) >= 5 and 100 * sum(c == "!" or c in "|." for c in x) > 12 * len(x))
                 or x.count("|") >= 3 or "click here" in x]
        if "\x85" not in t and "#" not in t:
            assert r.clean_text == "\n".join(x for x in t.split("\n") if x not in fails)
            assert r.kept == (not want[5] and 100 * sum(len("".join(x.split())) for x in fails) <= 50 * want[1])
    assert Q.quality_rules(df.limit(0)).collect() == []


def test_line_dedup(spark):
    rnd = random.Random(8)
    pool = ["A long enough line, number %d" % i for i in range(6)] + ["short", "", "   ", "ÄÖ long enough line with É"]
    data = [(i, "\n".join(rnd.choice(["", " ", "\t"]) + rnd.choice([x, x.upper(), x]) + rnd.choice(["", " \r"])
                          for x in rnd.choices(pool, k=rnd.randint(1, 8)))) for i in range(40)]
    data += [(50, None), (51, ""), (52, "only in two docs, not three"), (53, "only in two docs, not three"), (None, pool[0])]
    df = spark.createDataFrame([(*r, 0) for r in data], "doc_id long, text string, n_lines int").repartition(4)
    key = lambda x: "".join(brute.LOW[brute.UP.index(c)] if c in brute.UP else c for c in x.strip(brute.WS))
    holders = {}
    for i, t in data:
        for x in (t or "").split("\n"):
            holders.setdefault(key(x), set()).add(-1 if i is None else i)
    drop = lambda i, x: len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != i
    got = {-1 if r.doc_id is None else r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in L.line_dedup(df).collect()}
    for i, t in data:
        i = -1 if i is None else i
        lines = (t or "").split("\n")
        kept = [x for x in lines if not drop(i, x)]
        assert got[i] == (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert L.line_dedup(df.limit(0)).collect() == []
