"""Conversation trie and tree contraction against plain versions."""

import hashlib
import random
import zlib

import pytest

from textloom.llm.contraction import subtree_totals
from textloom.llm.prefix_trie import conversation_trie


def plain_totals(parent, value):
    total = dict(value)
    depth = {}

    def deep(v):
        if v not in depth:
            depth[v] = 0 if parent[v] is None else deep(parent[v]) + 1
        return depth[v]

    for v in sorted(parent, key=lambda v: -deep(v)):
        if parent[v] is not None:
            total[parent[v]] += total[v]
    return total


def trees():
    rnd = random.Random(3)
    yield "random", {i: None if i == 0 else rnd.randrange(i) for i in range(120)}
    yield "chain", {i: None if i == 0 else i - 1 for i in range(75)}
    yield "star", {i: None if i == 0 else 0 for i in range(60)}
    # chains that become longer when their side leaves are gone, below a root with one child
    yield "comb", {0: None, **{i: (i - 1 if i < 40 else i - 40) for i in range(1, 80)}}
    yield "two roots", {0: None, 1: None, 2: 1, 3: 2, 4: 2}
    yield "bushes on chains", {i: None if i == 0 else i - 1 if i % 7 else max(0, i - 30) for i in range(150)}


@pytest.mark.parametrize("name,parent", list(trees()))
def test_subtree_totals(spark, name, parent):
    rnd = random.Random(name)
    value = {v: rnd.randrange(100) for v in parent}
    tree = spark.createDataFrame([(v, p, value[v], 1) for v, p in parent.items()], "node long, parent long, x long, one int")
    got, _ = subtree_totals(tree, ["x", "one"])
    rows = got.collect()
    assert len(rows) == len(parent)
    assert {r.node: r.x for r in rows} == plain_totals(parent, value)
    assert {r.node: r.one for r in rows} == plain_totals(parent, dict.fromkeys(parent, 1))


def test_empty_forest(spark):
    got, _ = subtree_totals(spark.createDataFrame([], "node long, parent long, x long"), ["x"])
    assert got.collect() == []


def plain_trie(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [t[3:] for t in sorted(x)] for c, x in turns.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(int(c - (abs(c) % 5) * (1 if c >= 0 else -1)), [])[:h] + mine[h:])
    member = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            member.setdefault(seq[:d], []).append(c)
    out = []
    for k, m in member.items():
        below = [x for x in member if x[:len(k)] == k]
        kids = {x for x in below if len(x) == len(k) + 1}
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[:len(x)] == x for y in member)]
        ends = sorted(c for c in m if len(built[c]) == len(k))
        out.append((min(m), len(k), min(member[k[:-1]]) if k else None, len(m), len(kids), len(leaves),
                    sum((len(member[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "n", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, node string, depth int")
    got = conversation_trie(df.repartition(5), **kw).collect()
    return sorted((tuple(r[n] for n in NAMES) for r in got), key=str)


def test_trie_of_odd_rows(spark):
    rnd = random.Random(5)
    texts = ["", None, "a", "b", "é漢", "x:y", "1"]
    rows = [(c, rnd.choice([None, 0, 1, 1, 2, 3, 9]), rnd.choice(["user", "", None, "1:"]), rnd.choice(texts))
            for c in range(-12, 60) for _ in range(rnd.randrange(0, 7))]
    rows += rows[:20]                                              # repeated rows
    rows += [(None, 0, "user", "nobody's"), (77, None, None, None)]
    assert trie(spark, rows) == plain_trie(rows)


def test_long_and_common_conversations(spark):
    rnd = random.Random(6)
    rows = [(100, t, "user", rnd.choice("ab") * 3) for t in range(150)]  # cut by the range sort
    rows += [(c, t, "user", f"same {t}") for c in range(200, 290) for t in range(3)]
    rows += [(c, t, "user", "q" if t == 0 else f"{c}") for c in range(300, 330) for t in range(2)]
    assert trie(spark, rows) == plain_trie(rows)


def test_empty_table(spark):
    assert trie(spark, []) == []
