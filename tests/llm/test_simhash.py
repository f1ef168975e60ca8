import random

import brute
import numpy as np
import pytest

from textloom.llm import graph
from textloom.llm import simhash as S


def test_fingerprint_is_the_definition():
    rnd = random.Random(1)
    texts = ["", " \n", "one", "a b c", "a b c d", "A B c D e", "É é ä Ä x", "w " * 50, "\x85 nel nbsp x\x1fy z q"]
    texts += [" ".join(rnd.choice("abcdÄ") * rnd.randint(1, 3) for _ in range(rnd.randint(1, 60))) for _ in range(80)]
    for t in texts:
        assert S.fingerprint(t) == brute.simhash(t), repr(t)


@pytest.mark.parametrize("seed", range(8))
def test_links_span_exactly_the_classes(seed):
    rng = np.random.default_rng(seed)
    n, radius = int(rng.integers(2, 300)), int(rng.integers(0, 8))
    fp = rng.integers(0, 2**64, size=6, dtype=np.uint64)[rng.integers(0, 6, n)]
    for i in range(n):
        for b in rng.integers(0, 64, rng.integers(0, 6)):
            fp[i] ^= np.uint64(1) << np.uint64(b)
    run = np.sort(rng.integers(0, 3, n))
    a, b = S.spanning_links(run, fp, radius)
    dist = lambda x, y: bin(int(x) ^ int(y)).count("1")
    assert all(dist(x, y) <= radius for x, y in zip(a, b, strict=True))
    root = brute.classes(n, lambda i, j: run[i] == run[j] and dist(fp[i], fp[j]) <= radius)
    assert len(a) == n - len(set(root))


def test_key_masks_lose_no_pair():
    rnd = random.Random(0)
    masks = S.key_masks(4, 6)
    assert len(masks) == 15
    for _ in range(500):
        diff = sum(1 << b for b in rnd.sample(range(64), 4))
        assert any(diff & (m & (1 << 64) - 1) == 0 for m in masks)
    with pytest.raises(ValueError):
        S.key_masks(4, 4)


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    links += [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    root = {x: x for x in nodes}
    for _ in nodes:
        before = dict(root)
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == root
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("chunk,large", [(8, 1000), (8, 0), (1 << 15, 1000)])
def test_dedup(spark, monkeypatch, chunk, large):
    monkeypatch.setattr(S, "CHUNK", chunk)
    monkeypatch.setattr(S, "LARGE", large)
    rnd = random.Random(3)
    base = [[f"w{rnd.randrange(500)}" for _ in range(60)] for _ in range(6)]
    texts = [None, "", " ", "one two"]
    for _ in range(90):
        w = list(rnd.choice(base))
        if rnd.random() < .7:
            w[rnd.randrange(60)] = f"w{rnd.randrange(500)}"
        texts.append(" ".join(w))
    texts += texts[10:20]
    data = [(i * 7 % 211, t, "c") for i, t in enumerate(texts)]
    df = spark.createDataFrame([*data, (None, texts[5], "c"), (None, "nothing like it at all", "c"), data[8]],
                               "doc_id long, text string, fp string").repartition(5)
    fp = [brute.simhash(t) for _, t, _ in data]
    order = sorted(range(len(data)), key=lambda k: data[k][0])
    root = brute.classes(len(data), lambda a, b: bin(fp[order[a]] ^ fp[order[b]]).count("1") <= 4)
    want = {data[order[k]][0]: (f"{fp[order[k]]:016x}", data[order[root[k]]][0]) for k in range(len(data))}
    got = S.simhash_dedup(df).collect()
    assert len(got) == len(data) + 3
    for r in got:
        if r.doc_id is not None:
            assert (r.fingerprint, r.component_id) == want[r.doc_id]
    alone = [r.component_id for r in got if r.doc_id is None]
    assert sorted(alone, key=str) == sorted([want[data[5][0]][1], None], key=str)
    assert S.simhash_dedup(df.limit(0)).collect() == []
