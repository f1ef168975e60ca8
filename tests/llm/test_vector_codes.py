"""Product codes against a plain k-means in Python integers."""

import math
import random

import numpy as np
import pytest

from textloom.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error int"


def plain(rows, cfg):
    kept = [(i, [math.floor(cfg.scale * x) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i4").tobytes()))
    if not kept:
        return [], []
    w = len(kept[0][1]) // cfg.parts
    part = lambda v, p: v[p * w:(p + 1) * w]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    books = [[part(v, p) for _, v, _ in kept[:cfg.entries]] for p in range(cfg.parts)]
    for t in range(cfg.rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (d2(part(v, p), books[p][e]), e)) for p in range(cfg.parts)]
                 for _, v, _ in kept]
        if t == cfg.rounds:
            break
        for p in range(cfg.parts):
            for e in range(len(books[p])):
                mine = [part(v, p) for (_, v, _), c in zip(kept, codes, strict=True) if c[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    error = [sum(d2(part(v, p), books[p][c[p]]) for p in range(cfg.parts)) for (_, v, _), c in zip(kept, codes, strict=True)]
    per = {}
    for (_, _, lab), e in zip(kept, error, strict=True):
        per[lab] = per.get(lab, 0) + e
    return sorted((str(i), bytes(c), e, per[lab]) for (i, _, lab), c, e in zip(kept, codes, error, strict=True)), books


def run(spark, rows, cfg):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got, books = V.vector_codes(df, cfg=cfg)
    got = got.collect()
    return sorted((str(r.vec_id), bytes(r.code), r.error, r.label_error) for r in got), [b.tolist() for b in books], got


def rows_of(n, dim, seed, spread=0.05):
    rnd = random.Random(seed)
    centres = [[rnd.uniform(-1, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rnd.choice(centres)
        rows.append((i, [x + rnd.gauss(0, spread) for x in c], rnd.choice([None, 0, 1, 2])))
    return rows


@pytest.mark.parametrize("entries,group", [(8, 3), (16, 16), (5, 1)])
def test_equals_plain_kmeans(spark, entries, group):
    rows = rows_of(150, 8, entries)
    rows += [(1, [0.0] * 8, 1), (None, [0.1] * 8, None), (900, None, 1), (901, [], 2), (902, [None] * 8, 0),
             (903, [float("nan")] * 8, 0), (904, [float("inf")] + [0.0] * 7, 0), (905, [-0.0001] * 8, 0)]
    rows += [rows[3]] * 40                       # a very common vector
    cfg = V.Config(entries=entries, group=group, rounds=4)
    got, books, _ = run(spark, rows, cfg)
    want, want_books = plain(rows, cfg)
    assert got == want and books == want_books


def test_ties_go_to_the_lower_entry(spark):
    rows = [(i, [float(x)] * 4, 0) for i, x in enumerate([0, 2, 2, 1, 1, 4, 3, 3])]
    cfg = V.Config(entries=4, group=2, rounds=2, scale=1)
    got, books, _ = run(spark, rows, cfg)
    assert (got, books) == plain(rows, cfg)


def test_bounds_save_distances(spark):
    """Fewer distances than a full scan per round, with the same result."""
    rows = rows_of(600, 8, 2, spread=0.01)
    cfg = V.Config(entries=32, group=4, rounds=4)
    got, books, raw = run(spark, rows, cfg)
    assert (got, books) == plain(rows, cfg)
    full = cfg.parts * cfg.entries * (cfg.rounds + 1)
    assert max(r.scans for r in raw) <= full + cfg.parts * cfg.rounds
    assert sum(r.scans for r in raw) < 0.8 * full * len(raw)


def test_net_displacement_is_at_most_the_drift():
    rnd = np.random.default_rng(1)
    books = [rnd.integers(-100, 100, (12, 5)) for _ in range(4)]
    net = V.displacement(books[3], books[0], 4)
    drift = sum(V.displacement(books[t + 1], books[t], 4) for t in range(3))
    assert (net <= drift + 1e-6).all() and net.sum() < drift.sum()


def test_empty_and_uneven(spark):
    got, books, _ = run(spark, [(1, None, 0)], V.Config())
    assert got == []
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, [(1, [0.0] * 8, 0), (2, [0.0] * 4, 0)], V.Config())
    with pytest.raises(ValueError, match="equal parts"):
        run(spark, [(1, [0.0] * 6, 0)], V.Config())


def test_large_components_are_exact():
    x = np.array([[1 << 28, -(1 << 28)]], dtype=np.int64)
    c = np.array([[-(1 << 28), (1 << 28) - 1]], dtype=np.int64)
    assert V.squared(x, c)[0, 0] == (1 << 58) + ((1 << 29) - 1) ** 2
