import random
import zlib

import numpy as np
import pytest

from textloom.llm import toxicity as X

BAD = ["vile", "scumbag", "nastyhead"]
SMALL = X.Config(ones=100, zeros=300, passes=10, batch=16, ngrams=1 << 10, min_texts=2)


def _texts(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        w = ["".join(rnd.choice("abcdeginorst") for _ in range(rnd.randint(2, 6))) for _ in range(rnd.randint(3, 150))]
        y = i % 4 == 0
        if y:
            for _ in range(rnd.randint(1, 4)):
                w.insert(rnd.randrange(len(w)), rnd.choice(BAD) + rnd.choice(["", ".", "!"]))
        out.append((" ".join(w), int(y)))
    return out


def test_gradients():
    cfg = X.Config(dim=3, hidden=4, window=5, stride=3, ngrams=64, min_texts=1)
    m = X.Model(cfg, ["aa", "bb"], .5)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    f = m.features(["aa", "bb", "cc", "zz"])
    idx, y = np.array([[1, 2, 3, 4, 1], [4, 3, 0, 0, 0], [2, 0, 0, 0, 0]]), np.array([1., 0., 1.])

    def loss():
        p = X.sigmoid(m.window_logits(m.gates(m.vectors(f)), idx))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    got, rng = X._loss_step(m, f, idx, y), np.random.default_rng(0)
    for name, a in m.p.items():
        for _ in range(5):
            i = tuple(rng.integers(name == "word" and k == 0, s) for k, s in enumerate(a.shape))
            old = a[i]
            a[i] = old + 1e-3
            up = loss()
            a[i] = old - 1e-3
            down = loss()
            a[i] = old
            assert abs((up - down) / 2e-3 - got[name][i]) < 2e-4, name


def test_windows_overlap_and_cover():
    for n in (0, 1, 31, 32, 33, 56, 57, 200):
        s = X.window_starts(n, 32, 24)
        assert {k for a in s for k in range(a, min(n, a + 32))} == set(range(n))
        assert all(b - a < 32 for a, b in zip(s, s[1:], strict=False)) and (s >= 0).all()


def test_held_out_accuracy_and_odd_rows(spark):
    data = _texts(700, 1)
    docs = spark.createDataFrame([(i, t, 1.0) for i, (t, _) in enumerate(data)] +
                                 [(900, None, 1.0), (901, "", 1.0), (None, "you vile scumbag", 1.0), (5, data[5][0], 1.0)],
                                 "doc_id long, text string, score double").repartition(4)
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)] + [(None, 1), (3, None), (4, 7)],
                                   "doc_id long, toxic int")
    got = X.toxicity(docs, labels, cfg=SMALL).collect()
    assert len(got) == 704
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in by.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= .3) for r in got)
    assert by[900].score == by[901].score == 0
    assert next(r for r in got if r.doc_id is None).predicted == 1
    test = [(by[i].predicted, y) for i, (_, y) in enumerate(data) if by[i].held_out]
    assert np.mean([p == y for p, y in test]) >= 0.95
    assert X.toxicity(docs.limit(0), labels, cfg=SMALL).collect() == []
    assert {r.score for r in X.toxicity(docs, labels.limit(0), cfg=SMALL).collect()} == {0.0}


def test_labels_of_held_out_rows_do_not_matter(spark):
    data = _texts(60, 2)
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(data)], "doc_id long, text string")
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in range(60)]
    a = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(data)], "doc_id long, toxic int")
    b = spark.createDataFrame([(i, 1 - y if h else y) for i, ((_, y), h) in enumerate(zip(data, held, strict=True))],
                              "doc_id long, toxic int")
    one, two = ({r.doc_id: r.score for r in X.toxicity(docs, x, cfg=SMALL).collect()} for x in (a, b))
    assert one == pytest.approx(two)


def _plain_score(model, text):
    """Windows, both recurrences and attention, one step and one number at a time."""
    words = X.words_of(text)
    if not words:
        return 0.0
    p, k, cfg = {n: v.astype(np.float64) for n, v in model.p.items()}, model.cfg.hidden, model.cfg

    def vector(w):
        grams, _ = X.char_ngrams([w], cfg.ngrams)
        return p["word"][model.vocabulary.get(X.bare(w), 0)] + sum(p["char"][g] for g in grams) / len(grams)

    def states(vs, side):
        h, out = np.zeros(k), []
        for v in vs:
            g, hu = v @ p["w" + side] + p["g" + side], h @ p["u" + side]
            z = 1 / (1 + np.exp(-(g[:k] + hu[:k])))
            r = 1 / (1 + np.exp(-(g[k:2 * k] + hu[k:2 * k])))
            h = (1 - z) * np.tanh(g[2 * k:] + r * hu[2 * k:]) + z * h
            out.append(h)
        return out

    best = -np.inf
    for at in range(0, max(1, len(words) - cfg.window + cfg.stride), cfg.stride):
        at = min(at, max(0, len(words) - cfg.window))
        vs = [vector(w) for w in words[at:at + cfg.window]]
        both = [np.concatenate(x) for x in zip(states(vs, "f"), states(vs[::-1], "b")[::-1], strict=True)]
        weight = np.exp([h @ p["att"] for h in both])
        best = max(best, sum(a * (h @ p["out"]) for a, h in zip(weight / weight.sum(), both, strict=True)) + p["bias"][0])
    return 1 / (1 + np.exp(-best))


def test_score_equals_the_plain_network():
    data = _texts(120, 4)
    model = X.train([t for t, _ in data], [y for _, y in data], X.Config(ngrams=1 << 10, min_texts=2, steps=20, passes=2))
    texts = [t for t, _ in data[:25]] + ["", "one", "naïve İ ßcum bag!", " ".join(t for t, _ in data[:6])]
    got = X.score_texts(model, texts)
    assert np.allclose(got, [_plain_score(model, t) for t in texts], atol=2e-5)


def test_default_settings_learn_from_few_labels():
    data = _texts(300, 5)
    model = X.train([t for t, _ in data], [y for _, y in data])
    test = _texts(300, 6)
    score = X.score_texts(model, [t for t, _ in test])
    y = np.array([y for _, y in test])
    assert (score[y == 1] >= 0.3).mean() >= 0.8 and (score[y == 0] >= 0.3).mean() <= 0.05


def test_one_row_in_five_does_not_train():
    y = np.array([0.0] * 20 + [1.0] * 5)
    held = X._validation(y, 5)
    assert held[:20].sum() == 4 and held[20:].sum() == 1
    assert not X._validation(np.array([0.0] * 20 + [1.0] * 4), 5).any()
