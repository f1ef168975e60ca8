"""Toxicity score: a bidirectional gated recurrent network with attention
pooling over character and word inputs, trained in numpy.

A word's input is its word vector plus the mean vector of its character n-grams,
so unseen words still say something.  A text is cut into overlapping windows; each
window is read in both directions, the states are pooled by attention, and a
text's score is that of its worst window.  Training knows only the labels of
texts: in each pass the worst window of every text is found and learned from.

Training runs on a bounded sample (``Config.ones`` and ``Config.zeros`` rows) of
the labelled rows; whole texts of these rows are on the driver.  A part of the sample
does not train: its loss tells when to stop and which parameters to keep, and its rows
set the bias.  Scoring runs in the tasks, over every window of every text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_or_empty


@dataclass(frozen=True)
class Config:
    ones: int = 1000        #: rows of label 1 that training may see
    zeros: int = 2500       #: and of label 0
    window: int = 32        #: words per window
    stride: int = 24        #: words from one window to the next
    dim: int = 8            #: input vector
    hidden: int = 8         #: state per direction
    vocabulary: int = 20000
    min_texts: int = 5      #: texts that a vocabulary word is found in, at least
    ngrams: int = 1 << 16   #: hashed character n-grams
    passes: int = 4         #: over the sample, at least
    steps: int = 300        #: batches, at least (a small sample is passed more often)
    patience: int = 1       #: passes without a better validation loss before the end
    most: int = 600         #: batches, at most
    validate: int = 5       #: one row in so many does not train (none in samples of fewer than so many of a class)
    batch: int = 64
    rate: float = 0.01
    seed: int = 7


EDGE = ".,;:!?\"'()[]{}<>|*#$%&_-"
#: Words kept per worker before the table starts anew.
WORDS = 200_000


def words_of(text: str) -> list[str]:
    return text.lower().split()


def bare(word: str) -> str:
    return word.strip(EDGE) or word


def char_ngrams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 3- to 5-grams of the words' characters, ends marked: (buckets word
    by word, count of each word)."""
    marked = [f"<{bare(w)}>" for w in words]
    size = np.array([len(w) for w in marked], dtype=np.int64)
    code = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64) + np.uint64(1)
    word = np.repeat(np.arange(len(marked)), size)
    behind = np.repeat(np.cumsum(size), size) - np.arange(len(code))  # characters of the word from here on
    found, owner, h = [], [], np.zeros(len(code), dtype=np.uint64)
    for n in range(1, 6):
        h = h[:len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1:]
        if n >= 3:
            at = np.flatnonzero(behind[:len(h)] >= n)
            x = h[at] ^ (h[at] >> np.uint64(29))
            found.append((x * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)) % np.uint64(buckets))
            owner.append(word[at])
    owner_all = np.concatenate(owner)
    order = np.argsort(owner_all, kind="stable")
    return np.concatenate(found)[order].astype(np.int32), np.bincount(owner_all, minlength=len(marked))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def scatter_add(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` summed by ``index`` into ``size`` rows."""
    out = np.zeros((size, values.shape[1]), dtype=values.dtype)
    order = np.argsort(index, kind="stable")
    index = index[order]
    head = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    out[index[head]] = np.add.reduceat(values[order], head, axis=0)
    return out


def window_starts(n: int, size: int, stride: int) -> np.ndarray:
    """Overlapping windows that cover all n words; the last one ends with them."""
    if n <= size:
        return np.zeros(1, dtype=np.int64)
    starts = np.arange(0, n - size, stride)
    return np.r_[starts, n - size]


class Gru:
    """One direction; x-gates come in as ``gx`` (steps, batch, 3 * hidden)."""

    def __init__(self, u: np.ndarray):
        self.u, self.h = u, u.shape[0]

    def forward(self, gx: np.ndarray):
        h, k = np.zeros((gx.shape[1], self.h), dtype=gx.dtype), self.h
        out, kept = np.empty((*gx.shape[:2], k), dtype=gx.dtype), []
        for t, g in enumerate(gx):
            hu = h @ self.u
            zr = sigmoid(g[:, :2 * k] + hu[:, :2 * k])
            z, r = zr[:, :k], zr[:, k:]
            n = np.tanh(g[:, 2 * k:] + r * hu[:, 2 * k:])
            kept.append((h, z, r, n, hu[:, 2 * k:]))
            h = n + z * (h - n)
            out[t] = h
        return out, kept

    def backward(self, dout: np.ndarray, kept):
        dh, du = np.zeros_like(dout[0]), np.zeros_like(self.u)
        dgx = np.empty((*dout.shape[:2], 3 * self.h), dtype=dout.dtype)
        for t in range(len(dout) - 1, -1, -1):
            h, z, r, n, hun = kept[t]
            dh = dh + dout[t]
            dn = dh * (1 - z) * (1 - n * n)
            dz = dh * (h - n) * z * (1 - z)
            dr = dn * hun * r * (1 - r)
            dgx[t] = np.concatenate([dz, dr, dn], axis=1)
            dhu = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ dhu
            dh = dh * z + dhu @ self.u.T
        return dgx, du


class Model:
    """Parameters, and the functions that training and scoring share."""

    def __init__(self, cfg: Config, vocabulary: list[str], prior: float):
        rng, d, k = np.random.default_rng(cfg.seed), cfg.dim, cfg.hidden
        self.cfg, self.prior = cfg, prior
        self.vocabulary = {w: i + 1 for i, w in enumerate(vocabulary)}  # 0: any other word
        self.p = {"word": rng.normal(0, .05, (len(vocabulary) + 1, d)), "char": rng.normal(0, .05, (cfg.ngrams, d))}
        for side in "fb":
            self.p["w" + side] = rng.normal(0, 1 / np.sqrt(d), (d, 3 * k))
            self.p["u" + side] = rng.normal(0, 1 / np.sqrt(k), (k, 3 * k))
            self.p["g" + side] = np.zeros(3 * k)
        self.p |= {"att": rng.normal(0, .3, 2 * k), "out": rng.normal(0, .3, 2 * k), "bias": np.zeros(1)}
        self.p = {n: x.astype(np.float32) for n, x in self.p.items()}
        self.key = ""

    def features(self, words: list[str]):
        """Word ids, and n-grams as one list with the begin of each word."""
        wid = np.array([self.vocabulary.get(bare(w), 0) for w in words], dtype=np.int64)
        if not words:
            return wid, wid, wid, wid
        parts = [char_ngrams(words[i:i + (1 << 14)], self.cfg.ngrams) for i in range(0, len(words), 1 << 14)]
        grams, size = (np.concatenate(x) for x in zip(*parts, strict=True))
        return wid, grams, np.cumsum(size) - size, size

    def vectors(self, f) -> np.ndarray:
        wid, grams, begin, size = f
        out = np.empty((len(wid), self.cfg.dim), dtype=self.p["word"].dtype)
        ends = np.r_[begin, len(grams)]
        for a in range(0, len(wid), 1 << 14):  # the n-grams' vectors are many times the words'
            b = min(a + (1 << 14), len(wid))
            chars = self.p["char"][grams[ends[a]:ends[b]]]
            out[a:b] = self.p["word"][wid[a:b]] + np.add.reduceat(chars, begin[a:b] - ends[a], axis=0) / size[a:b, None]
        return out

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Both directions' x-gates of word vectors; the row of the padding comes
        first: its update gate keeps the state."""
        both = np.concatenate([x @ self.p["w" + s] + self.p["g" + s] for s in "fb"], axis=1)
        pad = np.zeros((1, both.shape[1]), dtype=both.dtype)
        k = self.cfg.hidden
        pad[0, :k] = pad[0, 3 * k:4 * k] = 60.0
        return np.concatenate([pad, both])

    def window_logits(self, table: np.ndarray, idx: np.ndarray) -> np.ndarray:
        """idx: (windows, steps) rows of ``table``, 0 is padding behind the words."""
        k, (n, steps) = self.cfg.hidden, idx.shape
        score, value = np.zeros((2, steps, n), dtype=np.float32), np.zeros((2, steps, n), dtype=np.float32)
        for d, side in enumerate("fb"):
            u, h = self.p["u" + side], np.zeros((n, k), dtype=np.float32)
            ends = np.stack([self.p["att"], self.p["out"]], axis=1)[d * k:(d + 1) * k]
            half = np.ascontiguousarray(table[:, 3 * k * d:3 * k * (d + 1)])
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                g, hu = half[idx[:, t]], h @ u
                zr = g[:, :2 * k]
                zr += hu[:, :2 * k]
                np.negative(zr, out=zr)
                np.clip(zr, -60, 60, out=zr)
                np.exp(zr, out=zr)
                zr += 1
                np.reciprocal(zr, out=zr)
                m = g[:, 2 * k:]
                m += zr[:, k:] * hu[:, 2 * k:]
                np.tanh(m, out=m)
                h -= m
                h *= zr[:, :k]
                h += m
                score[d, t], value[d, t] = (h @ ends).T
        s = score.sum(axis=0)
        s[(idx == 0).T] = -1e9
        a = np.exp(s - s.max(axis=0))
        return (a * value.sum(axis=0)).sum(axis=0) / a.sum(axis=0) + self.p["bias"][0]

    def windows(self, lengths: list[int], rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(windows as rows of the table, first window of each text)."""
        size, stride = self.cfg.window, self.cfg.stride
        base, out, first, total = 0, [], [], 0
        for n in lengths:
            starts = window_starts(n, size, stride)
            first.append(total)
            total += len(starts)
            at = starts[:, None] + np.arange(size)
            out.append(np.where(at < n, at + base + 1, 0))
            base += n
        rows = np.r_[0, rows]
        return rows[np.concatenate(out)], np.array(first, dtype=np.int64)

    def score(self, table: np.ndarray, lengths: list[int], rows: np.ndarray) -> np.ndarray:
        """Of each text that has words; ``rows``: table row of every word."""
        idx, first = self.windows(lengths, rows)
        logits = np.concatenate([self.window_logits(table, idx[i:i + 4096]) for i in range(0, len(idx), 4096)])
        return sigmoid(np.maximum.reduceat(logits, first).astype(np.float64))


def _loss_step(m: Model, f, idx: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean cross-entropy over windows ``idx`` (rows of the
    features ``f`` plus 1, 0 is padding)."""
    k, p = m.cfg.hidden, m.p
    used, inverse = np.unique(idx[idx > 0] - 1, return_inverse=True)
    local = np.zeros_like(idx)
    local[idx > 0] = inverse + 1
    wid, grams, begin, size = f
    pick = np.concatenate([np.arange(b, b + s) for b, s in zip(begin[used], size[used], strict=True)])
    sub = (wid[used], grams[pick], np.cumsum(size[used]) - size[used], size[used])
    x = m.vectors(sub)
    table = m.gates(x)
    nets = {"f": Gru(p["uf"]), "b": Gru(p["ub"])}
    fwd, kf = nets["f"].forward(table[local.T][:, :, :3 * k])
    bwd, kb = nets["b"].forward(table[local.T[::-1]][:, :, 3 * k:])
    h = np.concatenate([fwd, bwd[::-1]], axis=2)
    s = h @ p["att"]
    s[(idx == 0).T] = -1e9
    a = np.exp(s - s.max(axis=0))
    a /= a.sum(axis=0)
    pooled = (a[:, :, None] * h).sum(axis=0)
    prob = sigmoid(pooled @ p["out"] + p["bias"][0])
    dl = ((prob - y) / len(y)).astype(np.float32)
    g = {"out": pooled.T @ dl, "bias": dl.sum(keepdims=True)}
    dp = dl[:, None] * p["out"]
    da = (h * dp).sum(axis=2)
    ds = a * (da - (a * da).sum(axis=0))
    dh = a[:, :, None] * dp + ds[:, :, None] * p["att"]
    g["att"] = np.einsum("tb,tbk->k", ds, h)
    dgf, g["uf"] = nets["f"].backward(dh[:, :, :k], kf)
    dgb, g["ub"] = nets["b"].backward(dh[::-1, :, k:], kb)
    d = scatter_add(local.T.ravel(), np.concatenate([dgf, dgb[::-1]], axis=2).reshape(-1, 6 * k), len(table))
    d = d[1:]  # padding learns nothing
    dx = np.zeros_like(x)
    for side, part in (("f", d[:, :3 * k]), ("b", d[:, 3 * k:])):
        g["w" + side], g["g" + side] = x.T @ part, part.sum(axis=0)
        dx += part @ p["w" + side].T
    g["word"] = scatter_add(sub[0], dx, len(p["word"]))
    g["word"][0] = 0  # unknown words are told by their characters
    g["char"] = scatter_add(sub[1], np.repeat(dx / sub[3][:, None], sub[3], axis=0), len(p["char"]))
    return g


def _log_odds(features: Iterator[np.ndarray], y: list[int], size: int, floor: float = 2.0) -> np.ndarray:
    """Smoothed log-odds of each feature's presence in a text: where the vectors'
    first dimension starts."""
    seen = np.zeros((2, size))
    for f, t in zip(features, y, strict=True):
        seen[t, np.unique(f)] += 1
    n = np.bincount(y, minlength=2)[:, None]
    zero, one = np.log((seen + floor) / (n + 2 * floor))
    return one - zero


def train(texts: list[str], y: list[int], cfg: Config = Config()) -> Model:
    """Fit on texts and 0/1 labels.  With one class only, or none, the model
    scores every text by the share of ones (0 without rows)."""
    prior = float(np.mean(y)) if y else 0.0
    index: dict[str, int] = {}  # the only copy of the words' strings
    rows = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], dtype=np.int32) for t in texts]
    labels = [int(v) for r, v in zip(rows, y, strict=True) if len(r)]
    rows = [r for r in rows if len(r)]
    if len(set(labels)) < 2:
        return Model(cfg, [], prior)
    stems: dict[str, int] = {}
    stem = np.array([stems.setdefault(bare(w), len(stems)) for w in index], dtype=np.int64)
    found = np.zeros(len(stems), dtype=np.int64)
    for r in rows:
        found[np.unique(stem[r])] += 1
    often = sorted((-int(n), w) for w, n in zip(stems, found, strict=True) if n >= cfg.min_texts)
    vocabulary = [w for _, w in often[:cfg.vocabulary]]
    m = Model(cfg, vocabulary, prior)
    m.key = f"{zlib.crc32(repr((cfg, vocabulary, labels)).encode())}-{len(texts)}"
    f = m.features(list(index))
    wid, grams, begin, size = f
    each = [np.unique(r) for r in rows]
    m.p["word"][1:, 0] += _log_odds((wid[e] for e in each), labels, len(vocabulary) + 1)[1:] / 4
    m.p["char"][:, 0] += _log_odds((np.concatenate([grams[begin[w]:begin[w] + size[w]] for w in e]) for e in each),
                                   labels, cfg.ngrams) / 4
    idx, first = m.windows([len(r) for r in rows], np.concatenate(rows) + 1)
    idx = idx.astype(np.int32)
    ends = np.r_[first[1:], len(idx)]
    target = np.array(labels, dtype=np.float32)
    trains = ~_validation(target, cfg.validate)
    rng = np.random.default_rng(cfg.seed)
    mean, var, step, passes = {n: 0.0 for n in m.p}, {n: 0.0 for n in m.p}, 0, 0
    best, kept, kept_logits, since = np.inf, None, None, 0
    while True:
        table = m.gates(m.vectors(f)).astype(np.float32)
        logits = np.concatenate([m.window_logits(table, idx[i:i + 4096]) for i in range(0, len(idx), 4096)])
        worst = np.array([s + int(np.argmax(logits[s:e])) for s, e in zip(first, ends, strict=True)])
        judged = ~trains if not trains.all() else trains
        loss = _cross_entropy(logits[worst][judged], target[judged])
        since += 1
        if loss < best:
            best, kept, kept_logits, since = loss, {n: x.copy() for n, x in m.p.items()}, logits[worst][judged], 0
        if step >= cfg.most or passes >= cfg.passes and step >= cfg.steps and since >= cfg.patience:
            break
        other = rng.integers(first, ends)  # a second window of each text that has label 0
        clean = trains & (target == 0)
        pick = np.r_[worst[trains], other[clean]]
        want = np.r_[target[trains], target[clean]]
        order = rng.permutation(len(pick))
        for at in range(0, len(order), cfg.batch):
            b = order[at:at + cfg.batch]
            step += 1
            for n, g in _loss_step(m, f, idx[pick[b]], want[b]).items():
                mean[n] = .9 * mean[n] + .1 * g
                var[n] = .999 * var[n] + .001 * g * g
                m.p[n] -= (cfg.rate * (mean[n] / (1 - .9 ** step)) / (np.sqrt(var[n] / (1 - .999 ** step)) + 1e-8)).astype(np.float32)
        passes += 1
    m.p = kept
    m.p["bias"] += np.float32(_bias_shift(kept_logits, target[judged]))
    return m


def _validation(target: np.ndarray, parts: int) -> np.ndarray:
    """Every ``parts``-th row of each class, unless a class has fewer rows than that."""
    out = np.zeros(len(target), dtype=bool)
    for y in (0, 1):
        rows = np.flatnonzero(target == y)
        if len(rows) < parts:
            return np.zeros(len(target), dtype=bool)
        out[rows[parts - 1::parts]] = True
    return out


def _cross_entropy(logits: np.ndarray, y: np.ndarray) -> float:
    x = logits.astype(np.float64)
    return float(np.mean(np.logaddexp(0, x) - x * y))


def _bias_shift(logits: np.ndarray, y: np.ndarray) -> float:
    """The shift of all logits under which the rows are likeliest, a little held back."""
    shifts = np.arange(-4, 4.01, 0.05)
    cost = [_cross_entropy(logits + s, y) + 0.05 * s * s / np.sqrt(len(y)) for s in shifts]
    return float(shifts[int(np.argmin(cost))])


class WordTable:
    """Gate rows of the words a worker has met, of bounded size."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self):
        self.rows: dict[str, int] = {}
        self.table = self.model.gates(np.zeros((0, self.model.cfg.dim), dtype=np.float32))

    def lookup(self, docs: list[list[str]]) -> np.ndarray:
        new = list(set().union(*docs).difference(self.rows))
        if len(self.rows) + len(new) > WORDS:
            self.clear()
            new = list(set().union(*docs))
        if new:
            x = self.model.vectors(self.model.features(new))
            base = len(self.table)
            self.table = np.concatenate([self.table, self.model.gates(x)[1:].astype(np.float32)])
            self.rows.update(zip(new, range(base, base + len(new)), strict=True))
        get = self.rows.__getitem__
        return np.array([r for d in docs for r in map(get, d)], dtype=np.int64)


_TABLES: dict[str, WordTable] = {}


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    """Scores of a few hundred texts; without words the score is 0."""
    out = np.zeros(len(texts))
    if not model.key:
        return out + model.prior
    table = _TABLES.get(model.key)
    if table is None:
        _TABLES.clear()
        table = _TABLES[model.key] = WordTable(model)
    docs = [words_of(t) for t in texts]
    have = [i for i, d in enumerate(docs) if d]
    if have:
        docs = [docs[i] for i in have]
        rows = table.lookup(docs)
        out[have] = model.score(table.table, [len(d) for d in docs], rows)
    return out


def training_sample(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str, text_col: str,
                    label_col: str, ones: int, zeros: int) -> list[tuple[str, int]]:
    """At most so many labelled rows of each class, by a hash of the id.
    Only these ids (bounded) are broadcast, only their texts reach the driver."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter(
        F.col("_id").isNotNull() & F.col("_y").isin(0, 1)).filter(allowed).groupBy("_id").agg(F.max("_y").alias("_y"))
    picked = None
    for y, most in ((0, zeros), (1, ones)):
        part = known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    rows = (docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_t"))
            .join(F.broadcast(picked), "_id").collect())
    return [(r["_t"], r["_y"]) for r in sorted(rows, key=lambda r: (r["_id"], r["_t"]))]


def held_out(id_col: str | Column, part: int = 2, parts: int = 4) -> Column:
    """Rows that training must not see: crc32 of the id as text, modulo ``parts``."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % parts == part, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "toxic", threshold: float = 0.3, cfg: Config = Config()) -> DataFrame:
    """One row per input row: id, ``held_out``, ``score``, ``predicted``.

    Labels of held-out ids are never read into training; the score sees the text
    only.  Null or empty texts score 0 (the share of ones if no model could be
    trained).  A null id is not held out; labels of null ids, or other than 0 and 1,
    are ignored; of contradicting labels 1 counts.  Equal texts score equally.  An
    empty table gives an empty result; other columns are not read.
    """
    data = training_sample(docs, labels, ~held_out("_id"), id_col, text_col, label_col, cfg.ones, cfg.zeros)
    # of a size that Config bounds: vocabulary, n-gram buckets and dimensions
    model = docs.sparkSession.sparkContext.broadcast(train([t for t, _ in data], [y for _, y in data], cfg))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), pa.array(score_texts(model.value, b.column("t").to_pylist()))], ["_id", "score"])

    schema = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType())])
    out = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("t")).mapInArrow(run, schema)
    return out.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
