"""Operator 6: toxicity, subword-bag embeddings and a linear softmax.

A word (run of ASCII letters and digits or non-ASCII bytes, lower-cased A-Z)
is the bag of its character n-grams, ends marked; its vector is the average
of their embeddings, and a linear softmax turns the vector into class
probabilities.  Embeddings and softmax are trained jointly in numpy, on
words weighted by how many toxic and clean labelled documents hold them; a
misspelling that was never seen still shares most of its n-grams with the
word it stands for.  A document's vector is the average over its words; the
softmax is linear, so its log-odds are the average of its words' log-odds.
The document's own softmax, fitted on documents, has that average as its
first input, the most toxic word as its second, so that one insult in a long
text is not averaged away, and the logarithm of the number of words as its
third, since the largest of many words is larger by chance.

Fitting uses at most ``Settings.max_rows`` labelled documents; word counts
are taken by Spark and only words found in ``min_docs`` of those documents
reach the trainer.  Those documents are stored once, so training reads the
corpus once.  Further rounds add the words that decide each document
under the model so far, so that words which merely happen to stand in toxic
documents are pushed down.  The model's size is fixed by the settings.

Defined cases: null, empty and word-less texts hold nothing toxic and score
0; with no usable labels, or without both classes, the
score of every text is the share of toxic labels (0.0 without labels), so nothing is
rejected for want of evidence unless the labels say so.  Repeated rows give
repeated results; an empty table gives an empty result; extra columns are
not read by the scores and are carried through by ``reject``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import arrays as A
from tallyframe.llm.labelled import fold, training_rows
from tallyframe.llm.shared import stored

FOLDS, HELD, LIMIT = 4, 2, 0.3

PART = np.zeros(256, bool)
PART[128:] = True
PART[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class Settings:
    max_rows: int = 12000    # labelled documents used for fitting, at most
    bits: int = 17
    dims: int = 8
    grams: tuple[int, ...] = (3, 4, 5)
    min_docs: int = 2
    epochs: int = 8
    batch: int = 512
    rate: float = 0.3
    decay: float = 1e-3
    rounds: int = 2          # further rounds, on the words that decide each document
    mined: int = 8           # such words taken from a clean document (one from a toxic one)
    mined_weight: float = 4.0
    seed: int = 5


def spaced(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes with one blank before, between and after documents and for every
    separator; start, end and document of each word in it."""
    n = len(off) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    at = np.arange(len(data)) + np.repeat(np.arange(n), np.diff(off)) + 1
    out[at] = np.where(PART[data], A.LOWER[data], 32)
    black = np.r_[False, out != 32, False]
    s, e = np.flatnonzero(black[1:-1] & ~black[:-2]), np.flatnonzero(black[1:-1] & ~black[2:]) + 1
    return out, s, e, np.searchsorted(off[1:] + np.arange(1, n + 1), s, side="right")


def unique_words(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words as (bytes with a blank around each, offsets), and the number of each word's distinct form."""
    h = A.run_hashes(data, s, e)
    order = np.argsort(h, kind="stable")
    first = A.group_starts(h[order])
    back = np.empty(len(h), np.int64)
    back[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(h)]))
    pick = order[first]
    size = e[pick] - s[pick] + 1
    off = np.r_[0, np.cumsum(size)]
    src = np.arange(off[-1]) - np.repeat(off[:-1] - s[pick], size)
    return np.r_[np.uint8(32), data[src]], off, back


def gram_bags(text: np.ndarray, off: np.ndarray, grams: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, bucket) of every n-gram of blank-separated words, sorted by word; each word gets at least one."""
    n = len(off) - 1
    owner = np.repeat(np.arange(n), np.diff(off))
    words, buckets = [], []
    up, down = A.BYTE_POW.upto(len(text) + 1)
    sums = np.zeros(len(text) + 1, A.U64)
    np.cumsum(A.BYTE_VALUE[text] * up[: len(text)], out=sums[1:])
    size = np.diff(off) - 1
    for g in grams:
        m = len(text) - g + 1
        if m <= 0:
            continue
        # position p of the text is the blank before, or a byte of, word owner[p]
        p = np.flatnonzero(np.arange(len(text) - 1) + g <= off[1:][owner] + 1) if len(owner) else np.zeros(0, np.int64)
        p = p[p < m]
        words.append(owner[p])
        buckets.append(A.mix((sums[p + g] - sums[p]) * down[p], g) >> A.U64(64 - bits))
    short = np.flatnonzero(size + 2 < min(grams))
    words.append(short)
    buckets.append(A.mix(text[off[short] + 1].astype(A.U64), 1) >> A.U64(64 - bits) if len(short) else np.zeros(0, A.U64))
    w, b = np.concatenate(words), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(w, kind="stable")
    return w[order], b[order]


@dataclass
class Model:
    """``gram``: each n-gram's toxic log-odds (its embedding times the softmax difference),
    averaged per word; ``weights`` and ``shift``: the document's softmax over its features."""

    gram: np.ndarray
    bias: float
    weights: np.ndarray
    shift: float
    settings: Settings
    constant: float | None = None

    def word_odds(self, text: np.ndarray, off: np.ndarray) -> np.ndarray:
        w, b = gram_bags(text, off, self.settings.grams, self.settings.bits)
        n = len(off) - 1
        return self.bias + np.bincount(w, self.gram[b], n) / np.maximum(np.bincount(w, minlength=n), 1)

    def deciding(self, data: np.ndarray, off: np.ndarray, most: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """(document, word) of each document's most toxic distinct words, ``most`` of each."""
        text, s, e, doc = spaced(data, off)
        if not len(s):
            return
        u, uo, back = unique_words(text, s, e)
        odds, raw = self.word_odds(u, uo), u.tobytes()
        key = np.unique(doc * np.int64(len(odds)) + back)
        d, w = key // len(odds), key % len(odds)
        order = np.lexsort((w, -odds[w], d))
        d, w = d[order], w[order]
        rank = np.arange(len(d)) - np.repeat(A.group_starts(d), np.diff(np.r_[A.group_starts(d), len(d)]))
        for k in np.flatnonzero(rank < most[d]):
            yield int(d[k]), raw[uo[w[k]] + 1 : uo[w[k] + 1]]

    def features(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Per document: average log-odds of its words, those of its most toxic word, logarithm of 1 + its words."""
        n = len(off) - 1
        out = np.zeros((n, 3))
        text, s, e, doc = spaced(data, off)
        if len(s):
            u, uo, back = unique_words(text, s, e)
            odds, first = self.word_odds(u, uo)[back], A.group_starts(doc)
            many = np.diff(np.r_[first, len(doc)])
            out[doc[first]] = np.stack([np.add.reduceat(odds, first) / many, np.maximum.reduceat(odds, first), np.log1p(many)], axis=1)
        return out

    def score(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(off) - 1, self.constant)
        x = self.features(data, off)
        return np.where(x[:, 2] > 0, 1 / (1 + np.exp(-np.clip(x @ self.weights + self.shift, -40, 40))), 0.0)


class Trainer:
    """Embeddings and softmax, trained jointly by Adagrad on the weighted cross entropy."""

    def __init__(self, s: Settings):
        self.s, self.rng = s, np.random.default_rng(s.seed)
        self.embed = self.rng.normal(0, 0.3, (1 << s.bits, s.dims)).astype(np.float32)
        self.soft, self.bias = self.rng.normal(0, 0.3, (2, s.dims)), np.zeros(2)
        self.g_embed = np.full(self.embed.shape, 1e-3, np.float32)
        self.g_soft, self.g_bias = np.full(self.soft.shape, 1e-3), np.full(2, 1e-3)

    def fit(self, words: list[bytes], toxic: np.ndarray, clean: np.ndarray, epochs: int) -> None:
        """Some passes over words held by so many toxic and clean documents."""
        s = self.s
        raw = b" " + b" ".join(words) + b" "
        w, b = gram_bags(np.frombuffer(raw, np.uint8), np.r_[0, np.cumsum([len(x) + 1 for x in words])], s.grams, s.bits)
        edge = np.searchsorted(w, np.arange(len(words) + 1))
        y = np.stack([clean, toxic], axis=1) / (clean + toxic)[:, None]
        weight = np.sqrt(clean + toxic)
        for _ in range(epochs):
            order = self.rng.permutation(len(words))
            for a in range(0, len(order), s.batch):
                pick = np.sort(order[a : a + s.batch])
                span = edge[pick + 1] - edge[pick]
                start = np.cumsum(span) - span
                src = np.arange(span.sum()) - np.repeat(start - edge[pick], span)
                gram, row = b[src], np.repeat(np.arange(len(pick)), span)
                mean = np.add.reduceat(self.embed[gram], start, axis=0) / span[:, None]
                z = mean @ self.soft.T + self.bias
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                err = (p - y[pick]) * weight[pick][:, None] / weight[pick].sum()
                grad = (err @ self.soft / span[:, None]).astype(np.float32)[row]
                by_gram = np.argsort(gram, kind="stable")
                first = A.group_starts(gram[by_gram])
                used = gram[by_gram][first]
                step = np.add.reduceat(grad[by_gram], first, axis=0) * s.batch**0.5 + s.decay * self.embed[used]
                soft_step, bias_step = err.T @ mean, err.sum(axis=0)
                self.g_embed[used] += step**2
                self.g_soft += soft_step**2
                self.g_bias += bias_step**2
                self.embed[used] -= s.rate * step / np.sqrt(self.g_embed[used])
                self.soft -= s.rate * soft_step / np.sqrt(self.g_soft)
                self.bias -= s.rate * bias_step / np.sqrt(self.g_bias)

    def model(self) -> Model:
        odds = (self.embed @ (self.soft[1] - self.soft[0])).astype(np.float64)
        return Model(odds, float(self.bias[1] - self.bias[0]), np.zeros(3), 0.0, self.s)


def fit_softmax(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Two-class softmax over document features by Newton's method with a small ridge: (weights, shift)."""
    mean, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.c_[(x - mean) / spread, np.ones(len(x))]
    beta, ridge = np.zeros(z.shape[1]), np.full(z.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-6)[:, None]) + np.diag(ridge), z.T @ (p - y) + ridge * beta)
        beta = beta - np.clip(step, -2, 2)
    weights = beta[:-1] / spread
    return weights, float(beta[-1] - weights @ mean)


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on the labelled rows outside the held-out fold, at most ``s.max_rows`` of them."""
    rows = stored(training_rows(docs, labels, "toxic", FOLDS, HELD, s.max_rows))

    def words(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            data, off = A.text_bytes(batch.column(1))
            label = batch.column(2).to_numpy()
            for i, j in A.slices(off):
                text, st, en, doc = spaced(data[off[i] : off[j]], off[i : j + 1] - off[i])
                h = A.run_hashes(text, st, en)
                order = np.lexsort((h, doc))
                pick = order[A.group_starts(doc[order], h[order])]
                t = label[i:j][doc[pick]]
                raw = text.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([raw[a:b] for a, b in zip(st[pick], en[pick], strict=True)], pa.binary()), pa.array(t.astype(np.int64)), pa.array(1 - t.astype(np.int64))], names=["word", "toxic", "clean"])

    counted = (rows.mapInArrow(words, "word binary, toxic long, clean long").groupBy("word")
               .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where(F.col("toxic") + F.col("clean") >= s.min_docs).toArrow())
    share = rows.agg(F.avg("__tf_label")).first()[0]
    table = sorted(zip(*(counted.column(k).to_pylist() for k in ("word", "toxic", "clean")), strict=True))
    if share is None or share in (0.0, 1.0) or not table:
        return Model(np.zeros(1 << s.bits), 0.0, np.zeros(3), 0.0, s, constant=float(share or 0.0))
    trainer, context = Trainer(s), docs.sparkSession.sparkContext
    trainer.fit([r[0] for r in table], np.array([r[1] for r in table], float), np.array([r[2] for r in table], float), s.epochs)
    for _ in range(s.rounds):
        shared = context.broadcast(trainer.model())

        def decide(batches, shared=shared):
            for batch in batches:
                data, off = A.text_bytes(batch.column(1))
                label = batch.column(2).to_numpy()
                for i, j in A.slices(off):
                    got = list(shared.value.deciding(data[off[i] : off[j]], off[i : j + 1] - off[i], np.where(label[i:j] == 1, 1, s.mined)))
                    toxic = np.array([label[i + d] for d, _ in got], np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([w for _, w in got], pa.binary()), pa.array(toxic), pa.array(1 - toxic)], names=["word", "toxic", "clean"])

        mined = (rows.mapInArrow(decide, "word binary, toxic long, clean long").groupBy("word")
                 .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).toArrow())
        both = {w: (x, y) for w, x, y in table}
        for w, x, y in zip(*(mined.column(k).to_pylist() for k in ("word", "toxic", "clean")), strict=True):
            x0, y0 = both.get(w, (0, 0))
            both[w] = (x0 + s.mined_weight * x, y0 + s.mined_weight * y)
        again = sorted((w, *v) for w, v in both.items())
        trainer.fit([r[0] for r in again], np.array([r[1] for r in again], float), np.array([r[2] for r in again], float), max(1, s.epochs // 2))
    model = trainer.model()
    shared = context.broadcast(model)

    def features(batches):
        for batch in batches:
            data, off = A.text_bytes(batch.column(1))
            for i, j in A.slices(off):
                x, label = shared.value.features(data[off[i] : off[j]], off[i : j + 1] - off[i]), batch.column(2).slice(i, j - i)
                some = pa.array(x[:, 2] > 0)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in x.T), label], names=["mean", "worst", "words", "label"]).filter(some)

    seen = rows.mapInArrow(features, "mean double, worst double, words double, label int").toArrow()     # max_rows rows of numbers
    x = np.stack([seen.column(k).to_numpy() for k in ("mean", "worst", "words")], axis=1)
    y = seen.column("label").to_numpy().astype(float)
    order = np.lexsort((y, *x.T))
    model.weights, model.shift = fit_softmax(x[order], y[order])
    return model


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, off = A.text_bytes(batch.column(1))
            for i, j in A.slices(off):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(shared.value.score(data[off[i] : off[j]], off[i : j + 1] - off[i]))], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", fold("doc_id", FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: Model, limit: float = LIMIT) -> DataFrame:
    """The documents scored below ``limit``, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, off = A.text_bytes(batch.column("text"))
            for i, j in A.slices(off):
                score = shared.value.score(data[off[i] : off[j]], off[i : j + 1] - off[i])
                yield batch.slice(i, j - i).filter(pa.array(score < limit))

    return docs.mapInArrow(run, docs.schema)
