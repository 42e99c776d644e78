"""Operator 1: quality classifier, a factorisation machine.

Features of a document: hashed words (share of the document's words per
bucket), structure statistics (shares of symbols, capitals, digits, repeated
words and lines, ...) and the text's own metadata (its length in bytes and
words), the last two dealt into quantile bins.  Each feature has a weight and a vector
of ``rank`` numbers; the score is the logistic of

    w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

so all pairwise interactions cost time linear in the features.  It is fitted
by Adagrad in numpy on a bounded sample of labelled rows
(``Settings.max_rows``) and broadcast (its size is fixed by the settings).

Defined cases: a null or empty text has no words and is scored from its
statistics; with no usable labels, or one class only, every score is the
share of class 1 (0.5 without labels).  Repeated rows give repeated results;
an empty table gives an empty result; extra columns are not read.
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
from tallyframe.llm.quality_rules import count_text

FOLDS, HELD = 3, 1


@dataclass(frozen=True)
class Settings:
    max_rows: int = 6000     # labelled documents used for fitting, at most
    word_bits: int = 16
    rank: int = 8
    bins: int = 8
    epochs: int = 20
    rate: float = 0.25
    decay: float = 1e-5
    seed: int = 11


def word_features(data: np.ndarray, off: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, share of the document's words) of each distinct bucket of each document."""
    s, e, doc = A.word_bounds(data, off)
    bucket = A.run_hashes(A.LOWER[data], s, e) >> A.U64(64 - bits)
    key = np.sort((doc.astype(A.U64) << A.U64(bits)) | bucket)
    first = A.group_starts(key)
    count = np.diff(np.r_[first, len(key)])
    key = key[first]
    d = (key >> A.U64(bits)).astype(np.int64)
    total = np.maximum(np.bincount(doc, minlength=len(off) - 1), 1)
    return d, (key & A.U64((1 << bits) - 1)).astype(np.int64), (count / total[d]).astype(np.float32)


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Structure statistics and metadata, one row per document."""
    n = len(off) - 1
    share = lambda mask: np.diff(np.r_[0, np.cumsum(mask, dtype=np.int64)][off])
    c = count_text(data, off)
    s, e, doc = A.word_bounds(data, off)
    h = A.run_hashes(data, s, e)
    same = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) if len(h) else np.zeros(0, np.int64)
    key = np.sort((doc.astype(A.U64) << A.U64(40)) | (h >> A.U64(24)))
    distinct = np.bincount((key[A.group_starts(key)] >> A.U64(40)).astype(np.int64), minlength=n)
    size, words = np.maximum(np.diff(off), 1), np.maximum(c["n_words"], 1)
    upper = share((data >= 65) & (data <= 90))
    letters = np.maximum(share(((data | 32) >= 97) & ((data | 32) <= 122)), 1)
    return np.stack([
        np.log1p(np.diff(off)), np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words,
        c["n_repeat_words"] / words, c["n_dup_lines"] / np.maximum(share(data == 10) + 1, 1),
        np.bincount(doc[same], minlength=n) / words, distinct / words, upper / letters,
        share((data >= 48) & (data <= 57)) / size, share(data == 124) / words, share(data == 33) / words,
        share(data == 10) / words, share((data == 46) | (data == 44)) / words], axis=1)


def features(batches: Iterator[pa.RecordBatch], bits: int):
    """(batch, first, last, word features, statistics) of each slice."""
    for batch in batches:
        data, off = A.text_bytes(batch.column("text"))
        for i, j in A.slices(off):
            part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
            yield batch, i, j, word_features(part, o, bits), statistics(part, o)


@dataclass
class Machine:
    """A fitted machine; ``cuts``: bin limits of each statistic."""

    cuts: np.ndarray
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    bits: int

    def rows(self, words: tuple[np.ndarray, np.ndarray, np.ndarray], stats: np.ndarray):
        """All features of the documents: (document, feature, value), sorted by document."""
        n, k = stats.shape
        width = self.cuts.shape[1] + 1
        binned = np.stack([np.searchsorted(self.cuts[j], stats[:, j], side="right") + j * width for j in range(k)], axis=1) + (1 << self.bits)
        d = np.r_[words[0], np.repeat(np.arange(n), k)]
        order = np.argsort(d, kind="stable")
        return d[order], np.r_[words[1], binned.ravel()][order], np.r_[words[2], np.full(n * k, 1 / np.sqrt(k), np.float32)][order].astype(np.float32)

    def terms(self, d, f, x):
        """Raw score of each document, and the sums that its gradient needs."""
        first = A.group_starts(d)
        vx = self.factor[f] * x[:, None]
        total = np.add.reduceat(vx, first, axis=0)
        pairs = 0.5 * (total**2 - np.add.reduceat(vx**2, first, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weight[f] * x, first) + pairs, total

    def score(self, words, stats) -> np.ndarray:
        if not len(stats):
            return np.zeros(0)
        raw, _ = self.terms(*self.rows(words, stats))
        return 1 / (1 + np.exp(-np.clip(raw, -40, 40)))


def fit(docs: list[tuple[tuple[np.ndarray, np.ndarray], np.ndarray, int]], s: Settings) -> Machine:
    """Adagrad on logistic loss over (word buckets and shares, statistics, label) of each document."""
    labels = np.array([y for _, _, y in docs])
    share = labels.mean() if len(labels) else 0.5
    stats = np.array([st for _, st, _ in docs]) if docs else np.zeros((1, 14))
    cuts = np.quantile(stats, np.linspace(0, 1, s.bins + 1)[1:-1], axis=0).T
    size = (1 << s.word_bits) + cuts.shape[0] * s.bins
    rng = np.random.default_rng(s.seed)
    share = min(max(share, 1e-3), 1 - 1e-3)
    m = Machine(cuts, float(np.log(share / (1 - share))), np.zeros(size, np.float32), np.zeros((size, s.rank), np.float32), s.word_bits)
    if len(set(labels.tolist())) < 2:
        return m
    m.factor = rng.normal(0, 0.05, (size, s.rank)).astype(np.float32)
    gw, gv, gb = np.full(size, 1e-2, np.float32), np.full((size, s.rank), 1e-2, np.float32), 1e-2
    for _ in range(s.epochs):
        order = rng.permutation(len(docs))
        for a in range(0, len(order), 64):
            pick = order[a : a + 64]
            words = (np.repeat(np.arange(len(pick)), [len(docs[i][0][0]) for i in pick]),
                     np.concatenate([docs[i][0][0] for i in pick]), np.concatenate([docs[i][0][1] for i in pick]))
            d, f, x = m.rows(words, stats[pick])
            raw, total = m.terms(d, f, x)
            err = ((1 / (1 + np.exp(-np.clip(raw, -40, 40)))) - labels[pick]) / len(pick)
            g = (err[d] * x).astype(np.float32)
            used, back = _distinct(f)
            w_grad = np.bincount(back, g, len(used)) + s.decay * m.weight[used]
            grad = g[:, None] * (total[d] - m.factor[f] * x[:, None])
            v_grad = np.stack([np.bincount(back, grad[:, r], len(used)) for r in range(s.rank)], axis=1) + s.decay * m.factor[used]
            gw[used] += w_grad**2
            gv[used] += v_grad**2
            gb += err.sum() ** 2
            m.weight[used] -= s.rate * w_grad / np.sqrt(gw[used])
            m.factor[used] -= s.rate * v_grad / np.sqrt(gv[used])
            m.bias -= s.rate * err.sum() / np.sqrt(gb)
    return m


def _distinct(f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(f, kind="stable")
    first = A.group_starts(f[order])
    back = np.empty(len(f), np.int64)
    back[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(f)]))
    return f[order][first], back


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Machine:
    """Fit on the labelled rows outside the held-out fold, at most ``s.max_rows`` of them."""

    def run(batches):
        for batch, i, j, (d, f, x), stats in features(batches, s.word_bits):
            edge = np.searchsorted(d, np.arange(j - i + 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                 pa.array([f[a:b].astype("<u4").tobytes() for a, b in zip(edge, edge[1:], strict=False)], pa.binary()),
                 pa.array([x[a:b].astype("<f4").tobytes() for a, b in zip(edge, edge[1:], strict=False)], pa.binary()),
                 pa.array([r.astype("<f8").tobytes() for r in stats], pa.binary())],
                names=["doc_id", "label", "f", "x", "stats"])

    rows = (training_rows(docs, labels, "quality", FOLDS, HELD, s.max_rows)
            .mapInArrow(run, "doc_id long, label int, f binary, x binary, stats binary").collect())
    rows.sort(key=lambda r: (r.doc_id, r.f))
    return fit([((np.frombuffer(r.f, "<u4").astype(np.int64), np.frombuffer(r.x, "<f4")), np.frombuffer(r.stats, "<f8"), r.label) for r in rows], s)


def quality_scores(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        m = model.value
        for batch, i, j, words, stats in features(batches, m.bits):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(m.score(words, stats).astype(np.float64))], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", fold("doc_id", FOLDS, HELD).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
