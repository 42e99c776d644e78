"""Operators 1, 6 and 8: held-out accuracy, brute force, defined cases."""

import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard
from texts import corpus, prose

from tallyframe.llm import quality_fm, quality_rules, toxicity

INSULTS = ["moronic", "idiotic", "scumbag"]


def held(i, folds, rest):
    return i is not None and zlib.crc32(str(i).encode()) % folds == rest


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randrange(20, 200)).split(" ")
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", ",", "!"])
        good = i % 3 != 0
        if not good:
            words = [w.upper() + "!!" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame(labels + [(None, 1, 1), (9999, None, None), labels[0]], "doc_id long, quality int, toxic int")


def test_toxicity(spark, make, labelled):
    rows, labels = labelled
    extra = [(1001, None), (1002, ""), (1003, "you m0ronic w1 w2 moronicc"), (1004, "w1 w2 w3"), (None, "scumbag")]
    docs = make(rows + extra)
    model = toxicity.train(docs, label_frame(spark, labels), toxicity.Settings(min_docs=1))
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, model).collect()}
    truth = {i: t for i, _, t in labels}
    test = [i for i in truth if held(i, 4, 2)]
    assert all(got[i].held_out for i in test) and sum(r.held_out for r in got.values()) >= len(test)
    assert np.mean([got[i].predicted == truth[i] for i in test]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert not got[1001].predicted and got[1001].score == got[1002].score
    assert got[1003].predicted and not got[1004].predicted and got[None].predicted and not got[None].held_out
    kept = {r.doc_id for r in toxicity.reject(docs, model).collect()}
    assert kept == {i for i, r in got.items() if r.score < 0.3}
    assert toxicity.reject(docs, model).columns == docs.columns


def test_quality(spark, make, labelled):
    rows, labels = labelled
    docs = make(rows + [(1001, None), (1002, ""), (None, "w1 w2")])
    model = quality_fm.train(docs, label_frame(spark, labels))
    got = {r.doc_id: r for r in quality_fm.quality_scores(docs, model).collect()}
    truth = {i: q for i, q, _ in labels}
    test = [i for i in truth if held(i, 3, 1)]
    assert np.mean([got[i].predicted == truth[i] for i in test]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())
    assert got[1001].score == got[1002].score and not got[None].held_out


@pytest.mark.parametrize("module,constant", [(quality_fm, 0.5), (toxicity, 0.0)])
def test_without_labels(spark, make, module, constant):
    docs = make([(1, "some words"), (2, None)])
    model = module.train(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    score = module.quality_scores if module is quality_fm else module.toxicity_scores
    assert [r.score for r in score(docs, model).collect()] == pytest.approx([constant] * 2)
    assert score(make([]), model).collect() == []


def test_sum_of_squares_identity():
    """The linear-time pairwise term equals the sum over pairs."""
    rng = np.random.default_rng(0)
    m = quality_fm.Machine(np.zeros((2, 3)), 0.1, rng.normal(size=64 + 8).astype(np.float32), rng.normal(size=(72, 4)).astype(np.float32), 6)
    words = (np.array([0, 0, 1]), np.array([3, 9, 60]), np.array([0.25, 0.75, 1.0], np.float32))
    d, f, x = m.rows(words, np.array([[0.5, -1.0], [2.0, 0.0]]))
    raw, _ = m.terms(d, f, x)
    for doc in (0, 1):
        ff, xx = f[d == doc], x[d == doc]
        slow = m.bias + sum(m.weight[i] * v for i, v in zip(ff, xx))
        slow += sum(float(m.factor[ff[i]] @ m.factor[ff[j]]) * xx[i] * xx[j] for i in range(len(ff)) for j in range(i))
        assert raw[doc] == pytest.approx(slow, abs=1e-4)


def rules(text, bands):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    again = {p for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for p in range(k, k + 3)}
    failed = len(w) < 50 or 100 * len(again) > 50 * len(w)
    z, raw = zstandard.ZstdCompressor(level=bands.level), text.encode()
    limits = [(lo, hi) for least, lo, hi in bands.whole if len(raw) >= least]
    fine = not limits or limits[-1][0] <= len(z.compress(raw)) / len(raw) <= limits[-1][1]
    size = bands.chunk_bytes
    parts = [raw[a : a + size] for a in range(0, len(raw), size) if len(raw[a : a + size]) * 2 >= size]
    bad = sum(not bands.chunk[0] <= len(z.compress(p)) / len(p) <= bands.chunk[1] for p in parts)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed,
            not failed and fine and bad <= bands.bad_share * len(parts))


def test_quality_rules(make):
    rng = random.Random(2)
    odd = [(500, "x| y <z> *** \n\nline\nline\nline \n\t\n"), (501, "é ü ☃ " * 30), (502, "a b c " * 400),
           (503, " ".join("".join(rng.choice(string.ascii_letters + string.digits) for _ in range(30)) for _ in range(400))), (504, prose(rng, 30_000)), (505, "\n".join(["same line here"] * 80)),
           (506, " ".join(prose(rng, 60) for _ in range(4)) + "\x0b\x0c x"), (507, "ab" * 60_000), (508, None)]
    rows = corpus(9) + odd
    bands = quality_rules.Bands()
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = sorted((tuple(r[c] for c in cols) for r in quality_rules.quality_rules(make(rows)).collect()), key=str)
    assert got == sorted(((i, *rules(t, bands)) for i, t in rows), key=str)
    verdict = {r[0]: r[-1] for r in got}
    assert not verdict[503] and not verdict[502] and verdict[504]
    kept = quality_rules.reject(make(rows))
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((r[0] for r in got if r[-1]), key=str)
    assert quality_rules.quality_rules(make([])).collect() == []
