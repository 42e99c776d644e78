"""Operator 11 against dense linear algebra, and its eigenvalue solver on its own."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import jacobi_davidson as JD
from tallyframe.llm import whitening as W


@pytest.mark.parametrize("d,kind", [(1, "spread"), (5, "spread"), (64, "spread"), (64, "fourfold"), (64, "rank 3"), (300, "close"), (20, "zero")])
def test_solver(d, kind):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    e = {"spread": rng.random(d) * 100, "fourfold": np.repeat(np.arange(1.0, 17), 4)[:d], "rank 3": np.r_[5, 3, 2, np.zeros(max(0, d - 3))][:d],
         "close": 1 + rng.random(d) * 0.3, "zero": np.zeros(d)}[kind]
    v = (q * e) @ q.T
    calls = []
    values, vectors = JD.eigenpairs(lambda b: calls.append(b.shape) or v @ b, d, 16)
    k = min(16, d)
    assert np.allclose(values, np.sort(e)[::-1][:k], rtol=0, atol=1e-12 * max(1, e.max()))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-13
    assert np.linalg.norm(v @ vectors - vectors * values, axis=0).max() <= 1e-12 * max(e.max(), 1)
    assert max(c for _, c in calls) < max(d, 33)


def test_minres_solves():
    rng = np.random.default_rng(1)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    b = rng.standard_normal((30, 4))
    b[:, 2] = 0
    assert np.allclose(a @ JD.minres(lambda v: a @ v, b, 60, 1e-14), b, atol=1e-7)


def by_hand(rows, most=16):
    keep = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) and abs(c) < 2.0**50 for c in v)]
    x = {i: [] for i, _ in keep}
    for i, v in keep:
        x[i].append(tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v))
    fit = {v for vs in x.values() for v in vs}
    d = max({len(v) for v in fit}, key=lambda n: (sum(len(v) == n for v in fit), n))
    fit = sorted(v for v in fit if len(v) == d)
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    e, p = np.linalg.eigh(z.T @ z / n)
    e, p = e[::-1], p[:, ::-1]
    k = min(most, d, int((e > d * 2.3e-16 * e[0]).sum()))
    out = {}
    for i, vs in x.items():
        out[i] = []
        for v in vs:
            if len(v) == d:
                c = np.array([(n * a - s) / n for a, s in zip(v, sums)])
                out[i].append((n, sum((n * a - s) ** 2 for a, s in zip(v, sums)), (c @ p / np.sqrt(np.abs(e)))[:k], (e / e.sum())[:k]))
    return {i: v for i, v in out.items() if v}


def frame(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)
    return df.select("*", *[F.lit("x").alias(c) for c in ("label", "n", "component", "__vec", "rows", "payload", "cell")])


def vectors(seed, n, d):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 1 + 5 / (j + 1)) for j in range(d)]) for i in range(n)]
    out += [(n + i, out[i % 3][1]) for i in range(40)]                       # copies count once in the fit
    out += [(9001, None), (9002, []), (9003, [1.0] * (d - 1) + [None]), (9004, [math.nan] * d), (9005, [math.inf] + [0.0] * (d - 1)), (9006, [0.5] * (d + 1)),
            (9007, [1e30] * d)]
    return out + [(5, [9.0] * d), (5, [9.0] * d)]                            # one id, several vectors


@pytest.mark.parametrize("seed,n,d", [(1, 300, 24), (2, 90, 5), (3, 7, 12)])
def test_against_dense(spark, seed, n, d):
    rows = vectors(seed, n, d)
    want = by_hand(rows)
    got = {}
    for r in W.whiten(frame(spark, rows), W.Settings(block_rows=64)).collect():
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    k = len(next(iter(want.values()))[0][2])
    seen = {(i, w[1]) for i, ws in want.items() for w in ws}
    assert set(got) == seen
    signs = {}
    for i, ws in want.items():
        for n_, dev, white, share in ws:
            g = got[i, dev]
            assert sorted(g) == list(range(1, k + 1))
            for c in range(1, k + 1):
                for r in g[c]:
                    assert r.n == n_ and r.explained == pytest.approx(share[c - 1], rel=1e-9) and r.identity_error < 1e-9
                    if abs(white[c - 1]) > 1e-6:
                        signs.setdefault(c, set()).add(round(r.whitened / white[c - 1], 6))
    assert all(s <= {1.0} or s <= {-1.0} for s in signs.values())


def test_few_and_none(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    assert W.whiten(frame(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    out = W.whiten(frame(spark, [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (None, [1.0, 0.0])])).collect()
    assert {(r.vec_id, r.component, abs(round(r.whitened, 9)), r.n, r.deviation) for r in out} == {(1, 1, 1.0, 2, 4096), (2, 1, 1.0, 2, 4096), (None, 1, 1.0, 2, 4096)}


def test_deviations_are_exact():
    x = np.array([[10**6 + 3, 10**6 - 5], [10**6 + 2**40, 10**6]])
    for n in (7, 10**6, 10**9, 3 * 10**9, 10**13):
        sums = [n * 10**6 + 3, n * 10**6 - n // 3]
        want = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
        assert W.deviations(x, n, sums) == [w if w < 2**63 else None for w in want]
        assert W.deviations(x[:1], n, sums) == [want[0] if want[0] < 2**63 else None]
