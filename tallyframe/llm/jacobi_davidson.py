"""Leading eigenpairs of a symmetric operator known by its products only.

Jacobi-Davidson with a block of vectors: the operator is a function that
multiplies a block (dimension x some columns); each call may be a distributed
job, so calls are few and each works on several vectors at once.  Everything
held here is dimension x subspace; the data behind the operator never are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

Product = Callable[[np.ndarray], np.ndarray]
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Settings:
    inner_steps: int = 4        # MINRES steps of a correction at most
    inner_drop: float = 1e-3    # ... or until its residual fell so far
    block: int = 16             # corrections solved at once
    most_columns: int = 96      # of the search space before it is restarted
    tolerance: float = 64 * EPS  # of a residual, relative to the largest eigenvalue
    most_rounds: int = 500
    seed: int = 11


def project(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """``block`` without its part in the span of the orthonormal ``basis`` (twice, against rounding)."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    return block


def extend(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``block`` adds to ``basis``; dependent ones are left out."""
    out = np.zeros((len(block), 0))
    for column in block.T:
        size = np.linalg.norm(column)
        if size == 0 or not np.isfinite(size):
            continue
        both = np.hstack([basis, out])
        rest = project(both, (column / size)[:, None])
        if (left := np.linalg.norm(rest)) > 1e-8:
            rest = project(both, rest / left)
            out = np.hstack([out, rest / np.linalg.norm(rest)])
    return out


def minres(product: Product, right: np.ndarray, steps: int, drop: float) -> np.ndarray:
    """Solutions of ``product(x) = right``, a MINRES recurrence per column and one product a step for all."""
    beta = np.linalg.norm(right, axis=0)
    first = np.where(beta > 0, beta, 1)
    v, before = right / first, np.zeros_like(right)
    x, d, d_before = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    c = np.full(len(beta), 1.0)
    s = np.zeros(len(beta))
    c_before, s_before, rest, link = c.copy(), s.copy(), beta.copy(), np.zeros(len(beta))
    going = beta > 0
    for _ in range(steps):
        p = product(v)
        alpha = (v * p).sum(0)
        p = p - alpha * v - link * before
        after = np.linalg.norm(p, axis=0)
        # the new column of the tridiagonal matrix under the two last rotations and one more
        third = s_before * link
        second = c_before * link
        upper = c * second + s * alpha
        diagonal = -s * second + c * alpha
        size = np.hypot(diagonal, after)
        safe = np.where(size > 0, size, 1)
        c_now, s_now = np.where(size > 0, diagonal / safe, 1), np.where(size > 0, after / safe, 0)
        d_now = (v - upper * d - third * d_before) / safe
        x = x + np.where(going & (size > 0), c_now * rest, 0) * d_now
        rest = -s_now * rest
        going &= (np.abs(rest) > drop * beta) & (after > EPS * np.abs(alpha)) & (size > 0)
        if not going.any():
            break
        d_before, d = d, d_now
        c_before, s_before, c, s = c, s, c_now, s_now
        before, v, link = v, p / np.where(after > 0, after, 1), after
    return x


def eigenpairs(product: Product, dimension: int, wanted: int, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    A pair is locked once its residual has reached the tolerance and all
    larger ones are locked; the search goes on orthogonal to locked pairs.
    A search space that fills the whole space is solved exactly.  Locked
    pairs are checked by fresh products at the end, and sharpened among themselves.
    """
    s = settings
    wanted = min(wanted, dimension)
    most = min(dimension, max(s.most_columns, 2 * wanted + 2 * s.block))
    rng = np.random.default_rng(s.seed)
    none = np.zeros((dimension, 0))
    locked, values = none, np.zeros(0)
    space = extend(none, rng.standard_normal((dimension, min(dimension, wanted + 4))))
    image = product(space)
    largest, stalled = 0.0, 0
    for _ in range(s.most_rounds):
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        largest = max(largest, abs(theta[0]) if len(theta) else 0, *np.abs(values))
        need = wanted - len(values)
        rest = image[:, :need] - space[:, :need] * theta[:need]
        rest = project(locked, rest)
        norms = np.linalg.norm(rest, axis=0)
        done = norms <= s.tolerance * largest * max(1, np.sqrt(dimension) / 8)
        whole = space.shape[1] + locked.shape[1] >= dimension
        if whole and not done.all():
            stalled += 1        # nothing is left to search: fresh products, then the residuals are what rounding leaves
            if stalled <= 2:
                space = extend(locked, space)
                image = project(locked, product(space))
                continue
            done[:] = True
        n = len(done) if done.all() else int(np.argmin(done))
        if n:
            locked, values = np.hstack([locked, space[:, :n]]), np.append(values, theta[:n])
            space, image, theta, rest, norms = space[:, n:], project(locked, image[:, n:]), theta[n:], rest[:, n:], norms[n:]
            stalled = 0
        if len(values) == wanted:
            break
        if space.shape[1] > most - s.block:
            keep = min(space.shape[1], max(wanted - len(values) + s.block, most // 2))
            space, image = space[:, :keep], image[:, :keep]
        b = min(s.block, rest.shape[1])
        current, shift = np.hstack([locked, space[:, :b]]), theta[:b]

        def corrected(t: np.ndarray) -> np.ndarray:
            t = project(current, t)
            return project(current, product(t) - t * shift)

        step = minres(corrected, -project(current, rest[:, :b]), s.inner_steps, s.inner_drop) if b else none
        new = extend(np.hstack([locked, space]), np.hstack([step, rest[:, :b]]) if not np.abs(step).max(initial=0) else step)
        if not new.shape[1]:
            new = extend(np.hstack([locked, space]), rng.standard_normal((dimension, min(s.block, dimension))))
        if not new.shape[1]:
            continue
        space, image = np.hstack([space, new]), np.hstack([image, project(locked, product(new))])
    else:
        raise ArithmeticError(f"residuals have not reached double precision after {s.most_rounds} rounds")
    locked = extend(none, locked)
    fresh = product(locked)
    small = locked.T @ fresh
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    theta, turn = theta[::-1], turn[:, ::-1]
    left = np.linalg.norm(fresh @ turn - (locked @ turn) * theta, axis=0)
    if (left > 1e3 * s.tolerance * max(largest, 1e-300)).any():
        raise ArithmeticError(f"residuals of {left.max():.2g} remain")
    return theta, locked @ turn
