"""Embedding whitening with components from Jacobi-Davidson (operator 11).

Vectors become whole numbers (``floor(64 * entry) + 1000000``), so counts,
sums and squared deviations are exact.  The components are the leading
eigenvectors of the covariance over the *distinct* vectors, which is never
formed: :func:`~tallyframe.llm.jacobi_davidson.eigenpairs` asks for products
with blocks of vectors, and each product is one Spark job over the centred
distinct vectors that returns dimension x columns numbers.

Scale: the distinct vectors are found by a shuffle on the vector (equal ones
combine before it), packed into blocks of rows and written once to the shared
folder; each product reads them once.  The driver holds dimension x subspace
numbers, whatever the number of vectors.

Precision: entries are taken relative to the whole number nearest their mean
before anything is rounded, and the rest of the mean is an exact fraction
rounded once, so centring loses nothing to the offset of a million.

Defined cases: rows whose vector is null, empty, or holds null or non-finite
entries, or entries of magnitude 2**50 or more (whose product with 64 is not
exact beside the offset), are left out; of vectors of several lengths the
most frequent length among the distinct vectors counts (ties: the longest),
the others are left out.  Repeated rows are returned each; a null id is
returned as null.  Components whose eigenvalue is zero to double precision
have no whitened value and are left out, so a table of equal vectors, one
vector or an empty table gives no rows.  A squared deviation beyond 64 bits
is null.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import jacobi_davidson as JD
from tallyframe.llm.shared import stored

VEC = "__vec"
BLOCKS = "rows int, payload binary"
_BLOCKS = pa.schema([("rows", pa.int32()), ("payload", pa.binary())])
SAFE = 2.0**62


@dataclass(frozen=True)
class Settings:
    components: int = 16
    scale: int = 64
    offset: int = 1_000_000
    most_entry: float = 2.0**50
    block_rows: int = 4096
    solver: JD.Settings = field(default_factory=JD.Settings)


@dataclass(frozen=True)
class Whitening:
    """The fitted map: exact count and sums, components as columns, their eigenvalues and shares."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    settings: Settings

    @property
    def dimension(self) -> int:
        return len(self.sums)


def whole_vectors(rows: DataFrame, embedding: str, settings: Settings) -> DataFrame:
    """The rows that take part, with their vector of whole numbers (array of longs) in ``__vec``."""
    s = settings
    entries = F.transform(F.col(embedding), lambda c: c.cast("double"))
    good = F.coalesce(F.forall(entries, lambda c: F.coalesce(F.abs(c) < s.most_entry, F.lit(False))) & (F.size(entries) > 0), F.lit(False))
    whole = F.transform(entries, lambda c: F.floor(c * float(s.scale)).cast("bigint") + F.lit(s.offset).cast("bigint"))
    return rows.where(good).withColumn(VEC, whole)


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """An array-of-longs column, all of one length, as rows x dimension."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def packed(distinct: DataFrame, dimension: int, block_rows: int) -> DataFrame:
    """The vectors as blocks of at most ``block_rows`` rows, each one binary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(0), dimension)
            for i in range(0, len(x), block_rows):
                part = np.ascontiguousarray(x[i : i + block_rows])
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([part.tobytes()], pa.binary())], schema=_BLOCKS)

    return distinct.mapInArrow(run, BLOCKS)


def unpacked(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[np.ndarray]:
    for b in batches:
        for payload in b.column("payload"):
            yield np.frombuffer(payload.as_buffer(), np.int64).reshape(-1, dimension)


def summed(blocks: DataFrame, fn, cells: int) -> np.ndarray:
    """Sum over all tasks of the float vector (``cells`` long) that ``fn`` makes of a task's blocks; one row per cell arrives."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = fn(batches)
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells), pa.int32()), pa.array(out, pa.float64())], names=["cell", "part"])

    parts = blocks.mapInArrow(run, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("total"))
    got = np.zeros(cells)
    for r in parts.collect():               # dimension x columns numbers
        got[r.cell] = r.total
    return got


def moments(blocks: DataFrame, dimension: int) -> tuple[int, list[int], int]:
    """Exact number of vectors, sums per dimension and sum of all squares, as Python integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, [0] * dimension, 0
        for x in unpacked(batches, dimension):
            n += len(x)
            small = float(np.abs(x).max(initial=0)) ** 2 * x.size < SAFE
            part = x.sum(0) if small else x.astype(object).sum(0)
            sums = [a + int(b) for a, b in zip(sums, part, strict=True)]
            squares += int((x * x).sum()) if small else int((x.astype(object) ** 2).sum())
        values = [n, *sums, squares]
        yield pa.RecordBatch.from_arrays([pa.array(range(dimension + 2), pa.int32()), pa.array([str(v) for v in values])], names=["cell", "part"])

    rows = blocks.mapInArrow(run, "cell int, part string").groupBy("cell") \
        .agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()     # dimension + 2 numbers
    got = {r.cell: int(r.total) for r in rows}
    return got.get(0, 0), [got.get(i + 1, 0) for i in range(dimension)], got.get(dimension + 1, 0)


def centre(n: int, sums) -> tuple[np.ndarray, np.ndarray]:
    """Whole number nearest each mean, and the rest of the mean (an exact fraction, rounded once)."""
    near = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(near, np.int64), np.array([(s - n * m) / n for s, m in zip(sums, near, strict=True)])


def fit(rows: DataFrame, settings: Settings = Settings(), embedding: str = "embedding") -> Whitening | None:
    """Components of the distinct vectors; None where there are none."""
    s = settings
    distinct = stored(whole_vectors(rows, embedding, s).select(VEC).distinct())
    lengths = distinct.groupBy(F.size(VEC).alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    best = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    if best is None:
        return None
    d = best.d
    blocks = stored(packed(distinct.where(F.size(VEC) == d), d, s.block_rows))
    n, sums, squares = moments(blocks, d)
    near, rest = centre(n, sums)
    trace = (n * squares - sum(v * v for v in sums)) / (n * n)         # whole numbers until the division

    def centred(batches):
        for x in unpacked(batches, d):
            yield (x - near) - rest

    def product(block: np.ndarray) -> np.ndarray:
        def run(batches):
            out = None
            for z in centred(batches):
                part = z.T @ (z @ block)
                out = part if out is None else out + part
            return None if out is None else out.ravel()
        return summed(blocks, run, block.size).reshape(block.shape) / n

    if trace <= 0:
        return None
    values, vectors = JD.eigenpairs(product, d, s.components, s.solver)
    real = values > d * JD.EPS * values[0]
    values, vectors = values[real], vectors[:, real]
    k = len(values)
    to = vectors / np.sqrt(values)

    def means(batches):
        out = None
        for z in centred(batches):
            part = (z @ to).sum(0)
            out = part if out is None else out + part
        return out

    mean = summed(blocks, means, k) / n

    def second(batches):
        out = None
        for z in centred(batches):
            y = z @ to - mean
            out = y.T @ y if out is None else out + y.T @ y
        return None if out is None else out.ravel()

    error = np.abs(summed(blocks, second, k * k).reshape(k, k) / n - np.eye(k)).max()
    return Whitening(n, tuple(sums), values, vectors, values / trace, float(error), s)


def deviations(x: np.ndarray, n: int, sums) -> list[int | None]:
    """Exact sum over dimensions of (n * x - sum) squared per row; None beyond 64 bits."""
    near, _ = centre(n, sums)
    left = [s - n * int(m) for s, m in zip(sums, near, strict=True)]
    z = x - near
    if n * float(np.abs(z).max(initial=0)) + n >= SAFE:
        return [_squares(row, n, left) for row in z.tolist()]
    off = n * z - np.array(left, np.int64)
    about = (off.astype(float) ** 2).sum(1)
    exact = (off * off).sum(1).tolist()              # right where the sum fits; only those are used
    return [v if a < (1 - 1e-9) * 2**63 else _squares(row, n, left) if a < (1 + 1e-9) * 2**63 else None
            for v, a, row in zip(exact, about.tolist(), z, strict=True)]


def _squares(row, n: int, left: list[int]) -> int | None:
    total = sum((n * int(a) - b) ** 2 for a, b in zip(row, left, strict=True))
    return total if total < 2**63 else None


WHITENED = "n long, deviation long, component int, whitened double, explained double, identity_error double"


def apply(rows: DataFrame, fitted: Whitening, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per remaining row of ``rows`` and component: (vec_id, n, deviation, component, whitened, explained, identity_error)."""
    w = fitted
    d, k = w.dimension, len(w.values)
    near, rest = centre(w.n, w.sums)
    to = w.vectors / np.sqrt(w.values)
    source = whole_vectors(rows, embedding, w.settings).select(F.col(vec_id).alias("vec_id"), VEC).where(F.size(VEC) == d)
    kind = source.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = b.slice(i, 4096)
                x = matrix(part.column(1), d)
                y = ((x - near) - rest) @ to
                many = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(many)), pa.array(np.full(len(many), w.n), pa.int64()),
                    pa.array(deviations(x, w.n, w.sums), pa.int64()).take(pa.array(many)),
                    pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()), pa.array(y.ravel(), pa.float64()),
                    pa.array(np.tile(w.explained, len(x)), pa.float64()), pa.array(np.full(len(many), w.identity_error), pa.float64())],
                    names=["vec_id", *(c.split()[0] for c in WHITENED.split(", "))])

    return source.mapInArrow(run, f"vec_id {kind}, {WHITENED}")


def whiten(rows: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Fit over the distinct vectors of ``rows`` and apply to every row."""
    fitted = fit(rows, settings, embedding)
    if fitted is None:
        kind = rows.schema[vec_id].dataType.simpleString()
        return rows.sparkSession.createDataFrame([], f"vec_id {kind}, {WHITENED}")
    return apply(rows, fitted, vec_id, embedding)
