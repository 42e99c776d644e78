"""Operator 8: rule-based quality filter with zstandard compression bands.

Base counts come from the words, characters and lines of the whole text.
The method's verdict compresses the whole text and each fixed-size chunk of
it on its own: a ratio (compressed / plain bytes) below the band means
repetitive text, above it incompressible text (keys, binary dumps, random
strings).  Both limits depend on the length, since short texts compress less.

Defined cases: a null or empty text has zero counts, ratio null, and fails
the base rule (fewer than 50 words).  Any other column may be null; extra
columns are not read.  Repeated rows give repeated results; an empty table
gives an empty result.  Texts of any length are processed whole, one
document of a slice at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tallyframe.llm import arrays as A

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, ratio double, n_chunks long, n_bad_chunks long")


@dataclass(frozen=True)
class Bands:
    """Allowed ratios.  ``whole``: (least bytes, low, high), the last fitting row counts;
    below the first row nothing is rejected.  ``chunk``: (low, high) for chunks of
    ``chunk_bytes`` (a tail shorter than half a chunk is left out); a document with more
    than ``bad_share`` of its chunks outside is rejected."""

    whole: tuple[tuple[int, float, float], ...] = (
        (256, 0.25, 0.88), (1024, 0.22, 0.76), (4096, 0.20, 0.70), (65536, 0.15, 0.66))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (0.15, 0.76)
    bad_share: float = 0.5
    level: int = 3


def repeats(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which entries share (doc, hash) with another entry; also which have an earlier equal."""
    key = hashes ^ A.mix(doc.astype(A.U64), 3)
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    again, later = np.zeros(len(s), bool), np.zeros(len(s), bool)
    again[order[1:]] |= same
    later[order[1:]] |= same
    again[order[:-1]] |= same
    return np.stack([again, later])


def count_text(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each document of a slice."""
    n = len(off) - 1
    per = lambda pos, w=None: np.bincount(pos, weights=w, minlength=n).astype(np.int64)
    s, e, doc = A.word_bounds(data, off)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    out = {"n_words": per(doc), "word_chars": per(doc, lead[e] - lead[s])}
    sym = np.flatnonzero(SYMBOLS[data])
    out["n_symbols"] = per(np.searchsorted(off, sym, side="right") - 1)
    # lines: document and newline boundaries cut the bytes; only lines with a word count
    newline = np.flatnonzero(data == 10)
    l_start = np.unique(np.r_[off[:-1][off[:-1] < off[1:]], newline + 1]) if len(data) else np.zeros(0, np.int64)
    l_start = l_start[l_start < len(data)]
    l_end = np.r_[l_start[1:], len(data)][: len(l_start)]
    l_end = l_end - (data[l_end - 1] == 10) if len(l_start) else l_end
    solid = np.searchsorted(s, l_start) < np.searchsorted(s, l_end)
    l_start, l_end = l_start[solid], l_end[solid]
    l_doc = np.searchsorted(off, l_start, side="right") - 1
    out["n_dup_lines"] = per(l_doc[repeats(l_doc, A.run_hashes(data, l_start, l_end))[1]])
    tri = A.window_hashes(A.run_hashes(data, s, e), 3)
    inside = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, np.int64)
    hit = inside[repeats(doc[inside], tri[inside])[0]]
    out["n_repeat_words"] = per(doc[A.cover(hit, 3, len(doc))]) if len(doc) else per(doc)
    return out


def ratios(raw: memoryview, bands: Bands, z: zstandard.ZstdCompressor) -> tuple[float | None, int, int, bool]:
    """(ratio of the whole, chunks, chunks outside the band, inside all bands)."""
    n = len(raw)
    if n == 0:
        return None, 0, 0, True
    whole = len(z.compress(raw)) / n
    low, high = next(((lo, hi) for least, lo, hi in reversed(bands.whole) if n >= least), (0.0, np.inf))
    size, chunks, bad = bands.chunk_bytes, 0, 0
    for a in range(0, n, size):
        part = raw[a : a + size]
        if 2 * len(part) >= size:
            r = len(z.compress(part)) / len(part)
            chunks += 1
            bad += not bands.chunk[0] <= r <= bands.chunk[1]
    return whole, chunks, bad, low <= whole <= high and bad <= bands.bad_share * chunks


def judged(column, bands: Bands, z: zstandard.ZstdCompressor):
    """(first, last, result columns) of each slice of a column of texts."""
    data, off = A.text_bytes(column)
    for i, j in A.slices(off):
        part, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
        c = count_text(part, o)
        view = memoryview(part)
        whole, chunks, bad, fine = zip(*(ratios(view[a:b], bands, z) for a, b in zip(o, o[1:], strict=False)), strict=True)
        failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
        counts = [pa.array(c[k]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
        yield i, j, [*counts, pa.array(failed), pa.array(~failed & np.array(fine)), pa.array(whole, pa.float64()),
                     pa.array(chunks, pa.int64()), pa.array(bad, pa.int64())]


def quality_rules(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: base counts, compression figures and verdict (:data:`SCHEMA`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for i, j, columns in judged(batch.column(1), bands, z):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i).cast(pa.int64()), *columns], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def reject(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that the rules keep, all columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=bands.level)
        for batch in batches:
            for i, j, columns in judged(batch.column("text"), bands, z):
                yield batch.slice(i, j - i).filter(columns[6])

    return docs.mapInArrow(run, docs.schema)
