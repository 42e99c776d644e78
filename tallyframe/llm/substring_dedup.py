"""Operator 7: substring dedup over words, count-min prefilter.

A window is ``WINDOW`` consecutive words.  Each window is counted under its
anchor, the ``GRAM``-word gram of least hash inside it: windows with equal
words have equal anchors, so an anchor's count is at least the window's.
First pass: every part of the documents, where it is read, adds its anchors (once per document) to
a count-min sketch; the partition sketches are sent as sparse slices, summed
slice by slice, and kept as one bit per cell ("two or more").  The merged
sketch never underestimates, so no repeated window is lost.  Second pass:
only windows whose anchor is estimated repeated are grouped exactly, by two
64-bit hashes, to find the smallest document holding each.  A batch asks
about its distinct windows once (see ``mail``), so a passage that a third of
all documents share costs one entry per batch.

The sketch grows with the input up to ``MOST_BITS`` cells a row (128 MB a
row), which bounds what is broadcast; beyond that it only lets more windows
through to the exact pass.  Anchors are about one word in eighteen, so even
a full sketch leaves the exact pass proportional to the input.

Defined cases: a null or empty text has no words.  A null doc_id counts as
larger than any other.  Rows with the same doc_id never remove each other's
words.  Repeated rows give repeated results; an empty table gives an empty
result; extra columns of any name are carried only when asked for.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm import arrays as A
from tallyframe.llm import mail as M

WINDOW, GRAM = 50, 16
ROWS = 2
LEAST_BITS, MOST_BITS = 16, 30
SLICES = 64
PART_BYTES = 8 << 20
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


@dataclass
class Windows:
    """The words of a batch and the hash of each word."""

    data: np.ndarray
    off: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @classmethod
    def of(cls, column) -> Windows:
        data, off = A.text_bytes(column)
        s, e, d, h = [], [], [], []
        for i, j in A.slices(off):
            s0, e0, d0 = A.word_bounds(data[off[i] : off[j]], off[i : j + 1] - off[i])
            h.append(A.run_hashes(data[off[i] : off[j]], s0, e0))
            s.append(s0 + off[i]), e.append(e0 + off[i]), d.append(d0 + i)
        z = [np.zeros(0, np.int64)]
        return cls(data, off, np.concatenate(s or z), np.concatenate(e or z), np.concatenate(d or z), np.concatenate(h or [np.zeros(0, A.U64)]))

    def blocks(self, size: int = 1 << 18):
        """Window starts in blocks: (positions of whole windows, their anchors' hashes, first word, past the last word)."""
        n = len(self.hash) - WINDOW + 1
        for a in range(0, n, size):
            b = min(a + size, n)
            inside = np.flatnonzero(self.doc[a + WINDOW - 1 : b + WINDOW - 1] == self.doc[a:b])
            if len(inside):
                gram = A.window_hashes(self.hash[a : b + WINDOW - 1], GRAM)
                owner = A.sliding_least(gram, WINDOW - GRAM + 1)[inside]
                yield inside + a, gram[owner], a, b + WINDOW - 1


def cells(anchor: np.ndarray, row: int, bits: int) -> np.ndarray:
    return A.mix(anchor, 21 + row) >> A.U64(64 - bits)


def sketch(docs: DataFrame, bits: int, most_slices: int = SLICES) -> list[np.ndarray]:
    """For each row of the merged sketch, one bit per cell: counted at least twice."""
    width = max(0, bits - (most_slices.bit_length() - 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, off = A.text_bytes(batch.column(0))
            for i, j in A.slices(off, PART_BYTES):
                yield from messages(Windows.of(batch.column(0).slice(i, j - i))).to_batches()

    def messages(w: Windows) -> pa.Table:
        docs, anchors = [], []
        for pos, anchor, _, _ in w.blocks():
            doc = w.doc[pos]
            run = A.group_starts(doc, anchor)  # neighbouring windows mostly share their anchor
            docs.append(doc[run])
            anchors.append(anchor[run])
        if not docs:
            return M.messages([])
        doc, anchor = np.concatenate(docs), np.concatenate(anchors)
        order = np.lexsort((anchor, doc))
        anchor = anchor[order][A.group_starts(doc[order], anchor[order])]
        out = []
        for row in range(ROWS):
            c = np.sort(cells(anchor, row, bits))
            first = A.group_starts(c)
            times = np.minimum(np.diff(np.r_[first, len(c)]), 2).astype(np.uint8)
            c = c[first]
            part = (c >> A.U64(width)).astype(np.int64)
            cut = np.r_[A.group_starts(part), len(c)]
            low = (c & A.U64((1 << width) - 1)).astype(np.uint32)
            out += [(int(part[a]) * ROWS + row, 0, M.pack(low[a:b], times[a:b])) for a, b in zip(cut, cut[1:], strict=False)]
        return M.messages(out)

    def merge(key: int, table: pa.Table) -> pa.Table:
        total = np.zeros(1 << width, np.uint8)
        for _, (low, times) in M.received(table):
            total[low] = np.minimum(total[low] + times, 2)
        return M.messages([(key, 0, M.pack(np.packbits(total >= 2)))])

    merged = [np.zeros((1 << bits) // 8, np.uint8) for _ in range(ROWS)]
    for r in M.answer(docs.select("text").mapInArrow(count, M.MESSAGES), merge).collect():  # at most ROWS * 2**bits / 8 bytes, bounded by MOST_BITS
        part, row = divmod(r["__tf_to"], ROWS)
        size = (1 << width) // 8
        merged[row][part * size : (part + 1) * size] = M.unpack(r["__tf_payload"])[0]
    return merged


def repeated(bitmaps: list[np.ndarray], anchor: np.ndarray, bits: int) -> np.ndarray:
    """Whether the sketch estimates each anchor at two or more."""
    out = np.ones(len(anchor), bool)
    for row, bitmap in enumerate(bitmaps):
        c = cells(anchor, row, bits)
        out &= (bitmap[(c >> A.U64(3)).astype(np.int64)] >> (7 - (c & A.U64(7))).astype(np.uint8)) & 1 == 1
    return out


def candidates(w: Windows, bitmaps: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and the two hashes of every window estimated repeated."""
    pos, one, two = [], [], []
    for p, anchor, a, b in w.blocks():
        p = p[repeated(bitmaps, anchor, bits)]
        if len(p):
            pos.append(p)
            one.append(A.window_hashes(w.hash[a:b], WINDOW, 1)[p - a])
            two.append(A.window_hashes(w.hash[a:b], WINDOW, 2)[p - a])
    none = np.zeros(0, A.U64)
    return np.concatenate(pos or [np.zeros(0, np.int64)]), np.concatenate(one or [none]), np.concatenate(two or [none])


def distinct_windows(one: np.ndarray, two: np.ndarray, doc: np.ndarray):
    """(order, first of each group, group of each entry in order, least and largest doc of each group)."""
    order = np.argsort(one, kind="stable")
    if len(one) and ((one[order][1:] == one[order][:-1]) & (two[order][1:] != two[order][:-1])).any():
        order = np.lexsort((two, one))
    first = A.group_starts(one[order], two[order])
    d = doc[order]
    group = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(d)]))
    if not len(first):
        return order, first, group, d, d
    return order, first, group, np.minimum.reduceat(d, first), np.maximum.reduceat(d, first)


def dedup(docs: DataFrame, carry: list[str] = (), keep_text: bool = False) -> DataFrame:
    """Remove every word covered by a window that also starts in a document with a smaller doc_id.

    Returns :data:`RESULT`, then the columns named in ``carry``, then with
    ``keep_text`` the ``text`` of the kept words joined by one blank (a text
    nothing was removed from stays as it is; null stays null).
    """
    spark = docs.sparkSession
    carry = [c for c in carry if c not in ("doc_id", "text", "n_words", "n_removed", "kept_sha256")]
    total = M.text_size(docs)
    bits = min(MOST_BITS, max(LEAST_BITS, (4 * total // 100).bit_length()))
    batches, n = M.batched(docs.select("doc_id", "text", *[F.col(c).alias(f"__tf_c{i}") for i, c in enumerate(carry)]), total)
    plain = batches.select("doc_id", "text", M.BATCH)
    bitmaps = spark.sparkContext.broadcast(sketch(docs, bits))

    def ask(batch: int, table: pa.Table) -> pa.Table:
        w = Windows.of(table.column("text"))
        pos, one, two = candidates(w, bitmaps.value, bits)
        order, first, _, least, most = distinct_windows(one, two, M.ids(table)[w.doc[pos]])
        one, two = one[order][first], two[order][first]
        return M.deal((A.mix(one, 9) % A.U64(n)).astype(np.int64), n, batch, one, two, least, most)

    def answer(shard: int, table: pa.Table) -> pa.Table:
        sender, got = M.gather(table)
        one, two, least, most = got
        order, first, group, low, _ = distinct_windows(one, two, least)
        low = low[group]
        hit = low < most[order]
        order = order[hit]
        return M.reply(sender[order], shard, one[order], two[order], low[hit])

    def apply(batch: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        w = Windows.of(table.column("text"))
        gone = np.zeros(len(w.hash), bool)
        _, got = M.gather(answers)
        if got:
            pos, one, two = candidates(w, bitmaps.value, bits)
            one_a, two_a, low = got
            order = np.lexsort((two_a, one_a))
            one_a, two_a, low = one_a[order], two_a[order], low[order]
            at = np.searchsorted(one_a, one)
            at = np.minimum(at, len(one_a) - 1)
            hit = (one_a[at] == one) & (two_a[at] == two) & (low[at] < M.ids(table)[w.doc[pos]])
            # equal first hashes with different second ones: look at the next entries too
            while True:
                nxt = np.minimum(at + 1, len(one_a) - 1)
                more = (one_a[nxt] == one) & (nxt > at)
                if not more.any():
                    break
                at = np.where(more, nxt, at)
                hit |= more & (one_a[at] == one) & (two_a[at] == two) & (low[at] < M.ids(table)[w.doc[pos]])
            if hit.any():
                gone = A.cover(pos[hit], WINDOW, len(w.hash))
        texts, digests = joined(w, ~gone)
        n_docs = table.num_rows
        words = np.bincount(w.doc, minlength=n_docs)
        removed = np.bincount(w.doc[gone], minlength=n_docs)
        out = [table.column("doc_id").cast(pa.int64()), pa.array(words.astype(np.int64)), pa.array(removed.astype(np.int64)), pa.array(digests, pa.string())]
        out += [table.column(f"__tf_c{i}") for i in range(len(carry))]
        if keep_text:
            out.append(pc.if_else(pa.array(removed > 0), pa.array(texts, pa.string()), table.column("text").cast(pa.string())))
        return pa.table(out, schema=pa.schema([pa.field(f"f{i}", c.type) for i, c in enumerate(out)])).rename_columns(names)

    kinds = {f.name: f.dataType for f in docs.schema.fields}
    schema = T.StructType([*T._parse_datatype_string(RESULT).fields, *[T.StructField(f"__tf_c{i}", kinds[c]) for i, c in enumerate(carry)],
                           *([T.StructField("__tf_text", T.StringType())] if keep_text else [])])
    names = schema.names
    out = M.read_answers(batches, M.answer(M.ask(plain, ask), answer), apply, schema)
    taken = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return out.select(*taken, *[F.col(f"__tf_c{i}").alias(c) for i, c in enumerate(carry)], *([F.col("__tf_text").alias("text")] if keep_text else []))


def joined(w: Windows, keep: np.ndarray) -> tuple[list[bytes], list[str]]:
    """For each document its kept words joined by one blank, and the sha256 of that."""
    texts, digests = [], []
    edge = np.searchsorted(w.doc, np.arange(len(w.off)))
    for i, j in A.slices(w.off):
        a, b = edge[i], edge[j]
        pick = np.flatnonzero(keep[a:b]) + a
        lo, hi = w.off[i], w.off[j]
        part = w.data[lo:hi].copy()
        doc = w.doc[pick]
        inner = np.flatnonzero(doc[1:] == doc[:-1]) if len(doc) > 1 else np.zeros(0, np.int64)
        step = np.zeros(hi - lo + 1, np.int8)
        step[w.start[pick] - lo] += 1
        step[w.end[pick] - lo] -= 1
        mask = np.cumsum(step[:-1], dtype=np.int8) > 0
        blank = w.end[pick[inner]] - lo
        part[blank] = 32
        mask[blank] = True
        kept, off = A.cut(part, mask, w.off[i : j + 1] - lo)
        raw = kept.tobytes()
        for x, y in zip(off, off[1:], strict=False):
            texts.append(raw[x:y])
            digests.append(hashlib.sha256(raw[x:y]).hexdigest())
    return texts, digests
