"""Operator 2: suffix-array dedup over bytes, by deep-shallow sorting.

Which 50-byte strings start in more than one document is read off a suffix
array.  The array is built in shards: a string belongs to the shard of its
anchor, the 16-byte gram of least hash inside it, so equal strings meet.

1. Each batch of documents asks about its distinct anchors (about one byte
   in eighteen); a shard answers which occur in more than one document.  A
   string whose anchor does not cannot be repeated.
2. For the anchors that do, a batch sends its distinct snippets: the bytes of
   the neighbouring windows that share one anchor, with the smallest document
   holding them.  A shard sorts the suffixes of its distinct snippets by
   deep-shallow sorting (``suffix_sort``), takes the smallest document of
   every run of equal 50-byte prefixes, and answers each window of a snippet.
3. Each batch removes the bytes covered by windows that start in a smaller
   document too.

A batch asks once for whatever many of its documents share, so a passage or a
text that a third of all documents hold costs one entry per batch.

Defined cases: a null or empty text has no bytes.  A null doc_id counts as
larger than any other.  Rows with the same doc_id never remove each other's
bytes.  Repeated rows give repeated results; an empty table gives an empty
result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm import arrays as A
from tallyframe.llm import mail as M
from tallyframe.llm.suffix_sort import sort_suffixes

LENGTH, GRAM = 50, 16
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def anchor_runs(data: np.ndarray, off: np.ndarray, block: int = 1 << 20):
    """Blocks of (first window, past the last window, hash of the anchor, document) of each
    run of neighbouring windows that share an anchor."""
    n = len(data) - LENGTH + 1
    for a in range(0, n, block):
        b = min(a + block, n)
        d0, d1 = np.searchsorted(off, a, side="right") - 1, np.searchsorted(off, b - 1, side="right")
        edge = np.clip(off[d0 : d1 + 1], a, b) - a
        doc = np.repeat(np.arange(d0, d1), np.diff(edge))
        inside = np.flatnonzero(np.arange(a, b) + LENGTH <= off[doc + 1])
        if not len(inside):
            continue
        part = data[a : b + LENGTH - 1]
        up, down = A.BYTE_POW.upto(len(part) + 1)
        sums = np.zeros(len(part) + 1, A.U64)
        np.cumsum(A.BYTE_VALUE[part] * up[: len(part)], out=sums[1:])
        gram = A.mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1])
        owner = A.sliding_least(gram, LENGTH - GRAM + 1)[inside]
        first = A.group_starts(owner, doc[inside])
        last = np.r_[first[1:], len(inside)] - 1
        yield inside[first] + a, inside[last] + a + 1, gram[owner[first]], doc[inside[first]]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each of the sorted, possibly overlapping byte runs."""
    out = np.empty(len(start), A.U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + A.BLOCK)))
        lo, hi = start[i], end[i:j].max()
        up, down = A.BYTE_POW.upto(int(hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, A.U64)
        np.cumsum(A.BYTE_VALUE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(A.U64)
        i = j
    return A.mix(out, 4)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All positions of the given runs, one run after another."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def distinct(key: np.ndarray, doc: np.ndarray):
    """(an entry of each key in order, least and largest document of each key)."""
    order = np.argsort(key, kind="stable")
    first = A.group_starts(key[order])
    if not len(first):
        return order, doc, doc
    return order[first], np.minimum.reduceat(doc[order], first), np.maximum.reduceat(doc[order], first)


def shard_of(anchor: np.ndarray, n: int) -> np.ndarray:
    return (A.mix(anchor, 9) % A.U64(n)).astype(np.int64)


def ask_anchors(n: int):
    def run(batch: int, table: pa.Table) -> pa.Table:
        data, off = A.text_bytes(table.column("text"))
        ids, keys, docs = M.ids(table), [], []
        for _, _, anchor, doc in anchor_runs(data, off):
            keys.append(anchor)
            docs.append(ids[doc])
        if not keys:
            return M.messages([])
        key = np.concatenate(keys)
        pick, least, most = distinct(key, np.concatenate(docs))
        key = key[pick]
        # the lowest bit tells whether the batch itself has the anchor in two documents
        return M.deal(shard_of(key | A.U64(1), n), n, batch, np.where(least < most, key | A.U64(1), key & ~A.U64(1)))

    return run


def answer_anchors(shard: int, table: pa.Table) -> pa.Table:
    sender, (key,) = M.gather(table)
    both = key & A.U64(1) == 1
    key = key | A.U64(1)
    order = np.argsort(key, kind="stable")
    first = A.group_starts(key[order])
    size = np.diff(np.r_[first, len(key)])
    again = np.repeat((size > 1) | np.logical_or.reduceat(both[order], first), size)
    order = order[again]
    return M.reply(sender[order], shard, key[order])


def ask_snippets(n: int):
    def run(batch: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        _, got = M.gather(answers)
        if not got or not table.num_rows:
            return M.messages([])
        repeated = np.sort(got[0])
        data, off = A.text_bytes(table.column("text"))
        ids, parts = M.ids(table), []
        for start, stop, anchor, doc in anchor_runs(data, off):
            anchor = anchor | A.U64(1)
            at = np.minimum(np.searchsorted(repeated, anchor), len(repeated) - 1)
            hit = repeated[at] == anchor
            start, stop = start[hit], stop[hit] + LENGTH - 1
            parts.append((span_hashes(data, start, stop), anchor[hit], ids[doc[hit]], start, stop - start))
        key, anchor, doc, start, size = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, A.U64),) * 5
        pick, least, most = distinct(key, doc)
        shard = shard_of(anchor[pick], n)
        by = np.argsort(shard, kind="stable")
        pick, least, most, shard = pick[by], least[by], most[by], shard[by]
        edge = np.searchsorted(shard, np.arange(n + 1))
        out = []
        for k in np.flatnonzero(np.diff(edge)):
            p = pick[edge[k] : edge[k + 1]]
            out.append((int(k), batch, M.pack(key[p], least[edge[k] : edge[k + 1]], most[edge[k] : edge[k + 1]],
                                              size[p].astype(np.uint8), data[ranges(start[p], size[p])])))
        return M.messages(out)

    return run


def answer_snippets(shard: int, table: pa.Table) -> pa.Table:
    got = list(M.received(table))
    sender = np.repeat([s for s, _ in got], [len(a[0]) for _, a in got])
    key, least, most, size, text = (np.concatenate(x) for x in zip(*(a for _, a in got), strict=True))
    size = size.astype(np.int64)
    at = np.cumsum(size) - size
    # the distinct snippets, each with the smallest document of any batch
    order = np.argsort(key, kind="stable")
    first = A.group_starts(key[order])
    of = np.empty(len(key), np.int64)
    of[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(key)]))
    pick = order[first]
    low = np.minimum.reduceat(least[order], first)
    text = text[ranges(at[pick], size[pick])]
    many = size[pick] - LENGTH + 1
    start = ranges(np.cumsum(size[pick]) - size[pick], many)
    snippet = np.repeat(np.arange(len(pick)), many)
    suffixes, runs = sort_suffixes(text, start, LENGTH)
    smallest = np.empty(len(start), np.int64)
    smallest[suffixes] = np.repeat(np.minimum.reduceat(low[snippet[suffixes]], runs), np.diff(np.r_[runs, len(suffixes)]))
    # answer the snippets of which some window starts in a document smaller than the batch's largest
    w0 = np.cumsum(many) - many
    hit = np.flatnonzero(np.minimum.reduceat(smallest, w0)[of] < most)
    by = hit[np.argsort(sender[hit], kind="stable")]
    cut = np.r_[A.group_starts(sender[by]), len(by)].astype(np.int64)
    out = []
    for a, b in zip(cut, cut[1:], strict=False):
        s = of[by[a:b]]
        out.append((int(sender[by[a]]), shard, M.pack(key[by[a:b]], many[s].astype(np.uint8), smallest[ranges(w0[s], many[s])])))
    return M.messages(out)


def remove(batch: int, table: pa.Table, answers: pa.Table) -> pa.Table:
    data, off = A.text_bytes(table.column("text"))
    ids, gone = M.ids(table), np.zeros(len(data), bool)
    got = [a for _, a in M.received(answers)]
    if got and table.num_rows:
        key, many, smallest = (np.concatenate(x) for x in zip(*got, strict=True))
        many = many.astype(np.int64)
        order, at = np.argsort(key, kind="stable"), np.cumsum(many) - many
        key = key[order]
        starts = []
        for start, stop, _, doc in anchor_runs(data, off):
            h = span_hashes(data, start, stop + LENGTH - 1)
            k = np.minimum(np.searchsorted(key, h), len(key) - 1)
            hit = np.flatnonzero((key[k] == h) & (many[order[k]] == stop - start))
            n = (stop - start)[hit]
            window = ranges(start[hit], n)
            starts.append(window[smallest[ranges(at[order[k[hit]]], n)] < np.repeat(ids[doc[hit]], n)])
        starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        if len(starts):
            gone = A.cover(starts, LENGTH, len(data))
    total = np.r_[0, np.cumsum(gone)][off]
    rise = gone.copy()
    rise[1:] &= ~gone[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    rise[heads] = gone[heads]
    kept, ko = A.cut(data, ~gone, off)
    view = memoryview(kept.tobytes())
    return pa.table([table.column("doc_id").cast(pa.int64()), pa.array(np.diff(off)), pa.array(np.diff(total)), pa.array(np.diff(np.r_[0, np.cumsum(rise)][off])),
                     pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(ko, ko[1:], strict=False)], pa.string())],
                    names=[x.split()[0] for x in RESULT.split(", ")])


def dedup(docs: DataFrame, batch_bytes: int = M.BATCH_BYTES) -> DataFrame:
    """Remove every byte covered by a 50-byte string that also starts in a document with a smaller doc_id (:data:`RESULT`)."""
    batches, n = M.batched(docs.select("doc_id", "text"), M.text_size(docs), batch_bytes=batch_bytes)
    repeated = M.answer(M.ask(batches, ask_anchors(n)), answer_anchors)
    snippets = M.read_answers(batches, repeated, ask_snippets(n), M.MESSAGES)
    return M.read_answers(batches, M.answer(snippets, answer_snippets), remove, RESULT)
