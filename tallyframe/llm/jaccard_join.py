"""Operator 3: n-gram Jaccard join by parity sketches.

A document's set holds the hashes of its distinct five-word shingles.  Two
sets of n and m link when their similarity is at least 75 %, which bounds
their symmetric difference by (n + m) / 7.

Size bands: a pair belongs to the band of its smaller size.  For a band the
shingles are dealt into ``parts`` segments of a parity sketch: each shingle
flips, by exclusive or, the bits of one segment.  A shingle that only one
document has changes one segment at most, so the number of differing
segments is a lower bound of the symmetric difference; with d + 1 segments at
least one must be equal (pigeonhole).  Of its segments a document sends only
the d + 1 first in an order that all documents share, those of many
shingles first: whichever segments two linked documents have in common, the
first of them is among the first d + 1 of both.

Shingles that many documents share (counted over all documents, in cells of a
sketch of bounded size) are left out of these segments, on both sides alike,
which can only lower the difference; so a passage that a third of all
documents quote brings none of them together.  A document with too few
segments left for the pigeonhole, one that consists of such shingles, sends
what it has and a second kind of segments, of all its shingles, in which such
documents meet each other.

Documents with equal sets are one class from the start and only its smallest
document goes on, so copies are never expanded.  A segment value shared by
several documents is a group.  Pairs are verified exactly, in two rounds:
first every member against the smallest of its group; then every pair of a
group whose documents the first round left in different components.  Pairs
inside one component need no look, which keeps large groups of near copies
linear where their members link, and no link between components is lost.  In
large groups the second round passes over pairs whose whole parity sketches
differ in more bits than the symmetric difference of linked sets may have.

Defined cases: texts that are null, empty or without words have an empty set,
link with nothing and are their own component; a text of fewer than five
words is one shingle.  Rows with one doc_id count as one document.  A null
doc_id gets a null component unless its set equals or nears that of a
document with an id.  An empty table gives an empty result; extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm import arrays as A
from tallyframe.llm import mail as M
from tallyframe.llm.components import components
from tallyframe.llm.id_filter import IdFilter
from tallyframe.llm.shared import stored
from tallyframe.operators.joins import skew_split_join

SHINGLE = 5
#: linked when UP * |intersection| >= LOW * |union|
LOW, UP = 75, 100
SMALL_GROUP = 32
#: a shingle that so many documents share is left out of the first kind of segments
FREQUENT = 64
LEAST_BITS, MOST_BITS = 16, 30
SKETCH_BITS = 1024
#: a key of more rows is split, if at most HOT_KEYS keys can have as many
HOT_ROWS, HOT_KEYS = 1000, 10_000


def band_limits(most: int) -> np.ndarray:
    """First size of each band; neighbouring bands differ by a third."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, out[-1] * 4 // 3))
    return np.array(out)


LIMITS = band_limits(1 << 40)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of each document, offsets)."""
    n = len(off) - 1
    values, sizes = [], []
    for i, j in A.slices(off):
        low = A.LOWER[data[off[i] : off[j]]]
        s, e, doc = A.word_bounds(low, off[i : j + 1] - off[i])
        h = A.run_hashes(low, s, e)
        words = np.bincount(doc, minlength=j - i)
        g = A.window_hashes(h, SHINGLE)
        inside = np.flatnonzero(doc[SHINGLE - 1 :] == doc[: len(g)]) if len(g) else np.zeros(0, np.int64)
        g, d = g[inside], doc[inside]
        few = np.flatnonzero((words > 0) & (words < SHINGLE))
        first = np.cumsum(words) - words
        whole = np.array([A.window_hashes(h[first[k] : first[k] + words[k]], int(words[k]), 8)[0] for k in few], A.U64)
        g, d = np.r_[g, whole], np.r_[d, few]
        order = np.argsort(g, kind="stable")
        order = order[np.argsort(d[order].astype(np.uint32 if j - i > 65535 else np.uint16), kind="stable")]
        g, d = g[order], d[order]
        keep = A.group_starts(d, g)
        values.append(g[keep])
        sizes.append(np.bincount(d[keep], minlength=j - i))
    none = np.zeros(0, A.U64)
    return np.concatenate([none, *values]), np.r_[0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))].astype(np.int64)[: n + 1]


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, two hashes of the whole set) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, off = shingle_sets(*A.text_bytes(batch.column(1)))
            sums = [np.r_[A.U64(0), np.cumsum(A.mix(g, k), dtype=A.U64)] for k in (11, 12)]
            f = [(s[off[1:]] - s[off[:-1]]).view(np.int64) for s in sums]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(np.diff(off)), *map(pa.array, f)], names=["doc_id", "n_shingles", "f1", "f2"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long")


def most_apart(n: np.ndarray, band: np.ndarray) -> np.ndarray:
    """Largest symmetric difference of a set of n with any partner in the band."""
    own = np.searchsorted(LIMITS, n, side="right") - 1
    partner = np.where(band == own, n * UP // LOW, LIMITS[band + 1] - 1)
    return (n + partner) * (UP - LOW) // (UP + LOW)


def parts_of(band: int) -> int:
    top = int(LIMITS[band + 1]) - 1
    return max(int(0.7 * top) + 1, int(most_apart(np.array([top]), np.array([band]))[0]) + 1)


def cells(g: np.ndarray, bits: int) -> np.ndarray:
    return A.mix(g, 16) >> A.U64(64 - bits)


def frequent(docs: DataFrame, bits: int, limit: int, slices: int = 64) -> np.ndarray:
    """One bit per cell of shingles: at least ``limit`` documents in it (``2**bits / 8`` bytes).

    Every shingle of every document is counted; each batch sends its sorted
    cells as differences, about a byte per shingle.
    """
    width = bits - (slices.bit_length() - 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, _ = shingle_sets(*A.text_bytes(batch.column(0)))
            c = np.sort(cells(g, bits))
            edge = np.searchsorted(c, np.arange(slices + 1, dtype=A.U64) << A.U64(width))
            out = []
            for k in np.flatnonzero(np.diff(edge)):
                low = (c[edge[k] : edge[k + 1]] & A.U64((1 << width) - 1)).astype(np.int64)
                step = np.diff(np.r_[0, low])
                out.append((int(k), 0, M.pack(step.astype(np.uint16 if step.max() < 1 << 16 else np.uint32))))
            yield from M.messages(out).to_batches()

    def merge(key: int, table: pa.Table) -> pa.Table:
        total = np.zeros(1 << width, np.int64)
        for _, (step,) in M.received(table):
            total += np.bincount(np.cumsum(step.astype(np.int64)), minlength=1 << width)
        return M.messages([(key, 0, M.pack(np.packbits(total >= limit)))])

    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in M.answer(docs.select("text").mapInArrow(count, M.MESSAGES), merge).collect():
        size = (1 << width) // 8
        out[r["__tf_to"] * size : (r["__tf_to"] + 1) * size] = M.unpack(r["__tf_payload"])[0]
    return out


def segments(g: np.ndarray, off: np.ndarray, pick: np.ndarray, band: int, parts: int, use: np.ndarray, space: int):
    """Keys and weights of all segments of the picked documents, from the shingles in use."""
    size = np.diff(off)[pick]
    src = np.arange(size.sum()) + np.repeat(off[pick] - (np.cumsum(size) - size), size)
    row = np.repeat(np.arange(len(pick)), size)
    src, row = src[use[src]], row[use[src]]
    v = A.mix(g[src], 13)
    cell = row * parts + (A.mix(v, 14) % A.U64(parts)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    value, weight = np.zeros(len(pick) * parts, A.U64), np.bincount(cell, minlength=len(pick) * parts)
    if len(cell):
        first = A.group_starts(cell[order])
        value[cell[order][first]] = np.bitwise_xor.reduceat(v[order], first)
    part = np.tile(np.arange(parts), len(pick)).astype(A.U64)
    return A.mix(value ^ A.mix(part + (A.U64(band) << A.U64(40)) + (weight.astype(A.U64) << A.U64(48)), 15 + space)), weight


def foremost(key: np.ndarray, weight: np.ndarray, parts: int, count: np.ndarray, empty: bool):
    """(document, key) of each document's first ``count`` segments, heaviest first, ties by key."""
    order = np.argsort(key, kind="stable")
    order = order[np.argsort(255 - np.minimum(weight[order], 255).astype(np.uint8), kind="stable")]
    order = order[np.argsort((order // parts).astype(np.uint32), kind="stable")]
    take = np.arange(len(order)) % parts < np.repeat(count, parts)
    if not empty:
        take &= weight[order] > 0
    order = order[take]
    return order // parts, key[order]


def segment_keys(g: np.ndarray, off: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, key) of every segment that a document sends; ``common``: which shingles are frequent."""
    n = np.diff(off)
    own = np.searchsorted(LIMITS, n, side="right") - 1
    least = np.searchsorted(LIMITS, -(-n * LOW // UP), side="right") - 1
    docs, keys = [np.zeros(0, np.int64)], [np.zeros(0, A.U64)]
    for band in np.unique(np.concatenate([np.arange(a, b + 1) for a, b in {*zip(least[n > 0].tolist(), own[n > 0].tolist(), strict=True)}] or [own[:0]])):
        pick = np.flatnonzero((n > 0) & (least <= band) & (band <= own))
        if len(pick):
            parts = parts_of(int(band))
            need = most_apart(n[pick], np.full(len(pick), band)) + 1
            key, weight = segments(g, off, pick, int(band), parts, ~common, 0)
            doc, k = foremost(key, weight, parts, need, False)
            docs.append(pick[doc])
            keys.append(k)
            full = (weight.reshape(-1, parts) > 0).sum(axis=1) >= need
            rest, need = pick[~full], need[~full]
            if len(rest):
                key, weight = segments(g, off, rest, int(band), parts, np.ones(len(g), bool), 1)
                doc, k = foremost(key, weight, parts, need, True)
                docs.append(rest[doc])
                keys.append(k)
    return np.concatenate(docs), np.concatenate(keys)


def send_keys(docs: DataFrame, shards: int, hot: np.ndarray, bits: int) -> DataFrame:
    """Messages to the shards: (document, size, how many keys) and the keys."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, off = shingle_sets(*A.text_bytes(batch.column(1)))
            ids, n = M.ids(pa.table([batch.column(0)], names=["doc_id"])), np.diff(off)
            c = cells(g, bits)
            common = (shared.value[(c >> A.U64(3)).astype(np.int64)] >> (7 - (c & A.U64(7))).astype(np.uint8)) & 1 == 1
            doc, key = segment_keys(g, off, common)
            shard = (key % A.U64(shards)).astype(np.int64)
            order = np.lexsort((doc, shard))
            doc, key, shard = doc[order], (key[order] >> A.U64(32)).astype(np.uint32), shard[order]
            edge = np.searchsorted(shard, np.arange(shards + 1))
            out = []
            for k in np.flatnonzero(np.diff(edge)):
                d = doc[edge[k] : edge[k + 1]]
                first = A.group_starts(d)
                out.append((int(k), 0, M.pack(ids[d[first]], n[d[first]].astype(np.int64), np.diff(np.r_[first, len(d)]).astype(np.uint32), key[edge[k] : edge[k + 1]])))
            yield from M.messages(out).to_batches()

    return docs.select("doc_id", "text").mapInArrow(run, M.MESSAGES)


def find_groups(shard: int, table: pa.Table) -> pa.Table:
    """The groups of two or more documents: (group, document, size), sorted by group and document."""
    got = [a for _, a in M.received(table)]
    doc = np.concatenate([np.repeat(a[0], a[2]) for a in got])
    size = np.concatenate([np.repeat(a[1], a[2]) for a in got])
    key = np.concatenate([a[3] for a in got])
    order = np.argsort(key, kind="stable")
    first = A.group_starts(key[order])
    many = np.diff(np.r_[first, len(key)])
    order = order[np.repeat(many > 1, many)]
    order = order[np.lexsort((doc[order], key[order]))]
    order = order[A.group_starts(key[order], doc[order])]  # rows of one doc_id
    first = A.group_starts(key[order])
    many = np.diff(np.r_[first, len(order)])
    order = order[np.repeat(many > 1, many)]
    if not len(order):
        return M.messages([])
    group = np.repeat(np.arange(int((many > 1).sum())), many[many > 1]).astype(np.uint32)
    return M.messages([(shard, 0, M.pack(group, doc[order], size[order]))])


def near_sizes(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return UP * np.minimum(n, m) >= LOW * np.maximum(n, m)


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    order = order[A.group_starts(a[order], b[order])]
    return a[order], b[order]


def star_pairs(group: np.ndarray, doc: np.ndarray, size: np.ndarray):
    """Each member of a group with the group's smallest document."""
    first = A.group_starts(group)
    lead = np.repeat(first, np.diff(np.r_[first, len(group)]))
    fit = (lead != np.arange(len(group))) & near_sizes(size[lead], size)
    return distinct_pairs(doc[lead[fit]], doc[fit])


def parity_sketch(g: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Parity sketches of whole sets: every shingle flips one of ``SKETCH_BITS`` bits."""
    n = len(off) - 1
    cell = np.repeat(np.arange(n), np.diff(off)) * SKETCH_BITS + (A.mix(g, 17) % A.U64(SKETCH_BITS)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=n * SKETCH_BITS) & 1).astype(bool).reshape(n, SKETCH_BITS), axis=1)


def cross_pairs(group: np.ndarray, doc: np.ndarray, size: np.ndarray, component: np.ndarray, sketch: dict[int, bytes]):
    """Every pair of a group whose components differ; in large groups without those whose
    sketches differ in more bits than linked sets may."""
    first = A.group_starts(group)
    many = np.diff(np.r_[first, len(group)])
    out = [(np.zeros(0, np.int64),) * 2]
    small = many <= SMALL_GROUP
    last = np.repeat(first + many, many)
    open_ = np.repeat(small, many)
    for step in range(1, int(many[small].max(initial=0))):
        pos = np.flatnonzero(open_ & (np.arange(len(group)) + step < last))
        pos = pos[(component[pos] != component[pos + step]) & near_sizes(size[pos], size[pos + step])]
        out.append((doc[pos], doc[pos + step]))
    for a, n in zip(first[~small], many[~small], strict=True):
        d, s, c = doc[a : a + n], size[a : a + n], component[a : a + n]
        kinds, back, count = np.unique(c, return_inverse=True, return_counts=True)
        if len(kinds) == 1:
            continue
        drawn = [sketch[int(x)] for x in d]
        any_text = np.array([not x for x in drawn])
        bits = np.frombuffer(b"".join(x or bytes(SKETCH_BITS // 8) for x in drawn), np.uint64).reshape(n, -1)
        for i in np.flatnonzero(back != count.argmax()):
            j = np.flatnonzero((c != c[i]) & near_sizes(s, s[i]))
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            j = j[(apart * (UP + LOW) <= (s[j] + s[i]) * (UP - LOW)) | any_text[i] | any_text[j]]
            out.append((np.full(len(j), d[i]), d[j]))
    a, b = (np.concatenate(x) for x in zip(*out, strict=True))
    return distinct_pairs(a, b)


def pair_batch(a: np.ndarray, b: np.ndarray) -> pa.Table:
    return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def first_pairs(groups: DataFrame) -> DataFrame:
    def run(shard: int, table: pa.Table) -> pa.Table:
        pairs = [star_pairs(g, d, n) for _, (g, d, n) in M.received(table)]
        return pair_batch(*(np.concatenate(x) for x in zip(*pairs, strict=True)))

    return groups.groupBy("__tf_to").applyInArrow(lambda key, t: run(0, t), "a long, b long").distinct()


def members(groups: DataFrame, least: int = 2) -> DataFrame:
    """(shard, doc) of every document in a group of at least so many."""

    def run(batches):
        for b in batches:
            for shard, payload in zip(b.column(0).to_pylist(), b.column(2), strict=True):
                g, d, _ = M.unpack(payload.as_buffer().to_pybytes())
                d = np.sort(d[np.bincount(g)[g] >= least])
                d = d[A.group_starts(d)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(d), shard), pa.int32()), pa.array(d, pa.int64())], names=["shard", "doc"])

    return groups.mapInArrow(run, "shard int, doc long")


def next_pairs(groups: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs across components, given the components that the first pairs made."""

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        comp, sketch = {}, {}
        for d, c, s in zip(*(right.column(k).to_pylist() for k in ("doc", "component", "sketch")), strict=True):
            if s is None:
                comp[d] = c
            elif sketch.setdefault(d, s) != s:
                sketch[d] = b""  # rows of one doc_id with several texts: no filter
        out = [(np.zeros(0, np.int64),) * 2]
        for _, (g, d, n) in M.received(left):
            out.append(cross_pairs(g, d, n, np.array([comp.get(x, x) for x in d.tolist()], np.int64), sketch))
        return pair_batch(*(np.concatenate(x) for x in zip(*out, strict=True)))

    known = members(groups).join(labels.select(F.col("id").alias("doc"), "component"), "doc").select("shard", "doc", "component", F.lit(None).cast("binary").alias("sketch"))
    drawn = (members(groups, SMALL_GROUP + 1).join(sets.select(F.col("doc_id").alias("doc"), "sketch"), "doc")
             .select("shard", "doc", F.lit(None).cast("long").alias("component"), "sketch"))
    return groups.groupBy("__tf_to").cogroup(known.unionByName(drawn).groupBy("shard")).applyInArrow(run, "a long, b long").distinct()


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fit = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), A.U64), np.frombuffer(y.as_buffer(), A.U64)
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                fit.append(UP * same >= LOW * (len(both) - same))
            fit = pa.array(fit, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(fit), batch.column(1).filter(fit)], names=["a", "b"])

    side = lambda k: sets.select(F.col("doc_id").alias(k), F.col("shingles").alias(f"s{k}"))
    many = hot_rows(pairs)
    hot = stored(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > many)
                 .select("a", F.ceil(F.col("n") / many).cast("int").alias("parts")))
    if not hot.limit(1).count():
        both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
    else:
        # the smallest document of a large group is in very many pairs: these are dealt over several tasks
        hot = F.broadcast(hot)
        cold = pairs.join(hot, "a", "left_anti").join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb")
        dealt = pairs.join(hot, "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
        leads = side("a").join(hot, "a").select("a", "sa", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        both = cold.unionByName(dealt.join(leads, ["a", "part"]).join(side("b"), "b").select("a", "b", "sa", "sb"))
    return both.mapInArrow(run, "a long, b long").distinct()


def hot_rows(rows: DataFrame) -> int:
    """Rows of one key above which it is split: at most ``HOT_KEYS`` keys can have so many."""
    return max(HOT_ROWS, -(-rows.count() // HOT_KEYS))


def sets_of(docs: DataFrame, wanted: IdFilter) -> DataFrame:
    """(doc_id, sorted shingle hashes, parity sketch) of the documents that the filter passes."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = M.ids(pa.table([batch.column(0)], names=["doc_id"]))
            hit = np.flatnonzero(shared.value(ids))
            if len(hit):
                g, off = shingle_sets(*A.text_bytes(batch.column(1).take(pa.array(hit))))
                yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array([g[a:b].tobytes() for a, b in zip(off, off[1:], strict=False)], pa.binary()),
                                                  pa.array([x.tobytes() for x in parity_sketch(g, off)], pa.binary())], names=["doc_id", "shingles", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles binary, sketch binary")


def join(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    whole = F.coalesce("doc_id", F.lit(M.LAST_ID))
    signed = stored(signatures(docs).withColumn("doc_id", whole))
    least = signed.where("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("rep"))
    first = least.select(F.col("rep").alias("doc_id")).distinct()
    total = int(signed.agg(F.sum("n_shingles")).first()[0] or 0)
    shards = max(M.LEAST_BATCHES, total // 3_000_000)
    bits = min(MOST_BITS, max(LEAST_BITS, total.bit_length()))
    hot = frequent(docs, bits, FREQUENT + 8 * (total >> bits))
    kept = docs.select(whole.alias("doc_id"), "text").join(first, "doc_id", "left_semi")
    groups = stored(M.answer(send_keys(kept, shards, hot, bits), find_groups))
    wanted = members(groups).select("doc").distinct()
    sets = stored(sets_of(docs.select(whole.alias("doc_id"), "text"), IdFilter(wanted, wanted.count())))
    first_round = stored(first_pairs(groups))
    links = stored(verify(first_round, sets))
    labels = components(links)
    second_round = stored(next_pairs(groups, labels, sets).join(first_round, ["a", "b"], "left_anti"))
    more = stored(verify(second_round, sets))
    if more.limit(1).count():
        labels = components(links.unionByName(more))
    # a class of copies learns its component once, and deals it to its members; texts without words are on their own
    name = lambda c: F.when(c == M.LAST_ID, F.lit(None)).otherwise(c)
    classes = (least.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
               .select("n_shingles", "f1", "f2", F.coalesce("component", "rep").alias("component")))
    some = signed.where("n_shingles > 0")
    told = skew_split_join(some, classes, ["n_shingles", "f1", "f2"], hot_rows=hot_rows(some)).select("doc_id", "n_shingles", "component")
    empty = signed.where("n_shingles = 0").select("doc_id", "n_shingles")
    alone = (empty.where(F.col("doc_id") != M.LAST_ID).join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
             .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
             .unionByName(empty.where(F.col("doc_id") == M.LAST_ID).withColumn("component", F.coalesce(
                 labels.where(F.col("id") == M.LAST_ID).agg(F.min("component").alias("c")).scalar(), F.lit(M.LAST_ID)))))
    return told.unionByName(alone).select(name(F.col("doc_id")).alias("doc_id"), "n_shingles", name(F.col("component")).alias("component_id"))
