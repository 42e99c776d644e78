"""Operator 4: packing documents into sequences, dominance reduction then best fit.

A document is its token ids and a closing id; only documents longer than a
sequence are cut, the first piece taking the remainder.  Packing depends on
lengths alone, so the plan is made from the histogram of piece lengths: at
most ``capacity`` rows, whatever the number of documents.

The reduction permanently fixes a small set that provably dominates every
other set holding the same longest piece: the piece alone if nothing fits
beside it; the piece and its exact complement; the piece and the largest that
fits if no two others fit together beside it, or if that one is at least as
long as any pair that fits and no three fit.  The rest is packed best fit by decreasing length
(each piece into the fullest sequence that holds it), for all pieces of a
length and all equally filled sequences at once.

Every piece then finds its slot by its rank among the pieces of its length,
taken within buckets whose sizes are bounded, so a length that a third of
all pieces share is ranked by many tasks.

Texts are encoded in slices of 2 MB: the encoder's arrays take many times
the slice they are made for, and two tasks share an executor's memory.

Defined cases: a null or empty text is the closing id alone.  Any other
column may be null; repeated rows are packed as often as they occur; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm import arrays as A
from tallyframe.llm.byte_tokens import byte_tokens
from tallyframe.llm.shared import stored

CAPACITY = 2048
BUCKET_ROWS = 100_000
SALTS = 1 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: a group of equal sequences: (how many, lengths in order)
Pattern = tuple[int, tuple[int, ...]]


def reduce_by_dominance(count: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Sequences fixed by dominance, and the histogram of what remains."""
    left = {w: c for w, c in count.items() if c > 0}
    keys = sorted(left)
    fixed: list[Pattern] = []

    def take(*lengths: int) -> None:
        need = {w: lengths.count(w) for w in set(lengths)}
        times = min(left[w] // k for w, k in need.items())
        fixed.append((times, lengths))
        for w, k in need.items():
            left[w] -= times * k
            if not left[w]:
                del left[w]
                keys.pop(bisect.bisect_left(keys, w))

    def smallest(k: int, besides: int) -> int | None:
        """Sum of the k smallest pieces, one piece of length ``besides`` being used already."""
        total = got = 0
        for w in keys:
            n = min(left[w] - (w == besides), k - got)
            total, got = total + n * w, got + n
            if got == k:
                return total
        return None

    def largest(room: int, besides: int) -> int | None:
        """The longest piece that fits the room beside one of length ``besides``."""
        i = bisect.bisect_right(keys, room) - 1
        if i >= 0 and keys[i] == besides and left[besides] < 2:
            i -= 1
        return keys[i] if i >= 0 else None

    def best_pair(room: int, besides: int) -> int:
        """The largest sum of two pieces within the room (0 if none)."""
        free = [w for w in keys[: bisect.bisect_right(keys, room)] if left[w] > (w == besides)]
        best, lo, hi = 0, 0, len(free) - 1
        while lo <= hi:
            s = free[lo] + free[hi]
            if s > room or (lo == hi and left[free[lo]] - (free[lo] == besides) < 2):
                hi -= 1
            else:
                best, lo = max(best, s), lo + 1
        return best

    changed = True
    while changed:
        changed = False
        for w in sorted(left, reverse=True):
            while left.get(w):
                room = capacity - w
                k = largest(room, w)
                if k is None:
                    take(w)
                else:
                    two, three = smallest(2, w), smallest(3, w)
                    if k == room or two is None or two > room or ((three is None or three > room) and k >= best_pair(room, w)):
                        take(w, k)
                    else:
                        break
                changed = True
    return fixed, left


def best_fit(count: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit by decreasing length over a histogram; equal sequences are kept as one group."""
    groups: dict[int, list[Pattern]] = {}  # by room
    rooms: list[int] = []
    done: list[Pattern] = []

    def put(room: int, pattern: Pattern) -> None:
        if room == 0:
            done.append(pattern)
            return
        if room not in groups:
            groups[room] = []
            bisect.insort(rooms, room)
        groups[room].append(pattern)

    for w in sorted(count, reverse=True):
        c = count[w]
        while c:
            i = bisect.bisect_left(rooms, w)
            if i == len(rooms):
                fill = capacity // w
                whole, rest = divmod(c, fill)
                if whole:
                    put(capacity - fill * w, (whole, (w,) * fill))
                if rest:
                    put(capacity - rest * w, (1, (w,) * rest))
                break
            room = rooms[i]
            n, lengths = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(i)
            # a sequence stays the best fit for the next piece of this length while it holds one more
            per = min(room // w, c)
            full, rest = divmod(c, per)
            used = min(n, full)
            put(room - per * w, (used, lengths + (w,) * per))
            c -= used * per
            if n > used:
                put(room, (n - used, lengths))
                if c and c < per:
                    continue
    for room in rooms:
        done += groups[room]
    return done


class Slots:
    """Where the r-th piece of each length goes: sequence number and offset."""

    def __init__(self, patterns: list[Pattern]):
        entries: dict[int, list[tuple[int, int, int]]] = {}
        sequence = 0
        for n, lengths in patterns:
            at = 0
            for w in lengths:
                entries.setdefault(w, []).append((n, sequence, at))
                at += w
            sequence += n
        self.sequences = sequence
        self.table = {}
        for w, rows in entries.items():
            n, base, at = (np.array(x, np.int64) for x in zip(*rows, strict=True))
            self.table[w] = (np.cumsum(n) - n, base, at)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, at = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        order = np.argsort(length, kind="stable")
        first = A.group_starts(length[order])
        for a, b in zip(first, np.r_[first[1:], len(order)], strict=True):
            pick = order[a:b]
            start, base, offset = self.table[int(length[pick[0]])]
            k = np.searchsorted(start, rank[pick], side="right") - 1
            seq[pick] = base[k] + rank[pick] - start[k]
            at[pick] = offset[k]
        return seq, at


def plan(count: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Sequences for a histogram of lengths."""
    fixed, rest = reduce_by_dominance(count, capacity)
    return fixed + best_fit(rest, capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = 0) -> DataFrame:
    """The pieces of every document (:data:`PIECES`) and a number dealt round robin per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, dealt = byte_tokens(tokenizer), 0
        for batch in batches:
            data, off = A.text_bytes(batch.column(1))
            for i, j in A.slices(off):
                ids, at = model.encode(data[off[i] : off[j]], off[i : j + 1] - off[i])
                n = np.diff(at) + 1
                many = -(-n // capacity)
                doc = np.repeat(np.arange(j - i), many)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                head = (n - 1) % capacity + 1
                length = np.where(piece == 0, head[doc], capacity)
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                end = np.frombuffer(np.uint32(closing).tobytes(), np.uint8).tobytes()
                last = piece == many[doc] - 1
                crc = [zlib.crc32(end, zlib.crc32(ids[a : a + k - 1].tobytes())) if z else zlib.crc32(ids[a : a + k].tobytes())
                       for a, k, z in zip(at[doc] + start, length, last, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(pa.int64()).take(pa.array(doc + i)), pa.array(piece.astype(np.int32)), pa.array(start.astype(np.int64)),
                     pa.array(length.astype(np.int64)), pa.array(crc, pa.int64()), pa.array(((dealt + np.arange(len(doc))) % SALTS).astype(np.int32))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "__tf_deal"])
                dealt += len(doc)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES + ", __tf_deal int")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = 0, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per piece: :data:`PIECES`, sequence_id and offset.

    ``tokenizer`` names a byte-level BPE file that every executor can open.
    """
    cut = stored(pieces(docs, tokenizer, capacity, closing))
    histogram = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    slots = docs.sparkSession.sparkContext.broadcast(Slots(plan(histogram, capacity)))
    buckets = min(SALTS, max(1, -(-sum(histogram.values()) // bucket_rows)))
    cut = cut.withColumn("__tf_bucket", F.col("__tf_deal") % F.lit(buckets))
    before = (cut.groupBy("length", "__tf_bucket").agg(F.count(F.lit(1)).alias("__tf_n"))
              .withColumn("__tf_before", F.sum("__tf_n").over(Window.partitionBy("length").orderBy("__tf_bucket")) - F.col("__tf_n")).drop("__tf_n"))
    w = Window.partitionBy("length", "__tf_bucket").orderBy("doc_id", "piece", "ids_crc32", "__tf_deal")
    ranked = (cut.withColumn("__tf_rank", F.row_number().over(w).cast("long") - 1).join(before, ["length", "__tf_bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("__tf_rank") + F.col("__tf_before")).alias("__tf_rank")))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, at = slots.value.find(b.column(3).to_numpy(), b.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(at)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
