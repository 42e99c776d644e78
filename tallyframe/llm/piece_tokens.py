"""Operator 9: SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a slice of texts (a word begins at a blank mark that
does not follow one; no piece of the vocabulary reaches across such a place)
are joined into one text, whose suffixes are sorted.  Every piece is looked
up by binary search, eight bytes at a time, which gives the range of its
occurrences; these edges (start, end, piece) are sorted by position.  The
segmentation then relaxes all words together: as byte-pair models prescribe,
each round joins, in every word, the two neighbours whose edge has the best
score (leftmost of equals), until no edge joins neighbours.  Characters
without a piece become byte pieces.  A word longer than ``LONG`` bytes (text
without blanks) is relaxed on its own with a heap of joins over linked
neighbours, in the same order, so its time grows with n log n.

Words that a worker has segmented before are kept, up to ``MOST_KNOWN`` of
them, so later slices only match words that are new to it.  They are
recognised by two independent 64-bit hashes.

Normalisation is the model's own.  A vocabulary with pieces that reach across
words, or that is not a byte-pair model, is refused.

Defined cases: null and empty texts have no ids (an empty list).  Other
columns may be null and extra ones are not read; repeated rows give repeated
results; an empty table gives an empty result.  Texts of any length are
encoded whole.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from tallyframe.llm import arrays as A
from tallyframe.llm.suffix_sort import sort_suffixes, words

MARK = "▁"  # stands for a blank in pieces
RAW_MARK = MARK.encode()
SLICE = 4 << 20
LONG = 256                     # bytes of a word that is relaxed on its own
MOST_KNOWN = 1 << 19           # words kept by a worker ...
KNOWN_BYTES = 64               # ... of at most this size
OTHER = np.uint8(0xA5)         # bytes exchanged for the second hash
ENCODED = "doc_id long, n_ids long, ids array<int>, decodes_back boolean"


class Pieces:
    """A byte-pair vocabulary and its tables."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.vocab_size()
        text = [self.model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        if any(MARK in text[i][1:] and set(text[i]) != {MARK} for i in plain):
            raise ValueError("a piece reaches across words")
        score = np.array([self.model.get_score(i) for i in range(n)])
        self.byte = np.array([self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.unknown = self.model.unk_id()
        raw = [text[i].encode() for i in plain]
        self.known = Known()
        self.ids, self.length = np.array(plain, np.int32), np.array([len(r) for r in raw], np.int64)
        self.longest = int(self.length.max())
        #: rank of each id by score: 0 joins first, equal scores share a rank
        self.rank = np.zeros(n, np.int64)
        order = np.argsort(-score, kind="stable")
        self.rank[order] = np.cumsum(np.r_[0, np.diff(score[order]) != 0])
        self.rank_of = dict(zip(raw, self.rank[self.ids].tolist(), strict=True))
        self.chars = -(-self.longest // 8)
        table = np.zeros((len(raw), self.chars * 8), np.uint8)
        for k, r in enumerate(raw):
            table[k, : len(r)] = np.frombuffer(r, np.uint8)
        self.low = table.view(">u8").astype(A.U64)
        for k, r in enumerate(raw):
            table[k, len(r) :] = 255
        self.high = table.view(">u8").astype(A.U64)
        #: bytes of each id when decoded
        out = [b"" if self.model.is_control(i) else bytes([int(text[i][3:5], 16)]) if self.model.is_byte(i)
               else " ⁇ ".encode() if self.model.is_unknown(i) else text[i].replace(MARK, " ").encode() for i in range(n)]
        self.out_size = np.array([len(b) for b in out], np.int64)
        self.out_start = np.cumsum(self.out_size) - self.out_size
        self.out = np.frombuffer(b"".join(out), np.uint8)

    def edges(self, text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position * 64 + length, piece id) of every occurrence of every piece, sorted; ``start``: character starts."""
        padded = np.r_[text, np.zeros(self.chars * 8, np.uint8)]
        order, _ = sort_suffixes(padded, start, self.chars * 8)
        at, w = start[order], words(padded)
        head = w[at]
        lo, hi = np.searchsorted(head, self.low[:, 0], side="left"), np.searchsorted(head, self.high[:, 0], side="right")
        for depth in range(1, self.chars):
            live = np.flatnonzero((self.length > 8 * depth) & (hi > lo))
            if not len(live):
                break
            ends = []
            for bound, right in ((self.low[live, depth], False), (self.high[live, depth], True)):
                a, b = lo[live].copy(), hi[live].copy()
                while (a < b).any():
                    mid = (a + b) // 2
                    v = w[at[np.minimum(mid, len(at) - 1)] + 8 * depth]
                    up = (a < b) & ((v <= bound) if right else (v < bound))
                    a, b = np.where(up, mid + 1, a), np.where(up | (a >= b), b, mid)
                ends.append(a)
            lo[live], hi[live] = ends
        count = np.maximum(hi - lo, 0)
        piece = np.repeat(np.arange(len(count)), count)
        where = at[np.arange(count.sum()) + np.repeat(lo - (np.cumsum(count) - count), count)]
        key = where * 64 + self.length[piece]
        by = np.argsort(key, kind="stable")
        return key[by], self.ids[piece[by]]

    def segment(self, text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, offsets) of words given as bytes and offsets."""
        start = np.flatnonzero((text & 0xC0) != 0x80)
        key, piece = self.edges(text, start)

        def join_rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Rank of the edge from a to b (a large number if there is none)."""
            out = np.full(len(a), FAR)
            fit = np.flatnonzero((b - a <= self.longest) & (b > a))
            if len(key) and len(fit):
                k = a[fit] * 64 + (b - a)[fit]
                at = np.minimum(np.searchsorted(key, k), len(key) - 1)
                hit = key[at] == k
                out[fit[hit]] = self.rank[piece[at[hit]]]
            return out

        # symbols: first byte, byte past the end, word, and the rank of joining the next one
        s, word = start, np.searchsorted(off, start, side="right") - 1
        e = np.r_[s[1:], len(text)]
        inner = np.r_[word[1:] == word[:-1], False] if len(word) else np.zeros(0, bool)
        rank = np.full(len(s), FAR)
        pos = np.flatnonzero(inner)
        rank[pos] = join_rank(s[pos], e[pos + 1])
        done_s, done_e = [], []
        wide = np.diff(off) > LONG
        if wide.any():
            for w in np.flatnonzero(wide):
                a, b = np.searchsorted(word, [w, w + 1])
                ends = self.join_long(text[off[w] : off[w + 1]].tobytes(), s[a:b] - off[w], rank[a:b])
                kept = np.flatnonzero(ends)
                done_s.append(s[a:b][kept])
                done_e.append(ends[kept] + off[w])
            rest = ~wide[word]
            s, e, word, rank = s[rest], e[rest], word[rest], rank[rest]
        while len(s):
            first = A.group_starts(word)
            best = np.minimum.reduceat(rank, first)
            many = np.diff(np.r_[first, len(s)])
            alive = np.repeat(best < FAR, many)
            done_s.append(s[~alive])
            done_e.append(e[~alive])
            s, e, word, rank, best = s[alive], e[alive], word[alive], rank[alive], np.repeat(best, many)[alive]
            if not len(s):
                break
            hit = np.flatnonzero(rank == best)
            hit = hit[A.group_starts(word[hit])]  # the leftmost of each word
            e[hit] = e[hit + 1]
            keep = np.ones(len(s), bool)
            keep[hit + 1] = False
            number = np.cumsum(keep) - 1
            s, e, word, rank = s[keep], e[keep], word[keep], rank[keep]
            joined = number[hit]
            for p in (joined, joined[joined > 0] - 1):
                last = p + 1 >= len(s)
                nxt = np.minimum(p + 1, len(s) - 1)
                inside = ~last & (word[nxt] == word[p])
                rank[p] = FAR
                rank[p[inside]] = join_rank(s[p[inside]], e[nxt[inside]])
        s, e = np.concatenate([np.zeros(0, np.int64), *done_s]), np.concatenate([np.zeros(0, np.int64), *done_e])
        order = np.argsort(s, kind="stable")
        s, e = s[order], e[order]
        k = s * 64 + np.minimum(e - s, 63)
        at = np.minimum(np.searchsorted(key, k), max(len(key) - 1, 0))
        known = key[at] == k if len(key) else np.zeros(len(s), bool)
        # characters without a piece: one id per byte, or the unknown id
        bytes_ = (self.byte != self.unknown).all()
        count = np.where(known, 1, e - s) if bytes_ else np.ones(len(s), np.int64)
        row = np.repeat(np.arange(len(s)), count)
        inner_at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        ids = np.where(known[row], piece[at][row], self.byte[text[s[row] + inner_at]] if bytes_ else self.unknown) if len(row) else np.zeros(0, np.int32)
        per = np.bincount(np.searchsorted(off, s[row], side="right") - 1, minlength=len(off) - 1)
        return ids.astype(np.int32), np.r_[0, np.cumsum(per)]

    def join_long(self, text: bytes, start: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """End of each symbol of one word once no edge joins neighbours; 0 for those joined to one before."""
        n, far = len(start), int(FAR)
        begin = start.tolist()
        end = [*begin[1:], len(text)]
        now, after, before = rank.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(now) if r < far]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if now[i] != r:                      # joined since, or its neighbour has grown
                continue
            j = after[i]
            end[i], end[j], now[j], after[i] = end[j], 0, far, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (i, before[i]):
                if k < 0:
                    continue
                then = after[k]
                now[k] = self.rank_of.get(text[begin[k] : end[then]], far) if then < n and end[then] - begin[k] <= self.longest else far
                if now[k] < far:
                    heapq.heappush(heap, (now[k], k))
        return np.array(end, np.int64)

    def words(self, text: np.ndarray, off: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, offsets) of distinct words with their hashes; known ones are not matched again."""
        h2 = A.run_hashes(text ^ OTHER, off[:-1], off[1:])
        count, at, kept = self.known.find(h, h2)
        new = np.flatnonzero(at < 0)
        size = np.diff(off)
        src = np.arange(int(size[new].sum())) + np.repeat(off[new] - (np.cumsum(size[new]) - size[new]), size[new])
        ids, ends = self.segment(text[src], np.r_[0, np.cumsum(size[new])])
        count[new], at[new] = np.diff(ends), ends[:-1] + len(kept)
        both = np.concatenate([kept, ids])
        out = np.cumsum(count) - count
        got = both[np.arange(int(count.sum())) + np.repeat(at - out, count)]
        small = new[size[new] <= KNOWN_BYTES]
        if len(small):
            self.known.add(h[small], h2[small], count[small], both[np.arange(int(count[small].sum())) + np.repeat(at[small] - (np.cumsum(count[small]) - count[small]), count[small])])
        return got, np.r_[out, count.sum()].astype(np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(ids of all texts, offsets, normal forms)."""
        raw = [self.model.normalize(t).encode() if t else b"" for t in texts]
        off = np.r_[0, np.cumsum([len(r) for r in raw])].astype(np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), raw
        mark = np.zeros(len(data) + 3, bool)
        mark[: len(data) - 2] = (data[:-2] == RAW_MARK[0]) & (data[1:-1] == RAW_MARK[1]) & (data[2:] == RAW_MARK[2]) if len(data) > 2 else False
        head = mark[: len(data)].copy()
        head[3:] &= ~mark[: len(data) - 3]
        head[off[:-1][off[:-1] < off[1:]]] = True
        start = np.flatnonzero(head)
        doc = np.searchsorted(off, start, side="right") - 1
        end = np.r_[start[1:], len(data)]
        h = A.run_hashes(data, start, end)
        order = np.argsort(h, kind="stable")
        first = A.group_starts(h[order])
        back = np.empty(len(h), np.int64)
        back[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(h)]))
        pick = order[first]
        size = (end - start)[pick]
        word_off = np.r_[0, np.cumsum(size)]
        src = np.arange(word_off[-1]) + np.repeat(start[pick] - word_off[:-1], size)
        ids, at = self.words(data[src], word_off, h[pick])
        count = np.diff(at)[back]
        src = np.arange(count.sum()) + np.repeat(at[:-1][back] - (np.cumsum(count) - count), count)
        per = np.bincount(doc, weights=count, minlength=len(texts)).astype(np.int64)
        return ids[src], np.r_[0, np.cumsum(per)], raw

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[str]:
        """The texts of lists of ids; the blank put before a text when encoding is taken off."""
        size = self.out_size[ids]
        data = self.out[np.arange(int(size.sum())) + np.repeat(self.out_start[ids] - (np.cumsum(size) - size), size)].tobytes()
        at = np.r_[0, np.cumsum(size)][off]
        parts = [data[a:b] for a, b in zip(at, at[1:], strict=False)]
        return [(p[1:] if p[:1] == b" " else p).decode(errors="replace") for p in parts]


class Known:
    """Ids of words met before, by their hashes; emptied when ``MOST_KNOWN`` are held."""

    def __init__(self):
        self.first, self.second = np.zeros(0, A.U64), np.zeros(0, A.U64)
        self.count, self.at, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def find(self, h: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids, where they start or -1, all ids kept)."""
        count, at = np.zeros(len(h), np.int64), np.full(len(h), -1, np.int64)
        if len(self.first):
            place = np.minimum(np.searchsorted(self.first, h), len(self.first) - 1)
            hit = (self.first[place] == h) & (self.second[place] == h2)
            count[hit], at[hit] = self.count[place[hit]], self.at[place[hit]]
        return count, at, self.ids

    def add(self, h: np.ndarray, h2: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        if len(self.first) + len(h) > MOST_KNOWN:
            self.__init__()
        if len(h) > MOST_KNOWN:
            return
        at = np.cumsum(count) - count + len(self.ids)
        first = np.concatenate([self.first, h])
        order = np.argsort(first, kind="stable")
        self.first, self.second = first[order], np.concatenate([self.second, h2])[order]
        self.count, self.at = np.concatenate([self.count, count])[order], np.concatenate([self.at, at])[order]
        self.ids = np.concatenate([self.ids, ids])


FAR = np.int64(1 << 40)


@cache
def pieces(path: str) -> Pieces:
    """One per worker process."""
    return Pieces(path)


def groups(texts: list[str | None], size: int = SLICE) -> Iterator[tuple[int, int]]:
    total = a = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= size:
            yield a, i + 1
            a, total = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """:data:`ENCODED`: the ids of every text, and whether they decode to its normal form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in groups(texts):
                part = [t or "" for t in texts[i:j]]
                ids, off, normal = p.encode(part)
                back = p.decode(ids, off)
                want = [n.decode().replace(MARK, " ") for n in normal]
                fine = [b == (w[1:] if w[:1] == " " else w) for b, w in zip(back, want, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).cast(pa.int64()), pa.array(np.diff(off)),
                     pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids)), pa.array(fine, pa.bool_())],
                    names=["doc_id", "n_ids", "ids", "decodes_back"])

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def decode(rows: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) of rows with lists of ids; a null list gives a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pieces(model)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            ids = np.array([x for row in lists for x in row or ()], np.int64)
            off = np.r_[0, np.cumsum([len(row or ()) for row in lists])].astype(np.int64)
            text = [None if row is None else t for row, t in zip(lists, p.decode(ids, off), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(text, pa.string())], names=["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
