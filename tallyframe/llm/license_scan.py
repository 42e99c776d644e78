"""Operator 10: license scans by conditional compression.

Texts are read as words (whitespace-delimited, punctuation around them taken
off, A-Z lower-cased; a token without a letter or digit, like a comment mark,
is no word), whatever lines they are on.  A template of m words may differ in
``most_apart`` of them, say d.  Every difference breaks at most two of its
m - 1 pairs of neighbouring words, so where it occurs, m + d words hold at
least m - 1 - 2d of its pairs: stretches with so many are the candidate
blocks, and none is missed.  Blocks of several templates that touch are one.

A block is compressed on its own and with each template as a zstandard
raw-content dictionary; templates are ranked by the bytes that the dictionary
saves.  In that order, those of whose pairs the block holds enough are
confirmed by exact wording: the fewest words put in, left out or replaced
between the template and any stretch of the block
(:func:`nearest_stretches`).  Where stretches of several templates overlap,
the one with most words in common, less those that differ, wins, then the
better rank.  The winners' words are taken out, and what is left is ranked
again, until no template is confirmed.  So a block may name several licenses,
and a shorter wording inside a longer one is not reported twice.

Blocks are cut at ``BLOCK`` times the longest template and overlap by its
length, so texts of any length are scanned whole at bounded cost; a match in
the overlap is left to the block that holds it whole.

Result: one row per confirmed occurrence (:data:`RESULT`).

Defined cases: null and empty texts have no blocks.  Other columns may be
null and extra ones are not read; repeated rows give repeated results; an
empty table gives an empty result; a template without words is never found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tallyframe.llm import arrays as A
from tallyframe.llm.license_texts import TEMPLATES, Template

RESULT = "doc_id long, line long, first_word long, last_word long, license string, form string, saved long, n_apart long, n_template_words long, exact boolean"
BLOCK = 4               # times the longest template
TAKEN, PAIR_SALT = A.U64(0), 71


@dataclass(frozen=True)
class Settings:
    templates: tuple[Template, ...] = field(default_factory=lambda: TEMPLATES)
    most_apart: float = 0.2      # share of the template's words
    level: int = 3


LETTER = np.zeros(256, bool)
LETTER[128:] = True
LETTER[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def words_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first byte, past the last byte, document, hash) of every word of lower-cased texts."""
    letter = LETTER[data]
    if len(data) > 2:           # quotation marks and dashes beyond ASCII are punctuation too
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80) & (data[2:] >= 0x90) & (data[2:] <= 0x9F))
        for k in range(3):
            letter[mark + k] = False
    s, e, doc = A.word_bounds(data, off)
    at = np.flatnonzero(letter)
    if not len(at) or not len(s):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, A.U64)
    a = at[np.minimum(np.searchsorted(at, s), len(at) - 1)]
    b = at[np.maximum(np.searchsorted(at, e) - 1, 0)] + 1
    real = (a >= s) & (b <= e) & (a < b)
    a, b = a[real], b[real]
    return a, b, doc[real], np.maximum(A.run_hashes(data, a, b), A.U64(1))


def pairs_of(h: np.ndarray) -> np.ndarray:
    return A.mix(h[:-1] * A.U64(0x9E3779B97F4A7C15) + h[1:], PAIR_SALT)


def nearest_stretches(template: np.ndarray, block: np.ndarray, most: int) -> list[tuple[int, int, int]]:
    """(words apart, first, past the last) of stretches of the block at most ``most`` words from the template.

    The fewest words put in, left out or replaced, for every place where a
    stretch can end; of stretches that overlap the nearest one counts (then
    the first to end).  Of stretches that end together the shortest counts.
    """
    n, one = len(block), np.int64(1) << 32
    place = np.arange(n + 1, dtype=np.int64)
    # cost and, below it, how far back the stretch begins, as one number; a stretch may begin anywhere
    now = n - place
    for word in template:
        step = now[:-1] + np.where(block == word, 0, one)
        down = now + one
        down[1:] = np.minimum(down[1:], step)
        now = np.minimum.accumulate(down - place * one) + place * one
    cost, first = now >> 32, n - (now & (one - 1))
    out: list[tuple[int, int, int]] = []
    used = np.zeros(n, bool)
    for end in np.flatnonzero(cost <= most)[np.argsort(cost[cost <= most], kind="stable")]:
        a = int(first[end])
        if a < end and not used[a:end].any():
            used[a:end] = True
            out.append((int(cost[end]), a, int(end)))
    return sorted(out, key=lambda x: x[1])


class Scanner:
    def __init__(self, s: Settings):
        self.s = s
        raw, self.words = [], []
        for t in s.templates:
            data = A.LOWER[np.frombuffer(t.text.encode(), np.uint8)]
            a, b, _, h = words_of(data, np.array([0, len(data)]))
            raw.append(b" ".join(data[x:y].tobytes() for x, y in zip(a, b, strict=True)))
            self.words.append(h)
        self.apart = [int(s.most_apart * len(w)) for w in self.words]
        self.least = [max(1, len(w) - 1 - 2 * d) for w, d in zip(self.words, self.apart, strict=True)]
        self.longest = max([len(w) + d for w, d in zip(self.words, self.apart, strict=True)], default=1)
        self.plain = zstandard.ZstdCompressor(level=s.level, write_content_size=False)
        self.given = []
        for r in raw:
            d = zstandard.ZstdCompressionDict(r + b" " * max(0, 8 - len(r)), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=s.level)
            self.given.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False))
        # template pairs; words of one-word templates stand for their pairs
        pairs = [pairs_of(w) if len(w) > 1 else A.mix(w, PAIR_SALT + 1) for w in self.words]
        self.pair = np.unique(np.concatenate([np.zeros(0, A.U64), *pairs]))
        self.of = [np.isin(self.pair, p) for p in pairs]

    def candidates(self, h: np.ndarray, doc: np.ndarray) -> list[tuple[int, int]]:
        """Ranges of words that may hold a template, merged where they touch."""
        if not len(h) or not len(self.pair):
            return []
        same = np.r_[doc[1:] == doc[:-1], False]
        key = np.r_[pairs_of(h), A.U64(0)]
        place = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = np.flatnonzero((self.pair[place] == key) & same)
        which = place[hit]
        if any(len(w) == 1 for w in self.words):
            single = A.mix(h, PAIR_SALT + 1)
            place = np.minimum(np.searchsorted(self.pair, single), len(self.pair) - 1)
            more = np.flatnonzero(self.pair[place] == single)
            hit, which = np.r_[hit, more], np.r_[which, place[more]]
            order = np.argsort(hit, kind="stable")
            hit, which = hit[order], which[order]
        first_of = np.searchsorted(doc, doc, side="left")        # first word of each word's document
        after = np.searchsorted(doc, doc, side="right")
        lo, hi = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for w, d, least, mine in zip(self.words, self.apart, self.least, self.of, strict=True):
            p = hit[mine[which]]
            if len(p) < least or not len(w):
                continue
            a, b = p[: len(p) - least + 1], p[least - 1 :]
            near = (b - a <= len(w) + d) & (doc[a] == doc[b])
            a, b = a[near], b[near]
            lo.append(np.maximum(first_of[a], b - len(w) - d))
            hi.append(np.minimum(after[a], a + len(w) + d + 1))
        a, b = np.concatenate(lo), np.concatenate(hi)
        order = np.argsort(a, kind="stable")
        out: list[tuple[int, int]] = []
        for x, y in zip(a[order].tolist(), b[order].tolist(), strict=True):
            if out and x <= out[-1][1] and doc[x] == doc[out[-1][0]]:
                out[-1] = (out[-1][0], max(out[-1][1], y))
            else:
                out.append((x, y))
        return out

    def blocks(self, lo: int, hi: int) -> Iterator[tuple[int, int, int]]:
        """(first, past the last, where matches must begin before) of the blocks of a range."""
        size = BLOCK * self.longest
        while hi - lo > size:
            yield lo, lo + size, lo + size - self.longest
            lo += size - self.longest
        yield lo, hi, hi

    def judge(self, data: np.ndarray, s: np.ndarray, e: np.ndarray, h: np.ndarray, before: int) -> Iterator[tuple[int, int, int, int, int]]:
        """(template, bytes saved, words apart, first word, past the last) of what a block of words holds.

        ``h`` is changed: words of a match become ``TAKEN``.  Matches that begin at ``before`` or later are left.
        """
        while True:
            left = np.flatnonzero(h != TAKEN)
            if not len(left):
                return
            raw = b" ".join(data[a:b].tobytes() for a, b in zip(s[left].tolist(), e[left].tolist(), strict=True))
            alone = len(self.plain.compress(raw))
            saved = [alone - len(z.compress(raw)) for z in self.given]
            key = pairs_of(h)
            found = []
            for rank, k in enumerate(sorted(range(len(saved)), key=lambda k: (-saved[k], k))):
                m = len(self.words[k])
                if not m:
                    continue
                if m > 1 and np.isin(key, self.pair[self.of[k]]).sum() < self.least[k]:
                    continue
                found += [(2 * apart - m, rank, apart, a, b, k) for apart, a, b in nearest_stretches(self.words[k], h, self.apart[k])]
            used = np.zeros(len(h), bool)
            some = False
            for _, _, apart, a, b, k in sorted(found):
                if used[a:b].any():
                    continue
                used[a:b] = True
                if a < before:
                    some = True
                    h[a:b] = TAKEN
                    yield k, saved[k], apart, a, b
            if not some:
                return

    def scan(self, data: np.ndarray, off: np.ndarray) -> Iterator[tuple]:
        """(document, line, first word, last word, template, saved, apart) of texts given as bytes and offsets."""
        low = A.LOWER[data]
        s, e, doc, h = words_of(low, off)
        newline = np.flatnonzero(data == 10)
        for lo, hi in self.candidates(h, doc):
            d = int(doc[lo])
            begin = int(np.searchsorted(doc, d))
            for a, b, before in self.blocks(lo, hi):
                for k, saved, apart, x, y in self.judge(low, s[a:b], e[a:b], h[a:b], before - a):
                    line = int(np.searchsorted(newline, s[a + x]) - np.searchsorted(newline, off[d]))
                    yield d, line, a + x - begin, a + y - 1 - begin, k, saved, apart


def license_scan(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One row per confirmed occurrence (:data:`RESULT`)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(s)
        for batch in batches:
            ids = batch.column(0).cast(pa.int64()).to_pylist()
            data, off = A.text_bytes(batch.column(1))
            for i, j in A.slices(off):
                rows = [(ids[i + d], line, first, last, s.templates[k].license, s.templates[k].form, saved, apart, len(scanner.words[k]), apart == 0)
                        for d, line, first, last, k, saved, apart in scanner.scan(data[off[i] : off[j]], off[i : j + 1] - off[i])]
                cols = list(zip(*rows, strict=True)) or [()] * 10
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()] * 3 + [pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[x.split()[0] for x in RESULT.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)
