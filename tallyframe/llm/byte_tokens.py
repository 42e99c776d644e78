"""Byte-level BPE ids of whole texts, from a tokenizer's JSON file.

The file's vocabulary is in merge order, so it serves as merge ranks.  Texts
are cut before each blank, where the vocabulary's split pattern always has a
boundary unless white space stands next to the blank; such texts go to the
library whole.  The distinct cuts of a batch are found with numpy and encoded
in one call; the ids of each cut are told apart by the bytes they stand for.
Equality with the tokenizer library is tested.
"""

from __future__ import annotations

import json
import re
from functools import cache

import numpy as np
import tiktoken

from tallyframe.llm import arrays as A

#: fixed values: the byte-level split pattern, and the bytes that stand for themselves
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: first two bytes of every white-space character beyond ASCII
FAR_WHITE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80")
NEAR_WHITE = A.WHITE.copy()
NEAR_WHITE[0x1C:0x20] = True


class ByteTokens:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        rest = iter(range(256, 512))
        char = {chr(b): b for b in PLAIN} | {chr(next(rest)): b for b in range(256) if b not in PLAIN}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(char[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.model = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.parts = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.size = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.size[i] = len(token)

    def whole(self, text: str) -> list[int]:
        """Ids of one text by the library; a special token's literal text is that token."""
        if not self.parts:
            return self.model.encode_ordinary(text)
        out: list[int] = []
        for p in self.parts.split(text):
            out += [self.special[p]] if p in self.special else self.model.encode_ordinary(p)
        return out

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids) of a slice of texts."""
        n = len(off) - 1
        raw, slow = data.tobytes(), np.zeros(n, bool)
        owner = lambda p: np.searchsorted(off, p, side="right") - 1
        blank = np.flatnonzero(data == 32)
        if len(data):
            near = NEAR_WHITE[data]
            left, right = np.r_[False, near[:-1]], np.r_[near[1:], False]
            left[off[:-1][off[:-1] < len(data)]] = False
            right[off[1:][off[1:] > 0] - 1] = False
            slow[owner(blank[(left | right)[blank]])] = True
            for mark in (*FAR_WHITE, *(t.encode() for t in self.special)):
                at = raw.find(mark)
                while at >= 0:
                    d = int(owner(at))
                    slow[d] = True
                    at = raw.find(mark, int(off[d + 1]))
        fast = ~slow & (np.diff(off) > 0)
        first = np.zeros(len(data) + 1, bool)
        first[off[:-1][fast]] = True
        first[blank[fast[owner(blank)]]] = True
        start = np.flatnonzero(first[:-1])
        doc = owner(start)
        end = np.minimum(np.r_[start[1:], len(data)], off[doc + 1]) if len(start) else start
        h = A.run_hashes(data, start, end)
        order = np.argsort(h, kind="stable")
        lead = A.group_starts(h[order])
        back = np.empty(len(h), np.int64)
        back[order] = np.repeat(np.arange(len(lead)), np.diff(np.r_[lead, len(h)]))
        pick = order[lead]
        s, e = start[pick], end[pick]
        # cuts of a blank and something else are encoded together, the others one by one
        along = (data[s] == 32) & (e - s > 1)
        width = (e - s)[along]
        src = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width - s[along], width)
        joint = np.array(self.model.encode_ordinary(data[src].tobytes().decode()), np.uint32)
        until = np.searchsorted(np.cumsum(self.size[joint]), np.cumsum(width), side="right")
        alone = [self.model.encode_ordinary(raw[x:y].decode()) for x, y in zip(s[~along], e[~along], strict=True)]
        alone += [self.whole(raw[off[d] : off[d + 1]].decode()) for d in np.flatnonzero(slow)]
        # one row per distinct cut, then one per text that was encoded whole
        flat = np.concatenate([joint, *(np.array(x, np.uint32) for x in alone)])
        size = np.zeros(len(pick) + int(slow.sum()), np.int64)
        at = size.copy()
        size[: len(pick)][along] = np.diff(np.r_[0, until])
        at[: len(pick)][along] = np.r_[0, until[:-1]] if len(until) else until
        rest = np.r_[np.flatnonzero(~along), np.arange(len(pick), len(size))]
        size[rest] = [len(x) for x in alone]
        at[rest] = len(joint) + np.cumsum(size[rest]) - size[rest]
        row_doc = np.r_[doc, np.flatnonzero(slow)]
        row = np.r_[back, np.arange(len(pick), len(size))]
        if slow.any():
            o = np.argsort(row_doc, kind="stable")
            row_doc, row = row_doc[o], row[o]
        count = size[row]
        src = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - at[row], count)
        per = np.bincount(row_doc, weights=count, minlength=n).astype(np.int64)
        return flat[src], np.r_[0, np.cumsum(per)]


@cache
def byte_tokens(path: str) -> ByteTokens:
    """One per worker process."""
    return ByteTokens(path)
