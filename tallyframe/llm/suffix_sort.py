"""Deep-shallow sorting of fixed-length suffixes, in numpy.

Shallow: multikey quicksort whose characters are eight bytes; suffixes that
agree in one character go one deeper, down to ``SHALLOW`` bytes.  Deep: the
groups that still agree are ordered by blind tries.  A group's first suffix
is the trie's spine; every other suffix is compared with it once, which gives
the length they share and the branching byte; suffixes that leave the spine
at the same place by the same byte form the node below it, whose bytes up to
there need not be looked at again.  All groups grow their tries together,
one level of nodes per round.
"""

from __future__ import annotations

import numpy as np

from tallyframe.llm import arrays as A

SHALLOW = 16


def words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number (zeros beyond the end)."""
    out = np.zeros(len(text), A.U64)
    padded = np.r_[text, np.zeros(8, np.uint8)]
    for i in range(8):
        out <<= A.U64(8)
        out |= padded[i : i + len(text)]
    return out


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many leading bytes two eight-byte numbers share (0 to 8)."""
    x, n = a ^ b, np.zeros(len(a), np.int64)
    n[x == 0] = 8
    rest = x != 0
    y, k = x[rest], np.zeros(int(rest.sum()), np.int64)
    for half in (32, 16, 8):
        high = y >> A.U64(64 - half) == 0
        k[high] += half // 8
        y = np.where(high, y << A.U64(half), y)
    n[rest] = k
    return n


def sort_suffixes(text: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes by their first ``length`` bytes (all inside the text), and where
    in that order each run of equal ones begins."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    w = words(text)
    # a last character with fewer bytes keeps only those inside the length
    def character(pos: np.ndarray, depth: int) -> np.ndarray:
        c = w[np.minimum(pos + depth, len(w) - 1)]
        inside = length - depth
        return c if inside >= 8 else c >> A.U64(8 * (8 - inside)) << A.U64(8 * (8 - inside))

    order = np.argsort(character(start, 0), kind="stable")
    new = np.zeros(len(order) + 1, bool)
    new[A.group_starts(character(start[order], 0))] = True
    new[-1] = True
    for depth in range(8, min(SHALLOW, length), 8):
        tied, group = open_groups(new)
        if not len(tied):
            return order, np.flatnonzero(new[:-1])
        c = character(start[order[tied]], depth)
        by = np.lexsort((c, group))
        order[tied] = order[tied[by]]
        new[tied[A.group_starts(group[by], c[by])]] = True
    # blind tries
    tied, group = open_groups(new)
    while len(tied) and SHALLOW < length:
        first = A.group_starts(group)
        size = np.diff(np.r_[first, len(group)])
        member = start[order[tied]]
        spine = np.repeat(member[first], size)
        share = np.full(len(tied), length, np.int64)
        byte_m, byte_s = np.zeros(len(tied), np.int64), np.zeros(len(tied), np.int64)
        going = np.arange(len(tied))
        for depth in range(SHALLOW, length, 8):
            a, b = character(member[going], depth), character(spine[going], depth)
            off = a != b
            at = going[off]
            share[at] = depth + shared_bytes(a[off], b[off])
            byte_m[at], byte_s[at] = text[member[at] + share[at]], text[spine[at] + share[at]]
            going = going[~off]
            if not len(going):
                break
        # before the spine: earlier exits first; after it: later exits first
        side = np.where(share == length, 1, np.where(byte_m < byte_s, 0, 2))
        exit_at = np.where(side == 0, share, np.where(side == 2, length - share, 0))
        key = ((group.astype(A.U64) << A.U64(26)) | (side.astype(A.U64) << A.U64(24)) | (exit_at.astype(A.U64) << A.U64(8)) | byte_m.astype(A.U64))
        by = np.argsort(key, kind="stable")
        order[tied] = order[tied[by]]
        key, equal = key[by], (side == 1)[by]
        node = A.group_starts(key)
        new[tied[node]] = True
        # the spine's equals are done; a node with one suffix is done
        many = np.diff(np.r_[node, len(key)])
        alive = np.repeat(many > 1, many) & ~equal
        number = np.repeat(np.arange(len(node)), many)
        tied, group = tied[alive], number[alive]
    return order, np.flatnonzero(new[:-1])


def open_groups(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in groups of two or more, number of each position's group)."""
    first = np.flatnonzero(new)
    size = np.diff(first)
    first = first[:-1]
    many = size > 1
    group = np.repeat(np.arange(int(many.sum())), size[many])
    tied = np.arange(len(group)) + np.repeat(first[many] - (np.cumsum(size[many]) - size[many]), size[many])
    return tied, group
