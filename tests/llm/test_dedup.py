"""Operators 2, 3 and 7 against brute force."""

import hashlib
import re

import pytest
from texts import corpus

from tallyframe.llm import jaccard_join, mail, substring_dedup, suffix_dedup

LAST = float("inf")
key = lambda i: LAST if i is None else i
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def first_of(rows, windows):
    first = {}
    for i, t in rows:
        for w in windows(t or ""):
            first[w] = min(first.get(w, LAST), key(i))
    return first


def bytes_removed(rows):
    windows = lambda t: (lambda b: [b[k : k + 50] for k in range(len(b) - 49)])(t.encode())
    first, out = first_of(rows, windows), []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k, w in enumerate(windows(t or "")):
            if first[w] < key(i):
                gone[k : k + 50] = b"\1" * 50
        spans = len([x for x in bytes(gone).split(b"\0") if x])
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def words_removed(rows):
    windows = lambda t: (lambda w: [tuple(w[k : k + 50]) for k in range(len(w) - 49)])(WORDS.findall(t))
    first, out = first_of(rows, windows), []
    for i, t in rows:
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for k, x in enumerate(windows(t or "")):
            if first[x] < key(i):
                gone[k : k + 50] = [True] * 50
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


def sets_of(rows):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    out = []
    for _, t in rows:
        w = WORDS.findall((t or "").translate(low))
        out.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def near_components(rows):
    sets, ids = sets_of(rows), [key(i) for i, _ in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b:
                same = len(a & b)
                if 100 * same >= 75 * (len(a) + len(b) - same):
                    x, y = find(ids[i]), find(ids[j])
                    root[max(x, y)] = min(x, y)
    name = lambda x: None if x == LAST else x
    return sorted(((name(i), len(s), name(find(i))) for i, s in zip(ids, sets)), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(make, seed):
    rows = corpus(seed)
    got = suffix_dedup.dedup(make(rows)).collect()
    assert sorted(map(tuple, got), key=str) == bytes_removed(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_words(make, seed):
    rows = corpus(seed)
    got = substring_dedup.dedup(make(rows)).collect()
    assert sorted(map(tuple, got), key=str) == words_removed(rows)


def test_words_with_a_full_sketch(make, monkeypatch):
    """A sketch that is far too small lets everything through to the exact pass."""
    monkeypatch.setattr(substring_dedup, "LEAST_BITS", 6)
    monkeypatch.setattr(substring_dedup, "MOST_BITS", 9)
    monkeypatch.setattr(substring_dedup, "SLICES", 4)
    rows = corpus(5)
    got = substring_dedup.dedup(make(rows)).collect()
    assert sorted(map(tuple, got), key=str) == words_removed(rows)


def test_words_carries_columns_and_text(make):
    rows = [(1, "a " * 60), (2, "x  y " + "a " * 60), (3, None), (4, "short\n text")]
    got = {r.doc_id: (r.text, r.lang) for r in substring_dedup.dedup(make(rows), carry=["lang", "n_words"], keep_text=True).collect()}
    assert got == {1: ("a " * 60, None), 2: ("x y", None), 3: (None, None), 4: ("short\n text", None)}


@pytest.mark.parametrize("seed,frequent", [(6, 64), (7, 3), (8, 2)])
def test_near_components(make, monkeypatch, seed, frequent):
    """Also with nearly every shingle counted as frequent, and with groups counted as large."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", frequent)
    rows = corpus(seed, 90)
    got = jaccard_join.join(make(rows)).collect()
    assert sorted(map(tuple, got), key=str) == near_components(rows)


def test_near_components_small_sets(make):
    """Sets of a few shingles, where one shingle decides."""
    rows = [(10 * n + k, " ".join(f"v{n}_{x}" for x in range(n)) + (f" end{k}" if k else "")) for n in range(1, 26) for k in range(3)]
    assert sorted(map(tuple, jaccard_join.join(make(rows)).collect()), key=str) == near_components(rows)


def test_empty_tables(make):
    assert suffix_dedup.dedup(make([])).collect() == []
    assert substring_dedup.dedup(make([])).collect() == []
    assert jaccard_join.join(make([])).collect() == []


def test_very_long_text(make):
    text = " ".join(f"t{i % 70001}" for i in range(200_000))
    rows = [(1, text), (2, "z " + " ".join(text.split()[:800]) + " z"), (3, text)]
    words = {r.doc_id: r.n_removed for r in substring_dedup.dedup(make(rows)).collect()}
    assert words[1] == 0 and words[2] == 800 and words[3] == 200_000
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in suffix_dedup.dedup(make(rows)).collect()}
    assert got[1] == (0, 0) and got[3] == (len(text), 1) and got[2][0] >= 3000
    assert {r.doc_id: r.component_id for r in jaccard_join.join(make(rows)).collect()} == {1: 1, 2: 2, 3: 1}


def test_messages_round_trip():
    import numpy as np

    a, b = np.arange(5, dtype=np.uint64), np.array([-1, 2], np.int64)
    x, y = mail.unpack(mail.pack(a, b))
    assert x.dtype == a.dtype and (x == a).all() and y.dtype == b.dtype and (y == b).all()


def test_components_with_a_hub(spark, monkeypatch):
    """One node with very many links, long paths, and loops."""
    from tallyframe.llm import components as C
    monkeypatch.setattr(C, "HOT_ROWS", 20)
    monkeypatch.setattr(C, "HOT_KEYS", 50)
    links = [(500, k) for k in range(501, 900)] + [(k, k + 1) for k in range(1000, 1012)] + [(7, 7), (3, 500), (1012, 2000), (2000, 999)]
    got = {r.id: r.component for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {3: 3, 500: 3, **{k: 3 for k in range(501, 900)}, **{k: 999 for k in (999, 2000, *range(1000, 1013))}}


def test_near_components_with_hot_classes_and_leaders(make, monkeypatch):
    """A class of many copies, and a group of many near copies, whose keys are split."""
    monkeypatch.setattr(jaccard_join, "HOT_ROWS", 5)
    monkeypatch.setattr(jaccard_join, "HOT_KEYS", 10**6)
    base = [f"u{k}" for k in range(80)]
    rows = corpus(9, 30) + [(5000 + k, " ".join(base)) for k in range(40)]
    rows += [(6000 + k, " ".join(base[:k] + ["other"] + base[k + 1:])) for k in range(2, 78)]
    assert sorted(map(tuple, jaccard_join.join(make(rows)).collect()), key=str) == near_components(rows)
