"""Operator 10: planted wordings, and brute force over every template and stretch."""

import random
import re
import textwrap

import numpy as np
import pytest

from tallyframe.llm import license_scan as L
from tallyframe.llm.license_texts import TEMPLATES, Template

TEXT = {(t.license, t.form): " ".join(t.text.split()) for t in TEMPLATES}
PROSE = ("the", "of", "and", "house", "under", "river", "license", "all", "version", "work", "is", "this", "public", "terms", "software", "reserved")


def prose(rng, n):
    return " ".join(rng.choice(PROSE) + rng.choice(["", "", ",", "."]) for _ in range(n))


def scan(make, rows, settings=L.Settings()):
    out = L.license_scan(make(rows), settings).collect()
    return {i: sorted((r.license, r.form, r.n_apart) for r in out if r.doc_id == i) for i in {r.doc_id for r in out}}, out


def test_notices(make):
    rows = [(1, "x y z\n" + TEXT["MIT", "notice"] + "\nmore"), (2, "w " * 300 + TEXT["GPL-3.0", "notice"] + " v" * 300), (3, "Licensed under the Apache Licence, Version 2.0"),
            (4, "the rights of the public version, reserved or licensed"), (5, None), (6, ""), (7, TEXT["CC-BY-NC-4.0", "notice"].upper()), (8, TEXT["CC-BY-4.0", "notice"]),
            (None, TEXT["all-rights-reserved", "notice"]), (9, "all rights not reserved at all by the license"), (10, "“All rights reserved” — © (all) [rights]: *reserved*")]
    got, out = scan(make, rows)
    assert got == {1: [("MIT", "notice", 0)], 2: [("GPL-3.0", "notice", 0)], 3: [("Apache-2.0", "notice", 1)], 7: [("CC-BY-NC-4.0", "notice", 0)],
                   8: [("CC-BY-4.0", "notice", 0)], 10: [("all-rights-reserved", "notice", 0)] * 2, None: [("all-rights-reserved", "notice", 0)]}
    assert {(r.doc_id, r.line, r.first_word, r.last_word) for r in out if r.doc_id in (1, 2)} == {(1, 1, 3, 7), (2, 0, 300, 300 + 11)}
    assert L.license_scan(make([])).collect() == []


def test_wrapped_dual_and_repeated(make):
    head = textwrap.wrap(TEXT["GPL-3.0", "header"], 60)
    rows = [(1, "Licensed under the Apache\nLicense, Version 2.0."), (2, "Released under the MIT License. All rights reserved."),
            (3, "\n".join("# " + x for x in head)), (4, "/*\n" + "\n".join(" * " + x for x in head) + "\n */\nint main"),
            (5, " ".join(TEXT[k, "notice"] for k in ("MIT", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "CC-BY-SA-4.0"))),
            (6, "All rights reserved. " * 5000), (7, "Either " + TEXT["MIT", "text"] + " or, at your option, " + TEXT["Apache-2.0", "header"])]
    got, _ = scan(make, rows)
    assert got == {1: [("Apache-2.0", "notice", 0)], 2: [("MIT", "notice", 0), ("all-rights-reserved", "notice", 0)],
                   3: [("GPL-3.0", "header", 0)], 4: [("GPL-3.0", "header", 0)],
                   5: [("BSD-3-Clause", "notice", 0), ("CC-BY-SA-4.0", "notice", 0), ("GPL-2.0", "notice", 0), ("GPL-3.0", "notice", 0), ("MIT", "notice", 0)],
                   6: [("all-rights-reserved", "notice", 0)] * 5000, 7: [("Apache-2.0", "header", 0), ("MIT", "text", 0)]}


@pytest.mark.parametrize("key", sorted(TEXT))
def test_every_wording_in_prose_and_with_changes(make, key):
    """Whole, and with a tenth of the words replaced, left out or added, between long runs of prose."""
    rng = random.Random(str(key))
    words = TEXT[key].split()
    changed = list(words)
    changes = len(words) // 10 if len(words) > 20 else 0        # one word of a short one may be all that tells it from another
    for k in sorted(rng.sample(range(1, len(words)), changes), reverse=True):
        kind = rng.randrange(3)
        changed[k:k + 1] = [["other%d" % k], [], [words[k], "added"]][kind]
    rows = [(1, prose(rng, 900) + "\n" + "\n".join(textwrap.wrap(TEXT[key], 50)) + "\n\n" + prose(rng, 900)), (2, prose(rng, 50) + " " + " ".join(changed) + " " + prose(rng, 50))]
    got, _ = scan(make, rows)
    assert got[1] == [(*key, 0)]
    assert [g[:2] for g in got[2]] == [key] and got[2][0][2] <= changes


def apart(template, words):
    """Fewest words put in, left out or replaced between the template and any stretch, by the plain table."""
    row = [0] * (len(words) + 1)
    for i, t in enumerate(template, 1):
        new = [i]
        for j, w in enumerate(words, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (t != w)))
        row = new
    return min(row)


def plain_words(text):
    return [x for x in (re.sub(r"^[\\W_]+|[\\W_]+$", "", w).lower() for w in text.split()) if x]


def test_brute_force(make):
    """A document has a row exactly if some template is near enough to some stretch of it."""
    rng = random.Random(9)
    some = (Template("a", "notice", "one two three four five six"), Template("b", "notice", "two three nine"), Template("c", "text", "x y " * 7 + "z"), Template("d", "notice", "solo"))
    pool = ["one", "two", "three", "four", "five", "six", "nine", "x", "y", "z", "other"]
    rows = []
    for i in range(400):
        words = rng.choices(pool, k=rng.randrange(25))
        if i % 2:
            t = rng.choice(some).text.split()
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = rng.choice(pool)
            words[5:5] = t
        rows.append((i, " ".join(words) + (" solo" if i % 50 == 0 else "")))
    got, out = scan(make, rows, L.Settings(templates=some))
    names = [t.license for t in some]
    for i, text in rows:
        near = {t.license: apart(t.text.split(), text.split()) for t in some if apart(t.text.split(), text.split()) <= int(0.2 * len(t.text.split()))}
        mine = [r for r in out if r.doc_id == i]
        assert bool(mine) == bool(near), (i, text, near)
        for r in mine:
            t = some[names.index(r.license)].text.split()
            assert r.n_apart == apart(t, text.split()[r.first_word:r.last_word + 1]) >= near[r.license]
        spans = sorted((r.first_word, r.last_word) for r in mine)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_nearest_stretches():
    rng = np.random.default_rng(2)
    for _ in range(60):
        template = rng.integers(1, 5, rng.integers(1, 9)).astype(np.uint64)
        block = rng.integers(1, 6, rng.integers(1, 40)).astype(np.uint64)
        best = apart(template.tolist(), block.tolist())
        got = L.nearest_stretches(template, block, len(template) - 1)
        assert (min(g[0] for g in got) == best) if best < len(template) else got == []
        assert all(apart(template.tolist(), block[a:b].tolist()) <= c for c, a, b in got)


def test_long_texts_are_scanned_whole(make):
    """Wordings at the seams of blocks, in one run of candidate words."""
    near = "released under the license and "                      # keeps the candidate range open
    text = "".join(near * rng + TEXT["MIT", "notice"] + " " for rng in range(0, 400, 7))
    got, _ = scan(make, [(1, text)])
    assert got[1].count(("MIT", "notice", 0)) == len(range(0, 400, 7))
