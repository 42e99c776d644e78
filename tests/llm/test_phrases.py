"""Operator 12 against counting by hand."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import arrays as A
from tallyframe.llm import collocations as C


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def by_hand(rows, least, top):
    f, total = collections.Counter(), collections.Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und" if lang is None else lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    f[("und" if lang is None else lang, tuple(w[i:i + k]))] += 1
    out = collections.defaultdict(list)
    cands = {p: n for p, n in f.items() if len(p[1]) > 1 and n >= least}
    inner = collections.defaultdict(int)
    for (lang, g), n in cands.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                inner[lang, g[i:i + k]] = max(inner[lang, g[i:i + k]], n)
    for (lang, g), a in cands.items():
        if 100 * inner[lang, g] >= 100 * a:
            continue
        n = total[lang]
        score, _, l, r = min((1000 * a * n // (f[lang, g[:k]] * f[lang, g[k:]]), k, f[lang, g[:k]], f[lang, g[k:]]) for k in range(1, len(g)))
        out[lang].append((-score, -a, " ".join(g).encode(), l, r, n))
    return sorted((lang, k + 1, p.decode(), -a, l, r, n, -s) for lang, rows in out.items() for k, (s, a, p, l, r, n) in enumerate(sorted(rows)[:top]))


def got(spark, rows, settings, parts=3):
    df = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string").repartition(parts)
    df = df.select("*", *[F.lit(7).alias(c) for c in ("n", "gram", "words", "phrase", "score", "rank", "a")])
    return sorted(tuple(r) for r in C.collocations(df, settings).collect())


def corpus(seed):
    rng = random.Random(seed)
    common = [f"w{i}" for i in range(12)] + ["É", "the", "The", "x\x0by", "a\x00b"]
    fixed = [" ".join(rng.choices(common, k=rng.randrange(2, 9))) for _ in range(6)]
    out = []
    for _ in range(150):
        text = ""
        for _ in range(rng.randrange(12)):
            text += rng.choice([*fixed, *fixed, rng.choice(common), "\t \t", "rare%d" % rng.randrange(999)]) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "!", "; ", "\r"])
        out.append((rng.choice(["en", "en", "fr", None, "und", ""]), rng.choice([text, text, text, None, ""])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("settings", [
    C.Settings(least=8), C.Settings(least=3, top=15, slice_bytes=700, least_bits=7, most_bits=7, held_rows=40, fan_in=2, slices=8, hot_rows=5, shares=4)])
def test_against_counting(spark, seed, settings):
    rows = corpus(seed)
    want = by_hand(rows, settings.least, settings.top)
    assert want and got(spark, rows, settings) == want


def test_copies_long_texts_and_wide_numbers(spark):
    """Copies by the hundred, one long text in one piece, and a phrase no longer one accounts for."""
    rows = [("en", "one two three four five six seven.")] * 300 + [("en", "one two three. two three")] * 5
    rows += [("de", "ab cd " * 60_000), (None, "q " * 5000)]
    s = C.Settings(slice_bytes=100_000)
    assert got(spark, rows, s) == by_hand(rows, 100, 2000)


def test_rows_sent_follow_cores_not_splits(spark):
    """Splits too small for a task of their own are read together, so a gram is sent once per core at most."""
    cores = spark.sparkContext.defaultParallelism
    rows = [("en", f"a b c. w{i % 20} x. y w{i % 7}") for i in range(80 * cores)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(10 * cores)
    s = C.Settings(least=5)
    distinct = C.grams(df, s).count()
    assert distinct > 20 and C.sent_grams(df, s).count() <= cores * distinct
    apart = C.Settings(least=5, task_bytes=len("a b c"))                  # no split is joined to another
    assert C.sent_grams(df, apart).groupBy("lang", "gram", "words").agg(F.sum("n").alias("n")).exceptAll(C.grams(df, s)).isEmpty()


def test_common_grams_outlast_a_full_task(spark):
    """When a task holds too many grams it sends the rare ones; a gram that comes again and again is sent once."""
    rows = [("en", f"a b c. w{i % 100}. " * 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(1)
    sent = C.sent_grams(df, C.Settings(least=3, slice_bytes=700, held_rows=40)).collect()
    by_gram = collections.defaultdict(list)
    for r in sent:
        by_gram[r.gram].append(r.n)
    assert by_gram["a b c"] == [2000] and by_gram[""] == [8000]
    assert max(map(len, by_gram.values())) > 1 and all(sum(by_gram[f"w{i}"]) == 20 for i in range(100))


def test_products_beyond_64_bits(spark):
    big = 3 * 10**12
    rows = spark.createDataFrame([("en", "p q", big, 2)], "lang string, gram string, n long, words int")
    counts = spark.createDataFrame([("en", "p", big + 1), ("en", "q", 7 * big)], "lang string, gram string, n long")
    out = C.scored(rows, counts, spark.createDataFrame([("en", 10**15)], "lang string, n long"), C.Settings()).first()
    assert out.score == 1000 * big * 10**15 // ((big + 1) * 7 * big)


def test_nothing(spark):
    assert got(spark, [], C.Settings()) == []
    assert got(spark, [("en", None), (None, ""), ("fr", " \t.,")], C.Settings(least=1)) == []


def test_slices_end_at_pieces():
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab .,\n") for _ in range(rng.randrange(300))) for _ in range(40)] + ["x" * 2000]
    raw = [t.encode() for t in texts]
    offsets = A.np.cumsum([0, *map(len, raw)])
    data = A.np.frombuffer(b"".join(raw), A.np.uint8)
    cuts = list(C.piece_slices(data, offsets, 64))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(data) and all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(b in offsets or C.STOP[data[b - 1]] for _, b in cuts) and max(b - a for a, b in cuts[:-1]) < 200
