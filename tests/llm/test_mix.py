"""Operator 13: targets, the merged stream and what each document gives."""

import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallyframe.llm import fair_mix as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def water_fill(size, weight, total, most=3):
    """Targets by repeated resharing, in fractions."""
    full, left = {}, dict(size)
    while left:
        share = Fraction(total - sum(full.values()), sum(weight[s] for s in left))
        over = [s for s in left if share * weight[s] > most * size[s]]
        if not over:
            return full | {s: share * weight[s] for s in left}
        for s in over:
            full[s] = Fraction(most * left.pop(s))
    return full


def frame(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(parts)
    return df.select("*", *[F.lit("x").alias(c) for c in ("size", "target", "taken", "__part", "__copy", "round", "copies", "weight")])


def words(n, tag=""):
    return " ".join(f"w{tag}{i}" for i in range(n))


ROWS = [(i, ["b", "a", None, "c", "z", "", "é"][i % 7], words(i % 13 * (40 if i % 7 == 0 else 3))) for i in range(400)]
ROWS += [(1000, "a", None), (1001, "a", ""), (1002, "a", " \t\n"), (None, None, words(9)), (None, "b", None), (7, "tiny", words(1)), (8, "empty", "")]
ROWS += [(2000, "b", words(5))] * 6 + [(3000, "d", words(5000))] + [(4000, "e", "\n\x0b a\x00b \r\n ü,ö\x1f ")]


@pytest.fixture(scope="module")
def stream(spark):
    return M.mix(frame(spark, ROWS), settings=M.Settings(bucket_rows=16)).cache()


def test_targets_and_shares(stream):
    size = {}
    for _, s, t in ROWS:
        size[s] = size.get(s, 0) + len(WORD.findall(t or ""))
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    want = water_fill(size, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, sum(size.values()))
    got = M.per_document(stream).collect()
    assert len(got) == len(ROWS)
    taken = dict.fromkeys(size, 0)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-12)
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert sum(taken.values()) == sum(size.values())
    assert all(abs(taken[s] - want[s]) <= len(size) for s in size)
    assert sorted((r.doc_id, r.source, r["size"]) for r in got if r.doc_id and r.source) == \
        sorted((d, s, len(WORD.findall(t or ""))) for d, s, t in ROWS if d and s)


def test_stream_is_in_order_of_virtual_time(stream):
    rows = [r for r in stream.collect() if r.length]
    rows.sort(key=lambda r: r.position)
    at, served = 0, {}
    for before, r in zip([None, *rows], rows):
        assert before is None or before.finish <= r.finish
        assert r.position == at
        at += r.length
        served[r.source] = served.get(r.source, 0) + r.length
        assert r.finish == pytest.approx(served[r.source] / r.target, rel=1e-12)   # finish: words its source has queued, over its target
    assert all(r.taken == max(0, min(r.length, len_all(ROWS) - r.position)) for r in rows)


def len_all(rows):
    return sum(len(WORD.findall(t or "")) for _, _, t in rows)


def test_reruns_and_layouts_agree(spark, stream):
    key = lambda df: sorted(M.per_document(df).collect(), key=str)
    assert key(stream) == key(M.mix(frame(spark, ROWS[::-1], 11), settings=M.Settings(bucket_rows=16)))
    assert key(stream) == key(M.mix(frame(spark, ROWS, 1), settings=M.Settings(bucket_rows=100_000)))


def test_budget_and_texts(spark):
    docs = frame(spark, ROWS)
    out = M.mix(docs, budget=700)
    assert out.agg(F.sum("taken")).first()[0] == 700
    texts = M.mixed_words(docs, out).collect()
    assert sum(len(WORD.findall(r.text)) for r in texts) == 700
    by = {(d, s): WORD.findall(t or "") for d, s, t in ROWS}
    for r in texts:
        got, all_ = WORD.findall(r.text), by[r.doc_id, r.source]
        assert any(all_[k:k + len(got)] == got for k in range(len(all_)))


def test_empty_and_wordless(spark):
    assert M.per_document(M.mix(frame(spark, []))).collect() == []
    got = M.per_document(M.mix(frame(spark, [(1, "a", ""), (2, None, None)]))).collect()
    assert sorted((r.doc_id, r["size"], r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_word_count(spark):
    texts = ["", " ", "a", " a", "a ", "a b", "\ta\x0b\x0cb\r\nc ", "x\x00y", " ", "é　z", "a" * 100_000, "a " * 50_000, None]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", M.word_count(F.col("t")).alias("n")).collect()
    assert {r.i: r.n for r in got} == {i: len(WORD.findall(t or "")) for i, t in enumerate(texts)}


def test_only_dataframe_operators(spark):
    plan = M.per_document(M.mix(frame(spark, ROWS[:50])))._jdf.queryExecution().toString()
    assert not any(k in plan for k in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
