import pytest
from pyspark.sql import functions as F

from helpers import rows
from tallyframe.operators import calendar as cal
from tallyframe.operators import sampling as sm


@pytest.mark.parametrize("n_keys", [0, 1, 10, 10000])
@pytest.mark.parametrize("fraction", ["0", "1", "0.35"])
def test_exact_n(spark, n_keys, fraction):
    df = spark.range(n_keys).withColumnRenamed("id", "k")
    got = sm.exact_n_sample(df, fraction, ["k"])
    want = int(__import__("decimal").Decimal(fraction) * n_keys)
    assert got.count() == want
    assert got.select("k").distinct().count() == want


def test_exact_n_stable_under_repartition(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    a = rows(sm.exact_n_sample(df.repartition(3), "0.2", ["k"]))
    b = rows(sm.exact_n_sample(df.repartition(17, "k"), "0.2", ["k"]))
    assert a == b and len(a) == 1000


def test_dense_number_is_a_permutation(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    n = sm.dense_number(df, ["k"])
    assert sorted(r.row_no for r in n.collect()) == list(range(1, 3001))
    again = sm.dense_number(df.repartition(7), ["k"])
    assert rows(n) == rows(again)


def test_weighted_assign_shares(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    out = sm.weighted_assign(df, ["k"], ["a", "b"], ["0.75", "0.25"], "lab")
    share = out.filter("lab = 'a'").count() / 20000
    assert 0.73 < share < 0.77
    assert sm.cumulative_thresholds(["1", "1"]) == [2 ** 31, 2 ** 32]


def test_replicate_and_zip(spark):
    df = spark.createDataFrame([("x", 2), ("y", 0), ("z", None), ("w", 1)], "k string, n int")
    assert rows(sm.replicate_rows(df, "n"), "k", "copy_no") == [("w", 1), ("x", 1), ("x", 2)]
    a = spark.range(5).withColumnRenamed("id", "a")
    b = spark.range(3).withColumnRenamed("id", "b")
    z = sm.zip_by_rank(a, ["a"], b, ["b"])
    assert z.count() == 3 and sorted(r.pair_no for r in z.collect()) == [1, 2, 3]


def test_spine_and_reanchor(spark):
    import datetime as dt
    d = dt.date.fromisoformat
    ents = spark.createDataFrame([("early", d("2020-01-01")), ("late", d("2024-01-29")),
                                  ("future", d("2024-02-05")), ("none", None)], "k string, j date")
    spine = cal.entity_day_spine(ents, "k", "j", d("2024-01-30"), window_days=3)
    got = rows(spine.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("activity_date").alias("first")))
    assert got == [("early", 3, d("2024-01-28")), ("late", 2, d("2024-01-29")), ("none", 3, d("2024-01-28"))]
    seq = spark.createDataFrame([("u", d("2016-04-12")), ("u", d("2016-04-15")), ("u", d("2016-05-01")),
                                 ("v", d("2016-04-01"))], "k string, dt date")
    moved = cal.reanchor(seq.withColumn("j", F.lit(d("2024-01-29"))), "k", "dt", d("2024-01-30"), join_col="j")
    assert rows(moved, "k", "dt", "activity_date") == [("u", d("2016-04-15"), d("2024-01-29")),
                                                       ("u", d("2016-05-01"), d("2024-01-30")),
                                                       ("v", d("2016-04-01"), d("2024-01-30"))]


def test_bootstrap_jitter_bounds(spark):
    import datetime as dt
    spine = spark.createDataFrame([(f"m{i}", dt.date(2024, 1, 1)) for i in range(200)], "member_id string, day date")
    pool = spark.createDataFrame([("p", dt.date(2024, 1, 1), 1000, __import__("decimal").Decimal("10.00"))],
                                 "member_id string, day date, steps bigint, km decimal(18,2)")
    out = cal.bootstrap(spine, ["member_id", "day"], pool, ["member_id", "day"], {"steps": "int", "km": "decimal"})
    vals = out.collect()
    assert len(vals) == 200
    assert all(850 <= r.steps <= 1150 and 8.5 <= float(r.km) <= 11.5 for r in vals)


def _hot_frame(spark):
    data = [(0, "same")] * 3000 + [(k, f"v{k}") for k in range(1, 6001)] + [(7001, "other")] * 5
    return spark.createDataFrame(data, "k long, v string")


def test_hot_buckets_number_like_cold_ones(spark):
    df = _hot_frame(spark)
    hot = sm.dense_number(df, ["k"], hot_rows=50)
    cold = sm.dense_number(df, ["k"])
    got = rows(hot, "k", "v", "row_no")
    assert sorted(r[2] for r in got) == list(range(1, 9006))
    assert got == rows(cold, "k", "v", "row_no")
    # the hot path really ran: collapsed copies were expanded again
    text = hot._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" in text


def test_hot_buckets_sample_like_cold_ones(spark):
    df = _hot_frame(spark)
    for frac in ("0.2", "0.5", "0.9"):
        a = rows(sm.exact_n_sample(df, frac, ["k"], hot_rows=50), "k", "v")
        b = rows(sm.exact_n_sample(df, frac, ["k"]), "k", "v")
        assert a == b and len(a) == int(__import__("decimal").Decimal(frac) * 9005)


def test_expand_splits_large_counts(spark):
    df = spark.createDataFrame([("a", 25), ("b", 3), ("c", 0)], "k string, n int")
    out = sm.replicate_rows(df, "n", chunk=10)
    got = rows(out, "k", "copy_no")
    assert got == sorted([("a", i) for i in range(1, 26)] + [("b", i) for i in range(1, 4)],
                         key=lambda t: tuple((x is None, str(x)) for x in t))


def test_hot_key_with_distinct_rows(spark):
    """One key shared by many different rows: split inside the hot bucket,
    numbers still a bijection, sample exact and independent of partitioning."""
    data = [(0, f"r{i}") for i in range(2000)] + [(k, "u") for k in range(1, 3001)]
    df = spark.createDataFrame(data, "k long, v string")
    n = sm.dense_number(df, ["k"], hot_rows=100)
    assert sorted(r.row_no for r in n.collect()) == list(range(1, 5001))
    assert rows(n) == rows(sm.dense_number(df.repartition(7), ["k"], hot_rows=100))
    a = rows(sm.exact_n_sample(df, "0.4", ["k"], hot_rows=100))
    b = rows(sm.exact_n_sample(df.repartition(5, "v"), "0.4", ["k"], hot_rows=100))
    assert a == b and len(a) == 2000


def _awkward(spark, n):
    """One key with distinct contents, nulls and exact copies, another hot key, and ordinary keys."""
    data = [(0, f"r{i}", i % 3) for i in range(n)] + [(0, "same", 1)] * n + [(0, None, None)] * 7 + [(None, None, 2)] * 9 + [(None, f"n{i}", None) for i in range(n // 2)]
    data += [(k, "u", k % 5) for k in range(1, 2 * n)]
    return spark.createDataFrame(data, "k long, v string, w long")


@pytest.mark.parametrize("hot_rows", [1, 10, 37])
def test_hot_and_cold_paths_give_the_same_rows_and_numbers(spark, hot_rows):
    df = _awkward(spark, 90)
    assert rows(sm.dense_number(df, ["k"], hot_rows=hot_rows)) == rows(sm.dense_number(df, ["k"]))
    for frac in ("0.1", "0.5", "0.83"):
        assert rows(sm.exact_n_sample(df, frac, ["k"], hot_rows=hot_rows)) == rows(sm.exact_n_sample(df, frac, ["k"]))


def test_serve_in_order(spark):
    from tallyframe.operators.quality import CapacityError
    need = spark.createDataFrame([("a", 2), ("b", 0), ("c", None), ("d", 3), ("e", -1)], "k string, n int")
    pool = spark.range(6).withColumnRenamed("id", "p")
    got = rows(sm.serve_in_order(need, ["k"], "n", pool, ["p"]), "pair_no", "k")
    assert [n for n, _ in got] == [1, 2, 3, 4, 5]
    assert [k for _, k in got] in (["a", "a", "d", "d", "d"], ["d", "d", "d", "a", "a"])
    with pytest.raises(CapacityError):
        sm.serve_in_order(need, ["k"], "n", spark.range(4).withColumnRenamed("id", "p"), ["p"])


def test_bootstrap_looks_the_pool_up_or_shuffles_it(spark, monkeypatch):
    """The spine is not shuffled for a pool that fits; either way the rows are the same, and an empty pool gives none."""
    import datetime as dt
    from decimal import Decimal
    from tallyframe.operators import joins
    spine = spark.createDataFrame([(f"m{i}" if i % 9 else None, dt.date(2024, 1, 1 + i % 28)) for i in range(300)], "member_id string, day date")
    pool = spark.createDataFrame([(f"p{i % 20}", dt.date(2024, 1, 1 + i % 28), i, Decimal(i)) for i in range(90)],
                                 "member_id string, day date, steps bigint, km decimal(18,2)")
    args = (["member_id", "day"], {"steps": "int", "km": "decimal"})
    out = cal.bootstrap(spine, ["member_id", "day"], pool, *args)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast") == 2      # the pool, and its numbering
    got = rows(out)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    out = cal.bootstrap(spine, ["member_id", "day"], pool, *args)
    assert "strategy=shuffle_hash" in out._jdf.queryExecution().optimizedPlan().toString()
    assert rows(out) == got and len(got) == 300
    assert cal.bootstrap(spine, ["member_id", "day"], pool.limit(0), *args).count() == 0


def test_numbering_shuffles_no_content_hash(spark):
    df = spark.createDataFrame([(k % 7, f"v{k}") for k in range(100)], "k long, v string")
    plan = sm.dense_number(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("xxhash64") < plan.index("Exchange hashpartitioning") and plan.count("Exchange hashpartitioning") == 1


def test_padded_id_is_what_the_formatter_writes(spark):
    from tallyframe.functions.exprs import padded_id
    df = spark.createDataFrame([(n,) for n in (0, 42, 9_999_999, 10_000_000, 123_456_789_012, -5, -12_345_678, None)], "n long")
    for r in df.select(padded_id("a-b", "n").alias("got"), F.format_string("a-b_%07d", "n").alias("want")).collect():
        assert r.got == r.want
