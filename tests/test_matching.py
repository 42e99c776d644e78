from pyspark.sql import functions as F

import datetime as dt
import random

import pytest

from helpers import d, plan_text, rows
from tallyframe.operators import joins
from tallyframe.operators import matching as mt


def fixture(spark):
    accounts = spark.createDataFrame([
        ("equal_start", "ind", d("2024-01-10")), ("equal_end_plus_45", "ind", d("2024-03-16")),
        ("day_before_start", "ind", d("2024-01-09")), ("day_after_window", "ind", d("2024-03-17")),
        ("audience_mismatch", "org", d("2024-01-15")), ("several", "ind", d("2024-02-01")),
        ("no_date", "ind", None)], "account_id string, account_type string, acquisition_date date")
    campaigns = spark.createDataFrame([
        ("c1", "ind", d("2024-01-10"), d("2024-01-31")),
        ("c2", "ind", d("2024-01-20"), d("2024-02-10")),
        ("c3", "org", d("2023-06-01"), d("2023-06-30"))],
        "campaign_id string, target_audience string, start_date date, end_date date")
    return accounts, campaigns


def test_window_matches_edges(spark):
    a, c = fixture(spark)
    pairs = mt.window_matches(a, c, entity_key="account_id", entity_type="account_type",
                              entity_date="acquisition_date", campaign_key="campaign_id")
    assert rows(pairs, "account_id", "campaign_id") == sorted([
        ("equal_start", "c1"), ("equal_end_plus_45", "c1"), ("several", "c1"), ("several", "c2"),
        ("equal_end_plus_45", "c2"),
        ("day_after_window", "c2")])  # one day past c1's window, inside c2's


def test_window_matches_equals_brute_force(spark):
    a, c = fixture(spark)
    pairs = mt.window_matches(a, c, entity_key="account_id", entity_type="account_type",
                              entity_date="acquisition_date", campaign_key="campaign_id")
    brute = a.join(c, (a.account_type == c.target_audience)
                   & a.acquisition_date.between(c.start_date, F.date_add(c.end_date, 45)))
    assert rows(pairs, "account_id", "campaign_id") == rows(brute, "account_id", "campaign_id")


def test_choose_one_and_quota(spark):
    a, c = fixture(spark)
    pairs = mt.window_matches(a, c, entity_key="account_id", entity_type="account_type",
                              entity_date="acquisition_date", campaign_key="campaign_id")
    chosen = mt.choose_one(pairs, "account_id", "campaign_id")
    assert chosen.count() == 4 and chosen.select("account_id").distinct().count() == 4
    chosen = mt.choose_match(a, c, entity_key="account_id", entity_type="account_type",
                             entity_date="acquisition_date", campaign_key="campaign_id")
    assert chosen.count() == 4 and chosen.select("account_id").distinct().count() == 4
    assert chosen.join(pairs, ["account_id", "campaign_id"], "left_anti").count() == 0
    attributed = mt.attribute_accounts(a, c, fraction="0.55")
    # 6 accounts have a date -> quota floor(3.3) = 3, filled from the 4 eligible ones
    assert attributed.count() == 3
    assert attributed.join(chosen, ["account_id", "campaign_id"], "left_anti").count() == 0
    attributed_small = mt.attribute_accounts(a, c, fraction="0.34")
    assert attributed_small.count() == 2


def test_semi_join(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (3,), (9,)], "k int")
    assert rows(mt.with_match(left, right, "k", "k")) == [(1,), (3,)]


def test_skew_split_join_equals_plain_join(spark):
    from tallyframe.operators.joins import skew_split_join
    big = spark.createDataFrame([(0, i) for i in range(500)] + [(k, k) for k in range(1, 200)] + [(999, 1)],
                                "k int, v int")
    small = spark.createDataFrame([(k, f"s{k}") for k in range(0, 150)] + [(0, "again")], "k int, w string")
    for how in ("inner", "left"):
        plain = rows(big.join(small, "k", how), "k", "v", "w")
        split = rows(skew_split_join(big, small, "k", how, hot_rows=100), "k", "v", "w")
        assert split == plain, how
        assert rows(skew_split_join(big, small, "k", how), "k", "v", "w") == plain   # no hot key


def test_window_matches_with_a_hot_audience_month(spark, monkeypatch):
    a, c = fixture(spark)
    hot = a.unionByName(spark.createDataFrame([(f"h{i}", "ind", d("2024-02-05")) for i in range(300)],
                                              "account_id string, account_type string, acquisition_date date"))
    kw = dict(entity_key="account_id", entity_type="account_type", entity_date="acquisition_date",
              campaign_key="campaign_id")
    plain = rows(mt.window_matches(hot, c, **kw), "account_id", "campaign_id")
    assert len(plain) == 5 + 1 + 600
    one = rows(mt.choose_match(hot, c, **kw), "account_id", "campaign_id")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)      # nothing is small enough to broadcast
    assert rows(mt.window_matches(hot, c, hot_rows=50, **kw), "account_id", "campaign_id") == plain
    assert rows(mt.choose_match(hot, c, hot_rows=50, **kw), "account_id", "campaign_id") == one


def test_choose_match_null_reversed_and_repeated_campaigns(spark):
    a, c = fixture(spark)
    odd = spark.createDataFrame([("c4", "ind", None, d("2024-05-01")), ("c5", "ind", d("2024-05-01"), d("2023-01-01")), ("c1", "ind", d("2024-01-10"), d("2024-01-31"))],
                                c.schema)
    args = {"entity_key": "account_id", "entity_type": "account_type", "entity_date": "acquisition_date", "campaign_key": "campaign_id"}
    assert rows(mt.choose_match(a, c.unionByName(odd), **args)) == rows(mt.choose_match(a, c, **args))


def test_choose_match_makes_no_pairs(spark):
    """Rows out of every join are bounded by the entities."""
    a, c = fixture(spark)
    many = spark.range(200).select(F.concat(F.lit("x"), "id").alias("campaign_id"), F.lit("ind").alias("target_audience"),
                                   F.lit("2024-01-01").cast("date").alias("start_date"), F.lit("2024-02-01").cast("date").alias("end_date"))
    out = mt.choose_match(a, many, entity_key="account_id", entity_type="account_type", entity_date="acquisition_date", campaign_key="campaign_id")
    assert out.count() == out.select("account_id").distinct().count() == 5
    days = mt.campaign_days(many, campaign_key="campaign_id")
    assert days.groupBy("__type", "__day").agg(F.max("__rank").alias("r"), F.max("__open").alias("o")).filter("r <> 200 or o <> 200").count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_lookup_join_equals_plain_join(spark, monkeypatch, how, limit):
    big = spark.createDataFrame([(0, i) for i in range(500)] + [(None, i) for i in range(300)] + [(k, k) for k in range(1, 200)], "k int, v int")
    small = spark.createDataFrame([(k, f"s{k}") for k in range(0, 150)] + [(0, "again"), (None, "never")], "k int, w string")
    plain = rows(big.join(small, "k", how), "k", "v", "w")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    for hot_rows in (100, 10**6):
        assert rows(joins.lookup_join(big, small, "k", how, hot_rows), "k", "v", "w") == plain
    assert rows(joins.lookup_join(big, joins.measured(small), ["k"], how, 100), "k", "v", "w") == plain
    with pytest.raises(ValueError):
        joins.lookup_join(big, small, "k", "full")


def test_heavy_keys(spark):
    df = spark.range(100_000).selectExpr("if(id % 3 = 0, 'hot', if(id % 10 = 1, null, cast(id as string))) as a", "1 as b").repartition(6)
    want = {r.h: r.n for r in df.groupBy(F.xxhash64("a", "b").alias("h")).agg(F.count(F.lit(1)).alias("n")).filter("n > 5000").collect()}
    assert dict(joins.heavy_keys(df, ["a", "b"], 5000)) == {h: -(-n // 5000) for h, n in want.items()} and len(want) == 2
    assert joins.heavy_keys(df, ["a", "b"], 50_000) == []
    assert joins.heavy_keys(df.filter("b > 1"), ["a"], 1) == []


def test_a_look_up_that_fits_reads_the_big_side_once(spark, scratch):
    path = f"{scratch}/big"
    spark.range(1000).selectExpr("id", "id % 5 as k").write.parquet(path)
    plan = plan_text(joins.lookup_join(spark.read.parquet(path), spark.range(5).withColumnRenamed("id", "k"), "k"))
    assert plan.count("FileScan parquet") == 1 and "Exchange hashpartitioning" not in plan


def test_dyadic_ranges_cover_each_day_once(spark):
    rng = random.Random(5)
    spans = [(0, 0), (3, 2), (7, 8), (1, 4096), (0, 8191), (100, 20_000)] + [(a, a + rng.randrange(400)) for a in rng.sample(range(30_000), 40)]
    first = dt.date(1950, 1, 1)
    df = spark.createDataFrame([(i, first + dt.timedelta(a), first + dt.timedelta(b)) for i, (a, b) in enumerate(spans)] + [(-1, None, first)], "i int, a date, b date")
    got = {r.i: [tuple(x) for x in r.r] for r in df.select("i", mt.dyadic_ranges(F.col("a"), F.col("b")).alias("r")).collect()}
    base = first.toordinal() - 1
    for i, (a, b) in enumerate(spans):
        days = sorted(k for size, block in got[i] for k in range(block << size, (block + 1) << size))
        assert days == list(range(base + a, base + b + 1))
        assert b - a > 8000 or len(got[i]) <= 2 * mt.DYADIC_LEVELS
    assert got[-1] == []


def test_window_matches_over_random_windows(spark):
    rng = random.Random(6)
    day = lambda: d("2020-01-01") + dt.timedelta(rng.randrange(900))
    a = spark.createDataFrame([(f"a{i}", rng.choice("xyz"), rng.choice([day(), None, day()])) for i in range(300)], "account_id string, account_type string, acquisition_date date")
    c = spark.createDataFrame([(f"c{i % 35}", rng.choice(["x", "y", None]), rng.choice([day(), None, day()]), rng.choice([day(), day(), None])) for i in range(40)],
                              "campaign_id string, target_audience string, start_date date, end_date date")
    got = mt.window_matches(a, c, entity_key="account_id", entity_type="account_type", entity_date="acquisition_date", campaign_key="campaign_id")
    brute = a.join(c, (a.account_type == c.target_audience) & a.acquisition_date.between(c.start_date, F.date_add(c.end_date, 45)))
    assert rows(got, "account_id", "campaign_id") == rows(brute, "account_id", "campaign_id") and got.count() > 100


def test_campaign_days_are_made_in_spread_tasks_and_never_broadcast_by_an_estimate(spark, monkeypatch):
    """One file of campaigns: no task folds all days, and days measured too large are merged (an explode looks small to the planner)."""
    a, c = fixture(spark)
    key = {"campaign_key": "campaign_id"}
    days = mt.open_campaigns(c.unionByName(c).coalesce(1), task_days=5, **key)
    made = days.withColumn("task", F.spark_partition_id())
    assert days.rdd.getNumPartitions() > 1 and made.select("task").distinct().count() > 1
    assert rows(days, "campaign_id", "__day") == rows(mt.campaign_days(c, **key), "campaign_id", "__day")
    args = {"entity_key": "account_id", "entity_type": "account_type", "entity_date": "acquisition_date", **key}
    want = rows(mt.choose_match(a, c, **args), "account_id", "campaign_id")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    out = mt.choose_match(a, c, **args)
    assert rows(out, "account_id", "campaign_id") == want and len(want) == 4
    assert plan_text(out).count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan_text(out)
