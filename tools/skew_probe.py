"""Measure how one hot key spreads over tasks (numbers in docs/SCALE.md).

    python tools/skew_probe.py [--sf-dir DIR]

Derives skewed inputs from the given tables (every third event to user 0,
every third subscription to member 0, every third account acquired on one
day), runs the streaks, the exact-n sample on the hot key, the K15 fold, and
K14, K18, J6 and K16 with broadcasts disabled, all with partition coalescing
off, and prints,
per stage, the rows read and the most rows read by one task - taken from the
Spark event log written to a fresh scratch folder.
"""

from __future__ import annotations

import argparse
import glob
import io
import json
import os
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def stage_sizes(log_dir: str) -> dict[str, list[tuple[int, int, int, int]]]:
    import zstandard

    path = glob.glob(os.path.join(log_dir, "eventlog_v2_*", "events_*"))[0]
    raw = open(path, "rb").read()
    text = (zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
            if path.endswith(".zstd") else raw.decode())
    group, tasks = {}, {}
    for line in text.splitlines():
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            g = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e["Stage IDs"]:
                group[sid] = g
        elif e["Event"] == "SparkListenerTaskEnd":
            tm = e.get("Task Metrics") or {}
            read = max(tm.get("Shuffle Read Metrics", {}).get("Total Records Read", 0),
                       tm.get("Input Metrics", {}).get("Records Read", 0))
            tasks.setdefault(e["Stage ID"], []).append(read)
    out: dict[str, list[tuple[int, int, int, int]]] = {}
    for sid in sorted(tasks):
        recs = tasks[sid]
        out.setdefault(group.get(sid) or "-", []).append((sid, len(recs), sum(recs), max(recs)))
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    args = ap.parse_args()
    from pyspark.sql import functions as F

    from tallyframe.operators import joins
    from tallyframe.operators import matching as mt
    from tallyframe.operators import sampling as sm
    from tallyframe.operators import streaks as sk
    from tallyframe.plans import engagement as eg
    from tallyframe.plans import operations as op
    from tallyframe.plans import revenue as rv
    from tallyframe.plans.catalog import common as c
    from tallyframe.session import local_session

    log_dir = tempfile.mkdtemp(prefix="skew-probe-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark = local_session(8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                    "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    sc, d = spark.sparkContext, args.sf_dir
    ev = spark.read.parquet(f"{d}/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))

    sc.setJobGroup("streaks", "streaks")
    days = hot.groupBy(F.col("user_id").cast("string").alias("member_id"), F.to_date("ts").alias("activity_date")) \
        .agg((F.sum(F.col("value").cast("decimal(18,2)")) >= 50).alias("is_active_day"))
    sk.member_streaks(days, already_daily=True).write.format("noop").mode("overwrite").save()

    sc.setJobGroup("sample", "sample")
    sm.exact_n_sample(hot.select("event_id", "user_id", "event_type", "value"), "0.5", ["user_id"],
                      hot_rows=5000).write.format("noop").mode("overwrite").save()

    sc.setJobGroup("k15", "k15")
    subs = c.subscriptions(spark, d)
    subs = subs.withColumn("member_id", F.when(F.col("subscription_id").cast("bigint") % 3 == 0, F.lit("0"))
                           .otherwise(F.col("member_id")))
    eg.engagement_and_value(c.members(spark, d), c.accounts(spark, d), subs, c.plans(spark, d),
                            c.orders(spark, d), c.activity(spark, d)).write.format("noop").mode("overwrite").save()

    # the member-level side as if it were too large to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    joins.BROADCAST_BYTES = 0
    sc.setJobGroup("k14", "k14")
    rv.revenue_by_campaign(subs, c.members(spark, d), c.acquisition(spark, d), c.campaigns(spark, d)) \
        .write.format("noop").mode("overwrite").save()
    sc.setJobGroup("k18", "k18")
    op.billing_resolution(subs, c.members(spark, d), c.accounts(spark, d), c.plans(spark, d), hot_rows=10000) \
        .write.format("noop").mode("overwrite").save()
    sc.setJobGroup("k18_plain", "k18_plain")   # no key counts as hot: the plain shuffled join
    op.billing_resolution(subs, c.members(spark, d), c.accounts(spark, d), c.plans(spark, d), hot_rows=10**15) \
        .write.format("noop").mode("overwrite").save()
    # accounts: the members as accounts of their own, a third of them acquired on one campaign day
    campaigns = c.campaigns(spark, d)
    day = campaigns.agg(F.min("start_date")).first()[0]
    accounts = c.members(spark, d).select("member_id", "join_date").withColumn(
        "kind", F.lit(campaigns.filter(F.col("start_date") == day).first()["target_audience"])) \
        .withColumn("join_date", F.when(F.col("member_id").cast("bigint") % 3 == 0, F.lit(day)).otherwise(F.col("join_date")))
    kw = {"entity_key": "member_id", "entity_type": "kind", "entity_date": "join_date", "campaign_key": "campaign_id"}
    for name, hot_rows in (("", 500), ("_plain", 10**15)):
        sc.setJobGroup(f"j6{name}", "j6")
        mt.window_matches(accounts, campaigns, hot_rows=hot_rows, **kw).write.format("noop").mode("overwrite").save()
        sc.setJobGroup(f"k16{name}", "k16")
        mt.choose_match(accounts, campaigns, hot_rows=hot_rows, **kw).write.format("noop").mode("overwrite").save()
    spark.stop()

    for name, rows in stage_sizes(log_dir).items():
        if name == "-":
            continue
        print(f"== {name}")
        for sid, n, total, most in rows:
            print(f"   stage {sid:3d}: tasks={n:2d} rows read={total:7d} most by one task={most:7d}")
    print(f"event log: {log_dir}")


if __name__ == "__main__":
    main()
