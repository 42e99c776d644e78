"""Binding of the driver's parquet tables to the library's raw text shapes.

The models expect the raw tables of a subscription business (accounts,
members, plans, subscriptions, workouts, orders, tickets, campaigns,
acquisition), every column text, as a CSV export would deliver them.  The
test data is a TPC-H-like star schema plus an event stream; the functions
below derive the raw shapes from it with Spark expressions only, so every
query's work grows with the input tables.

Only the columns a model needs are read (column pruning reaches the parquet
scan), and all derivations are per-row expressions or map-side combined
aggregates.  The same definitions are written in SQL for the DuckDB oracle
in :mod:`tallyframe.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..fixed_values import CHANNELS, ORDER_TYPES, SEED  # noqa: F401  (SEED is re-exported for the catalog)

ORDERS_AS_OF = dt.date(2001, 12, 31)
CAMPAIGN_EPOCH = dt.date(1995, 1, 1)
ACTIVE_VALUE_THRESHOLD = 50
MONEY = "decimal(18,2)"

_SCHEMAS: dict[tuple, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables.  The footer schema is read once per state of the
    file; later reads pass it explicitly, so building a plan runs no Spark job."""
    path = f"{sf_dir}/{name}.parquet"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getFileStatus(at)
    key = (path, status.getModificationTime(), status.getLen())
    schema = _SCHEMAS.get(key)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[key] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


def _text(c: Column) -> Column:
    return c.cast("string")


def _day(c: str) -> Column:
    return F.to_date(F.col(c))


def _money_text(c: Column) -> Column:
    return c.cast(MONEY).cast("string")


# --------------------------------------------------------------------------- raw text shapes


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per nation; type = its region name; rate blank for odd keys."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    odd = (F.col("n_nationkey") % 2) == 1
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        _text(F.col("n_nationkey")).alias("account_id"),
        F.col("r_name").alias("account_type"),
        F.col("n_name").alias("account_name"),
        F.when(odd, F.lit("")).otherwise(F.concat(F.lit("industry_"), _text(F.col("n_regionkey")))).alias("industry"),
        F.lit("active").alias("status"),
        F.when(odd, F.lit("")).otherwise(_text(F.lit(8) + F.col("n_nationkey") % 7)).alias("per_member_rate"),
    )


def member_join_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earliest order day per customer (A12 on the orders table)."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_custkey").agg(F.min(_day("o_orderdate")).alias("join_date"))


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    j = member_join_dates(spark, sf_dir)
    key = F.col("c_custkey")
    return c.join(j, c.c_custkey == j.o_custkey, "left").select(
        _text(key).alias("member_id"),
        _text(F.col("c_nationkey")).alias("account_id"),
        F.concat(F.lower(F.col("c_name")), F.lit("@example.com")).alias("email"),
        _text(F.col("join_date")).alias("join_date"),
        F.lit("enrolled").alias("eligibility_status"),
        F.when(key % 5 < 4, F.lit("True")).otherwise(F.lit("False")).alias("sponsored"),
        F.when(key % 50 == 0, F.lit("True")).otherwise(F.lit("False")).alias("is_fitbit_seed"),
    )


def raw_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    p = o.select("o_orderpriority").distinct()
    price = F.lit(10) + F.lit(5) * F.substring(F.col("o_orderpriority"), 1, 1).cast("int")
    return p.select(
        F.col("o_orderpriority").alias("plan_id"),
        F.col("o_orderpriority").alias("plan_name"),
        F.col("o_orderpriority").alias("tier"),
        _text(price).alias("monthly_price"),
    )


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    start = _day("o_orderdate")
    active = F.col("o_orderstatus") == "O"
    end = F.date_add(start, (F.lit(30) + F.col("o_orderkey") % 300).cast("int"))
    return o.select(
        _text(F.col("o_orderkey")).alias("subscription_id"),
        _text(F.col("o_custkey")).alias("member_id"),
        F.col("o_orderpriority").alias("plan_id"),
        _text(start).alias("start_date"),
        F.when(active, F.lit("")).otherwise(_text(end)).alias("end_date"),
        F.when(active, F.lit("active")).otherwise(F.lit("ended")).alias("status"),
        _money_text(F.col("o_totalprice")).alias("billed_amount"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-time orders: one per lineitem, owned by the order's customer."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    types = F.array(*[F.lit(t) for t in ORDER_TYPES])
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.concat_ws("-", _text(F.col("l_orderkey")), _text(F.col("l_linenumber"))).alias("order_id"),
        _text(F.col("o_custkey")).alias("member_id"),
        F.element_at(types, (F.col("l_linenumber") % 4 + 1).cast("int")).alias("order_type"),
        _text(_day("l_shipdate")).alias("order_date"),
        _money_text(F.col("l_extendedprice")).alias("amount"),
        F.col("l_returnflag").alias("status"),
    )


def campaign_dates(key: Column) -> tuple[Column, Column]:
    start = F.date_add(F.lit(CAMPAIGN_EPOCH), ((key * 97) % 400).cast("int"))
    end = F.date_add(start, (F.lit(14) + key % 47).cast("int"))
    return start, end


def raw_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    key = F.col("s_suppkey")
    start, end = campaign_dates(key)
    bal = F.abs(F.col("s_acctbal"))
    return s.select(
        _text(key).alias("campaign_id"),
        F.col("s_name").alias("campaign_name"),
        F.element_at(F.array(*[F.lit(ch) for ch in CHANNELS]), (key % 9 + 1).cast("int")).alias("channel"),
        _text(F.col("s_nationkey")).alias("target_audience"),
        _text(start).alias("start_date"),
        _text(end).alias("end_date"),
        F.when(end < F.lit(ORDERS_AS_OF), F.lit("completed")).otherwise(F.lit("active")).alias("status"),
        _money_text(bal * 110000).alias("budget"),
        _money_text(bal * 100000).alias("spend"),
        _text(F.lit(1000) + (key * 37) % 9000).alias("impressions"),
        _text((key * 13) % 1000).alias("clicks"),
        _text(key % 400).alias("conversions"),
    )


def raw_acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each account (nation) is acquired by the lowest-keyed supplier located there."""
    s = table(spark, sf_dir, "supplier")
    return s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("k")).select(
        _text(F.col("s_nationkey")).alias("account_id"), _text(F.col("k")).alias("campaign_id"))


def _events_day_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    v = F.col("value").cast(MONEY)
    et = F.col("event_type")
    return ev.groupBy(F.col("user_id"), F.to_date("ts").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum(v).alias("value_sum"),
        F.sum(F.when(et.isin("purchase", "click"), v)).alias("hi"),
        F.sum(F.when(et.isin("view", "signup", "error"), v)).alias("mid"),
        F.count_if(et == "view").alias("views"),
    )


def raw_workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily activity per user from ``events``, as workout text columns.

    Minute counters are floors of value sums per event-type group; a group
    with no event that day gives an empty (null) counter.
    """
    d = _events_day_grain(spark, sf_dir)
    return d.select(
        F.concat_ws("-", _text(F.col("user_id")), _text(F.col("activity_date"))).alias("workout_id"),
        _text(F.col("user_id")).alias("member_id"),
        _text(F.col("activity_date")).alias("activity_date"),
        _text(F.col("steps")).alias("steps"),
        _text(F.col("value_sum")).alias("distance_km"),
        _text(F.floor(F.col("hi")).cast("int")).alias("very_active_minutes"),
        _text(F.floor(F.col("mid")).cast("int")).alias("moderately_active_minutes"),
        _text(F.col("views")).alias("light_active_minutes"),
        _text(F.lit(1440) - F.col("steps")).alias("sedentary_minutes"),
        _text(F.floor(F.col("value_sum")).cast("int")).alias("calories_burned"),
        F.when(F.col("user_id") % 10 == 0, F.lit("real_fitbit")).otherwise(F.lit("synthetic")).alias("source"),
    )


# binding choices: mixed-case raw ticket types per event type (four map, 'error' stays as is)
TICKET_TYPE_BY_EVENT = {
    "view": "Technical issue",
    "click": "BILLING INQUIRY",
    "signup": "Product Inquiry",
    "purchase": "refund request",
}
# binding choices: ticket priority and channel labels
TICKET_PRIORITIES = ["Critical", "High", "Medium", "Low"]
TICKET_CHANNELS = ["Email", "Phone", "Chat", "Social media"]


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    et = F.col("event_type")
    ttype = et
    for k, v in reversed(list(TICKET_TYPE_BY_EVENT.items())):
        ttype = F.when(et == k, F.lit(v)).otherwise(ttype)
    created = F.to_date("ts")
    odd = eid % 2 == 1
    prio = F.array(*[F.lit(p) for p in TICKET_PRIORITIES])
    chan = F.array(*[F.lit(c) for c in TICKET_CHANNELS])
    return ev.select(
        _text(eid).alias("ticket_id"),
        _text(F.col("user_id")).alias("member_id"),
        ttype.alias("ticket_type"),
        F.when(odd, F.lit("Open")).otherwise(F.lit("Closed")).alias("ticket_status"),
        F.element_at(prio, (eid % 4 + 1).cast("int")).alias("ticket_priority"),
        F.element_at(chan, (F.col("user_id") % 4 + 1).cast("int")).alias("ticket_channel"),
        F.when(eid % 3 == 0, F.lit("")).otherwise(F.concat(_text(F.lit(1) + eid % 5), F.lit(".0"))).alias("csat_rating"),
        _text(created).alias("created_at"),
        F.when(odd, F.lit("")).otherwise(_text(F.date_add(created, (eid % 7).cast("int")))).alias("resolved_at"),
    )


# --------------------------------------------------------------------------- typed shapes


def activity_days(spark: SparkSession, sf_dir: str,
                  threshold: int = ACTIVE_VALUE_THRESHOLD) -> DataFrame:
    """Typed member-day activity from ``events``.

    (member_id, activity_date, steps, value_sum, is_active_day); a day is
    active when its decimal value sum reaches ``threshold``.  The group-by is
    map-side combined, so a hot user costs one partial row per task and day.
    """
    ev = table(spark, sf_dir, "events")
    d = ev.groupBy(F.col("user_id"), F.to_date("ts").alias("activity_date")).agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum(F.col("value").cast(MONEY)).cast(MONEY).alias("value_sum"),
    )
    return d.select(
        _text(F.col("user_id")).alias("member_id"),
        "activity_date",
        "steps",
        "value_sum",
        (F.col("value_sum") >= threshold).alias("is_active_day"),
    )
