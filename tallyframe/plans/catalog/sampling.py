"""Sampling, numbering and row-generation queries on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...fixed_values import ORDERS_PER_MEMBER_WEIGHTS, PLAN_TIER_WEIGHTS
from ...functions.exprs import padded_id
from ...operators import sampling as sm
from ...sources import testdata as td
from ..oracle_base import h_sql, weighted_sql
from .registry import register

PLAN_LABELS, PLAN_WEIGHTS = PLAN_TIER_WEIGHTS
COUNT_LABELS, COUNT_WEIGHTS = ORDERS_PER_MEMBER_WEIGHTS


@register("exact_n_sample", f"""
select c_custkey, c_name, c_nationkey from (
  select *, row_number() over (order by h, c_custkey) as rn, count(*) over () as total
  from (select c_custkey, c_name, c_nationkey, {h_sql('c_custkey')} as h from customer) x) y
where rn <= floor(0.35 * total)""")
def exact_n_sample(spark, d):
    return sm.exact_n_sample(td.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"),
                             "0.35", ["c_custkey"], td.SEED)


@register("weighted_assign", f"""
select c_custkey, {weighted_sql(h_sql('c_custkey', salt='plan_tier'), PLAN_LABELS, [3221225472, 4294967296])} as plan_tier
from customer""")
def weighted_assign(spark, d):
    return sm.weighted_assign(td.table(spark, d, "customer").select("c_custkey"), ["c_custkey"],
                              PLAN_LABELS, PLAN_WEIGHTS, "plan_tier", td.SEED)


@register("replicate_rows", f"""
select c_custkey, cast(unnest(generate_series(1, n)) as integer) as copy_no from (
  select c_custkey, {weighted_sql(h_sql('c_custkey', salt='n_orders'), COUNT_LABELS,
                                  [2147483648, 3435973836, 4080218931, 4294967296])} as n from customer) x""")
def replicate_rows(spark, d):
    c = sm.weighted_assign(td.table(spark, d, "customer").select("c_custkey"), ["c_custkey"],
                           COUNT_LABELS, COUNT_WEIGHTS, "n_orders", td.SEED)
    return sm.replicate_rows(c, "n_orders").select("c_custkey", "copy_no")


@register("zip_by_rank", f"""
select a.c_custkey, b.s_suppkey, a.pair_no from
  (select c_custkey, row_number() over (order by {h_sql('c_custkey', salt='left')}, c_custkey) as pair_no
   from customer) a
join
  (select s_suppkey, row_number() over (order by {h_sql('s_suppkey', salt='right')}, s_suppkey) as pair_no
   from supplier) b
on a.pair_no = b.pair_no""")
def zip_by_rank(spark, d):
    return sm.zip_by_rank(td.table(spark, d, "customer").select("c_custkey"), ["c_custkey"],
                          td.table(spark, d, "supplier").select("s_suppkey"), ["s_suppkey"], td.SEED) \
        .select("c_custkey", "s_suppkey", "pair_no")


@register("serve_in_order", f"""
with a as (
  select c_custkey, c_custkey % 4 as want,
         sum(c_custkey % 4) over (order by {h_sql('c_custkey', salt='left')}, c_custkey) as through
  from customer),
p as (select o_orderkey, row_number() over (order by {h_sql('o_orderkey', salt='right')}, o_orderkey) as pair_no from orders)
select a.c_custkey, p.o_orderkey, p.pair_no
from a join p on p.pair_no > a.through - a.want and p.pair_no <= a.through""")
def serve_in_order(spark, d):
    need = td.table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 4).alias("want"))
    pool = td.table(spark, d, "orders").select("o_orderkey")
    return sm.serve_in_order(need, ["c_custkey"], "want", pool, ["o_orderkey"], td.SEED) \
        .select("c_custkey", "o_orderkey", "pair_no")


@register("sequence_ids", f"""
select event_id, printf('evt_%07d', row_number() over (order by {h_sql('event_id', salt='seq')}, event_id)) as seq_id
from events""")
def sequence_ids(spark, d):
    n = sm.dense_number(td.table(spark, d, "events").select("event_id"), ["event_id"], td.SEED, "n", salt="seq")
    return n.select("event_id", padded_id("evt", "n").alias("seq_id"))


@register("pooled_union", """
select event_id, user_id, event_type, 'engagement' as origin from events where event_type in ('view', 'click')
union all
select event_id, user_id, event_type, 'lifecycle' as origin from events where event_type not in ('view', 'click')""")
def pooled_union(spark, d):
    ev = td.table(spark, d, "events").select("event_id", "user_id", "event_type")
    first = ev.filter(F.col("event_type").isin("view", "click")).withColumn("origin", F.lit("engagement"))
    second = ev.filter(~F.col("event_type").isin("view", "click")).withColumn("origin", F.lit("lifecycle"))
    return first.unionByName(second)



