"""Source and sink queries (S1-S11) and output order (O1).

Each writes tables derived from the test data to a fresh folder of the shared
checkpoint folder, reads them back through the source under test, and returns
the rows; the oracles select the same rows from the tables directly.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.prefix import with_position
from ...session import ensure_checkpoint_dir
from ...sources import sinks, text
from ...sources import testdata as td
from .. import revenue as rv
from .. import staging as st
from ..oracle_base import sql
from . import common as c
from .registry import register
from .revenue import RATIOS_SQL, REV_DEPS


def folder(spark: SparkSession, name: str) -> str:
    """A new folder that every executor sees."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tallyframe-sources/{name}-{uuid.uuid4().hex}"


@register("csv_round_trip", sql("select * from one_time_orders", "one_time_orders"))
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """S11, then S1: raw orders exported as CSV, read as text and typed."""
    raw, at = td.raw_orders(spark, d), folder(spark, "orders")
    sinks.write_csv(raw, at, list(reversed(raw.columns)))
    return st.stage_orders(text.read_text_csv(spark, at), money=td.MONEY)


@register("csv_quoting", sql("""
select doc_id::varchar as doc_id, text, source from documents where text is not null and text <> ''"""))
def csv_quoting(spark: SparkSession, d: str) -> DataFrame:
    """S11, then S1 in multi-line mode: whole texts with quotes, commas and line breaks."""
    docs = td.table(spark, d, "documents").filter("text <> ''").select(F.col("doc_id").cast("string"), "text", "source")
    at = folder(spark, "documents")
    sinks.write_csv(docs, at, ["source", "text", "doc_id"])
    return text.read_text_csv(spark, at, multi_line=True).select("doc_id", "text", "source")


@register("file_pool", sql("select * from one_time_orders", "one_time_orders"))
def file_pool(spark: SparkSession, d: str) -> DataFrame:
    """One table from many files whose headers list the columns in different orders."""
    raw, at = td.raw_orders(spark, d), folder(spark, "pool")
    part = F.pmod(F.xxhash64("order_id"), F.lit(3))
    for k, columns in enumerate((raw.columns, raw.columns[::-1], sorted(raw.columns))):
        sinks.write_csv(raw.filter(part == k), f"{at}/{k}", columns)
    return st.stage_orders(text.read_text_csv(spark, [f"{at}/{k}" for k in range(3)]), money=td.MONEY)


REGISTRY = {"accounts": "accounts.csv", "members": "members.csv", "subscriptions": "subscriptions.csv", "workouts": "workouts.csv"}


def loaded(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """Three of four registered tables exported, loaded from their folder and refreshed into a new namespace."""
    at, namespace = folder(spark, "raw"), f"raw_{uuid.uuid4().hex}"
    for name, raw in (("accounts", td.raw_accounts), ("members", td.raw_members), ("subscriptions", td.raw_subscriptions)):
        df = raw(spark, d)
        sinks.write_csv(df, f"{at}/{REGISTRY[name]}", df.columns)
    got = text.load_registry(spark, at, REGISTRY)
    report = sinks.load_all(spark, got.tables, namespace, base_path=f"{at}/tables", skipped=got.skipped)
    return namespace, report


@register("load_report", sql("""
select 'accounts' as table_name, 'loaded' as status, count(*) as "rows" from raw_accounts
union all select 'members', 'loaded', count(*) from raw_members
union all select 'subscriptions', 'loaded', count(*) from raw_subscriptions
union all select 'workouts', 'skipped', null""", "raw_accounts", "raw_members", "raw_subscriptions"))
def load_report(spark: SparkSession, d: str) -> DataFrame:
    """What the registry load found, and how many rows of it were stored."""
    return loaded(spark, d)[1]


@register("named_source", sql("select * from subscriptions", "subscriptions"))
def named_source(spark: SparkSession, d: str) -> DataFrame:
    """A stored raw table, read by namespace and name, and typed."""
    return st.stage_subscriptions(text.named_table(spark, "subscriptions", loaded(spark, d)[0]), money=td.MONEY)


@register("refreshed_table", sql("select * from members", "members"))
def refreshed_table(spark: SparkSession, d: str) -> DataFrame:
    """A stored table after a second full refresh."""
    members, at, name = c.members(spark, d), folder(spark, "members"), f"members_{uuid.uuid4().hex}"
    sinks.full_refresh(members.limit(10), name, path=at)
    sinks.full_refresh(members, name, path=at)
    return text.named_table(spark, name)


@register("view_rows", sql("select * from plans", "plans"))
def view_rows(spark: SparkSession, d: str) -> DataFrame:
    """A model registered as a view and read by name."""
    name = f"plans_{uuid.uuid4().hex}"
    sinks.as_view(c.plans(spark, d), name)
    return text.named_table(spark, name)


@register("campaign_order", sql(f"""
select cast(row_number() over (order by attributed_mrr desc nulls last, campaign_id) as bigint) as position, campaign_id, attributed_mrr
from ({RATIOS_SQL}) r""", *REV_DEPS))
def campaign_order(spark: SparkSession, d: str) -> DataFrame:
    """O1: the campaign mart's order, told by each row's position."""
    mart = rv.revenue_by_campaign(c.subscriptions(spark, d), c.members(spark, d), c.acquisition(spark, d), c.campaigns(spark, d), sort=False)
    return with_position(mart, [F.col("attributed_mrr").desc_nulls_last(), "campaign_id"]).select("position", "campaign_id", "attributed_mrr")
