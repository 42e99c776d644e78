"""Billing resolution, ticket resolution bands, campaign labels, unit
conversion and coverage summary queries on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ... import fixed_values as fv
from ...functions.hashing import hash32
from ...sources import testdata as td
from .. import operations as op
from ..oracle_base import avg_one_place, h_sql, sql
from . import common as c
from .registry import register


@register("billing_resolution", sql("""
select s.subscription_id, s.member_id, s.plan_id, m.sponsored,
       cast(case when m.sponsored then a.per_member_rate else p.monthly_price end as decimal(18,2)) as billed_amount
from subscriptions s
join members m on m.member_id = s.member_id
left join accounts a on a.account_id = m.account_id
join plans p on p.plan_id = s.plan_id""", "subscriptions", "members", "accounts", "plans"))
def billing_resolution(spark, d):
    return op.billing_resolution(c.subscriptions(spark, d), c.members(spark, d), c.accounts(spark, d),
                                 c.plans(spark, d))


def _band_sql(col: str, idx: int) -> str:
    whens = " ".join(f"when lower(coalesce({col}, '')) like '%{kw}%' then {pair[idx]}"
                     for kw, pair in fv.RESOLUTION_DAYS_BY_PRIORITY)
    return f"case {whens} else {fv.DEFAULT_RESOLUTION_DAYS[idx]} end"


TICKETS_AS_OF = "2024-02-01"  # early enough to cap some resolution dates


@register("resolution_bands", sql(f"""
select ticket_id, ticket_priority, ticket_status, created_at, band_low, band_high,
       case when lower(ticket_status) like '%closed%' or lower(ticket_status) like '%resolved%'
            then least(created_at + cast(band_low + {h_sql('ticket_id', salt='resolve')} % (band_high - band_low + 1)
                                         as integer), date '{TICKETS_AS_OF}') end as resolved_at
from (
  select *, {_band_sql('ticket_priority', 0)} as band_low, {_band_sql('ticket_priority', 1)} as band_high
  from (select ticket_id, ticket_priority, ticket_status, created_at from tickets) t) b""", "tickets"))
def resolution_bands(spark, d):
    """Staged tickets carry all four priorities, the first band's among them."""
    return op.resolution_bands(c.tickets(spark, d), TICKETS_AS_OF, hash32("ticket_id", seed=td.SEED, salt="resolve"))


def _title(code: str) -> str:
    return " ".join(w.capitalize() for w in code.split("_"))


THEME_LIST = "[" + ", ".join("'" + t + "'" for t in fv.THEMES) + "]"
CHANNEL_TITLES = " ".join(f"when '{ch}' then '{_title(ch)}'" for ch in fv.CHANNELS)


@register("campaign_labels", sql(f"""
select campaign_id,
       {THEME_LIST}[{h_sql('campaign_id', salt='theme')} % {len(fv.THEMES)} + 1] || '{fv.LABEL_SEPARATOR}'
         || case channel {CHANNEL_TITLES} end as campaign_label,
       case when end_date < date '2001-12-31' then 'completed' else 'active' end as status
from campaigns""", "campaigns"))
def campaign_labels(spark, d):
    pick = (hash32("campaign_id", seed=td.SEED, salt="theme") % len(fv.THEMES) + 1).cast("int")
    theme = F.element_at(F.array(*[F.lit(t) for t in fv.THEMES]), pick)
    return op.campaign_labels(c.campaigns(spark, d), td.ORDERS_AS_OF, theme)


@register("unit_conversion", """
select event_id,
       cast(round(cast(value as decimal(18,6)) * cast(1.60934 as decimal(8,5)), 2) as decimal(18,2)) as distance_km,
       cast(trunc(value) as integer) as whole_value
from events""")
def unit_conversion(spark, d):
    return op.unit_conversion(td.table(spark, d, "events"), "event_id", "value")


@register("coverage_summary", f"""
select population, with_orders, with_events,
       {avg_one_place('100 * with_orders', 'population')} as pct_with_orders,
       {avg_one_place('100 * with_events', 'population')} as pct_with_events
from (
  select count(distinct c_custkey) as population,
         count(distinct c_custkey) filter (where c_custkey in (select o_custkey from orders)) as with_orders,
         count(distinct c_custkey) filter (where c_custkey in (select user_id from events)) as with_events
  from customer) x""")
def coverage_summary(spark, d):
    return op.coverage_summary(td.table(spark, d, "customer"), "c_custkey", {
        "orders": (td.table(spark, d, "orders"), "o_custkey"),
        "events": (td.table(spark, d, "events"), "user_id"),
    })
