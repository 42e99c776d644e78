"""Randomised properties: each operator against a brute-force Python version."""

import datetime as dt
import hashlib
import os
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyframe.operators import matching as mt
from tallyframe.operators import sampling as sm
from tallyframe.operators import streaks as sk
from tallyframe.plans import revenue as rv

BASE = dt.date(2024, 1, 1)
# PROPERTY_EXAMPLES=60 python -m pytest tests/test_properties.py  for a heavier run
SETTINGS = settings(max_examples=int(os.environ.get("PROPERTY_EXAMPLES", "12")), deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

activity_rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40), st.booleans()),
                         min_size=0, max_size=60)


def brute_streaks(rows):
    days = {}
    for m, off, flag in rows:
        days[(m, off)] = days.get((m, off), False) or flag
    out = set()
    for m in {m for m, _ in days}:
        active = sorted(off for (mm, off), f in days.items() if mm == m and f)
        run = []
        for off in active:
            if run and off != run[-1] + 1:
                out.add((m, run[0], run[-1], len(run)))
                run = []
            run.append(off)
        if run:
            out.add((m, run[0], run[-1], len(run)))
    return out


@SETTINGS
@given(rows=activity_rows)
def test_streaks_match_brute_force(spark, rows):
    df = spark.createDataFrame([(m, BASE + dt.timedelta(days=o), f) for m, o, f in rows],
                               "member_id string, activity_date date, is_active_day boolean")
    got = {(r.member_id, (r.streak_start_date - BASE).days, (r.streak_end_date - BASE).days, r.streak_length_days)
           for r in sk.member_streaks(df).collect()}
    assert got == brute_streaks(rows)


subscriptions = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 500)), st.one_of(st.none(), st.integers(-200, 300)), st.integers(0, 5000)),
    min_size=1, max_size=25).filter(lambda rows: any(r[0] is not None for r in rows))


@SETTINGS
@given(subs=subscriptions, as_of_off=st.integers(0, 900))
def test_monthly_delta_form_equals_interval_form(spark, subs, as_of_off):
    # a start may be missing, and an end may lie before its start
    rows = [(f"s{i}", "m", "p", None if s is None else BASE + dt.timedelta(days=s),
             None if e is None else BASE + dt.timedelta(days=(s or 0) + e), "x", Decimal(c) / 100) for i, (s, e, c) in enumerate(subs)]
    df = spark.createDataFrame(rows, "subscription_id string, member_id string, plan_id string, start_date date, "
                                     "end_date date, status string, billed_amount decimal(18,2)")
    orders = spark.createDataFrame([], "order_id string, member_id string, order_type string, order_date date, "
                                       "amount decimal(18,2), status string")
    as_of = BASE + dt.timedelta(days=as_of_off)
    got = {r.month_start: (r.mrr, r.active_subscriptions) for r in rv.monthly_revenue(df, orders, as_of).collect()}
    first = min(r[3] for r in rows if r[3]).replace(day=1)
    want, m = {}, first
    while m <= as_of.replace(day=1):
        live = [r for r in rows if r[3] and r[3].replace(day=1) <= m and (r[4] is None or r[4].replace(day=1) >= m)]
        want[m] = (sum((r[6] for r in live), Decimal("0.00")), len(live))
        m = (m.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    assert got == want


def py_hash(key) -> int:
    return int(hashlib.md5(f"{key}:42".encode()).hexdigest()[:8], 16)


@SETTINGS
@given(n=st.integers(0, 3000), frac=st.sampled_from(["0", "0.1", "0.35", "0.5", "0.999", "1"]))
def test_exact_n_is_the_n_smallest_hashes(spark, n, frac):
    df = spark.range(n).withColumnRenamed("id", "k")
    got = sorted(r.k for r in sm.exact_n_sample(df, frac, ["k"]).collect())
    take = int(Decimal(frac) * n)
    want = sorted(sorted(range(n), key=lambda k: (py_hash(k), k))[:take])
    assert got == want


ents = st.lists(st.tuples(st.sampled_from(["x", "y"]), st.one_of(st.none(), st.integers(0, 200))), max_size=30)
camps = st.lists(st.tuples(st.sampled_from(["x", "y", "z"]), st.integers(0, 200), st.integers(-5, 60)), max_size=8)


@SETTINGS
@given(es=ents, cs=camps, grace=st.integers(0, 60))
def test_window_matches_equal_brute_force(spark, es, cs, grace):
    e_rows = [(f"e{i}", t, None if o is None else BASE + dt.timedelta(days=o)) for i, (t, o) in enumerate(es)]
    c_rows = [(f"c{i}", t, BASE + dt.timedelta(days=s), BASE + dt.timedelta(days=s + ln))
              for i, (t, s, ln) in enumerate(cs)]
    e = spark.createDataFrame(e_rows, "account_id string, account_type string, acquisition_date date")
    c = spark.createDataFrame(c_rows, "campaign_id string, target_audience string, start_date date, end_date date")
    got = {(r.account_id, r.campaign_id) for r in mt.window_matches(
        e, c, entity_key="account_id", entity_type="account_type", entity_date="acquisition_date",
        campaign_key="campaign_id", grace_days=grace).collect()}
    want = {(a, k) for a, t, d in e_rows for k, aud, s, end in c_rows
            if d is not None and t == aud and s <= d <= end + dt.timedelta(days=grace)}
    assert got == want


def brute_engagement(members, accounts, subs, plans, orders, activity):
    """The KPI query by its definition: one row per (member, subscription), then aggregate."""
    from decimal import ROUND_HALF_UP

    def r(x, places):
        return x.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)

    as_of = max(d for _, d, _ in activity)
    runs = {}
    for m in {m for m, _, _ in activity}:
        days = sorted({d for mm, d, f in activity if mm == m and any(
            ff for m2, d2, ff in activity if m2 == m and d2 == d)})
        cur = []
        for d in days:
            if cur and (d - cur[-1]).days != 1:
                runs.setdefault(m, []).append((cur[0], cur[-1], len(cur)))
                cur = []
            cur.append(d)
        if cur:
            runs.setdefault(m, []).append((cur[0], cur[-1], len(cur)))
    acct = dict(accounts)
    tier = dict(plans)
    n_orders = {}
    for _, m in orders:
        n_orders[m] = n_orders.get(m, 0) + 1
    groups = {}
    for m, a, join in members:
        for _, sm_, p, billed in subs:
            if sm_ != m or p not in tier:
                continue
            latest = max(runs[m], key=lambda x: x[1]) if m in runs else None
            row = dict(member=m, billed=billed,
                       cur=None if latest is None else int(latest[1] == as_of),
                       cur_len=None if latest is None else latest[2],
                       longest=None if m not in runs else max(x[2] for x in runs[m]),
                       orders=n_orders.get(m), days=None if join is None else (as_of - join).days)
            groups.setdefault((acct.get(a), tier[p]), []).append(row)
    out = {}
    for key, rows_ in groups.items():
        members_ = {x["member"] for x in rows_}
        total = sum((x["billed"] for x in rows_), Decimal("0.00"))
        cur_lens = [x["cur_len"] for x in rows_ if x["cur"] == 1]
        longs = [x["longest"] for x in rows_ if x["longest"] is not None]
        days = [x["days"] for x in rows_ if x["days"] is not None]
        ords = [x["orders"] for x in rows_ if x["orders"] is not None]
        out[key] = (
            len(members_), total, r(total / len(members_), 2),
            sum(1 for x in rows_ if x["cur"] == 1),
            r(Decimal(sum(cur_lens)) / len(cur_lens), 1) if cur_lens else None,
            r(Decimal(sum(longs)) / len(longs), 1) if longs else None,
            sum(ords) if ords else None,
            r(Decimal(sum(days)) / len(days), 1) if days else None,
            r(Decimal(sum(days)) / len(days) / 30, 1) if days else None,
        )
    return out


engagement_inputs = st.fixed_dictionaries({
    "members": st.lists(st.tuples(st.sampled_from(["a1", "a2", "zz"]), st.one_of(st.none(), st.integers(0, 400))),
                        min_size=1, max_size=6),
    "subs": st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["p1", "p2", "p9"]), st.integers(0, 9999)),
                     max_size=12),
    "orders": st.lists(st.integers(0, 5), max_size=8),
    "activity": st.lists(st.tuples(st.integers(0, 5), st.integers(0, 20), st.booleans()), min_size=1, max_size=40),
})


@SETTINGS
@given(data=engagement_inputs)
def test_engagement_folding_equals_fanout(spark, data):
    from tallyframe.plans import engagement as eg
    members = [(f"m{i}", a, None if j is None else BASE - dt.timedelta(days=j)) for i, (a, j) in enumerate(data["members"])]
    accounts = [("a1", "organization"), ("a2", "individual")]
    plans = [("p1", "standard"), ("p2", "premium")]
    subs = [(f"s{i}", f"m{m}", p, Decimal(c) / 100) for i, (m, p, c) in enumerate(data["subs"])]
    orders = [(f"o{i}", f"m{m}") for i, m in enumerate(data["orders"])]
    activity = [(f"m{m}", BASE + dt.timedelta(days=o), f) for m, o, f in data["activity"]]
    got_df = eg.engagement_and_value(
        spark.createDataFrame(members, "member_id string, account_id string, join_date date"),
        spark.createDataFrame(accounts, "account_id string, account_type string"),
        spark.createDataFrame(subs, "subscription_id string, member_id string, plan_id string, "
                                    "billed_amount decimal(18,2)"),
        spark.createDataFrame(plans, "plan_id string, tier string"),
        spark.createDataFrame([(o, m, Decimal("1.00")) for o, m in orders],
                              "order_id string, member_id string, amount decimal(18,2)"),
        spark.createDataFrame(activity, "member_id string, activity_date date, is_active_day boolean"))
    got = {(r.account_type, r.tier): (r.count_members, r.total_billed_amount, r.rev_per_member,
                                      r.count_mem_with_current_streak, r.avg_current_streak_length,
                                      r.avg_longest_streak_days, r.count_orders,
                                      r.avg_length_of_membership_days, r.avg_length_of_membership_months)
           for r in got_df.collect()}
    assert got == brute_engagement(members, accounts, [(s, m, p, b) for s, m, p, b in subs],
                                   plans, orders, activity)


campaign_inputs = st.fixed_dictionaries({
    "members": st.lists(st.sampled_from(["a1", "a2", "a3"]), min_size=1, max_size=6),
    "subs": st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["active", "ended"]), st.integers(0, 5000)),
                     max_size=12),
    "acq": st.dictionaries(st.sampled_from(["a1", "a2", "a3"]), st.sampled_from(["c1", "c2", "c3"])),
    "spend": st.lists(st.integers(0, 100000), min_size=3, max_size=3),
})


@SETTINGS
@given(data=campaign_inputs)
def test_revenue_by_campaign_equals_definition(spark, data):
    from decimal import ROUND_HALF_UP
    members = [(f"m{i}", a) for i, a in enumerate(data["members"])]
    subs = [(f"s{i}", f"m{m}", "p", BASE, None, status, Decimal(c) / 100)
            for i, (m, status, c) in enumerate(data["subs"])]
    acq = sorted(data["acq"].items())
    camps = [(f"c{i + 1}", f"n{i}", "email", "individual", Decimal(sp) / 100, 0) for i, sp in enumerate(data["spend"])]
    out = rv.revenue_by_campaign(
        spark.createDataFrame(subs, "subscription_id string, member_id string, plan_id string, start_date date, "
                                    "end_date date, status string, billed_amount decimal(18,2)"),
        spark.createDataFrame(members, "member_id string, account_id string"),
        spark.createDataFrame(acq, "account_id string, campaign_id string") if acq else
        spark.createDataFrame([], "account_id string, campaign_id string"),
        spark.createDataFrame(camps, "campaign_id string, campaign_name string, channel string, "
                                     "target_audience string, spend decimal(18,2), conversions int"))
    got = {r.campaign_id: (r.attributed_mrr, r.attributed_subscriptions, r.spend_per_attributed_subscription,
                           r.payback_period_months) for r in out.collect()}
    acct = dict(members)
    want = {}
    for cid, _, _, _, spend, _ in camps:
        rows_ = [(s, b) for s, m, _, _, _, st_, b in subs
                 if st_ == "active" and m in acct and data["acq"].get(acct[m]) == cid]
        mrr = sum((b for _, b in rows_), Decimal("0.00"))
        n = len({s for s, _ in rows_})
        q = Decimal("0.01")
        want[cid] = (mrr, n, (spend / n).quantize(q, ROUND_HALF_UP) if n > 0 else None,
                     (spend / mrr).quantize(q, ROUND_HALF_UP) if mrr > 0 else None)
    assert got == want


@SETTINGS
@given(parent=st.lists(st.one_of(st.none(), st.sampled_from(list("abcdef"))), max_size=15),
       child=st.lists(st.one_of(st.none(), st.sampled_from(list("abcxyz"))), max_size=15))
def test_quality_checks_equal_counts(spark, parent, child):
    from tallyframe.operators import quality as dq
    p = spark.createDataFrame([(v,) for v in parent], "v string")
    c = spark.createDataFrame([(v,) for v in child], "v string")
    suite = dq.Suite(unique=[("p", "v")], not_null=[("c", "v")], accepted_values=[("p", "v", ["a", "b"])],
                     relationships=[("c", "v", "p", "v")])
    got = {r.test_name: r.failures for r in suite.run({"p": p, "c": c}).collect()}
    vals = [v for v in parent if v is not None]
    want = {
        "unique": sum(1 for v in set(vals) if vals.count(v) > 1),
        "not_null": sum(1 for v in child if v is None),
        "accepted_values": len({v for v in vals if v not in ("a", "b")}),
        "relationships": sum(1 for v in child if v is not None and v not in set(vals)),
    }
    assert got == want
