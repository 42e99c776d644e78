"""Range matching of entities to time-boxed offers, and attribution with a quota.

The match condition is an equality (entity type = campaign audience) plus a
date range (campaign start <= entity date <= campaign end + grace).  An
equi-join on the type alone would put every entity of a popular type into one
join partition, and test every pair.  Instead a campaign's window is cut into
dyadic day ranges (aligned blocks of 1, 2, 4, ... days; at most two of each
size), and an entity looks up the one block of each size that holds its date:
an equi-join on (type, size, block) with no residual condition, in which
every pair occurs exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import ATTRIBUTED_SHARE, DELAYED_CONVERSION_DAYS
from ..functions.hashing import hash32
from .joins import HOT_KEY_ROWS, Measured, lookup_join
from .sampling import first_n_by_hash, sample_size

TASK_DAYS = 500_000          # campaign days that one task makes
DYADIC_LEVELS = 13           # block sizes of up to 4,096 days; longer windows take several of the largest


def earliest_date(df: DataFrame, key: str, date: str, out: str = "acquisition_date") -> DataFrame:
    """Earliest date per key (map-side combined min)."""
    return df.groupBy(key).agg(F.min(date).alias(out))


def _day_number(date: Column) -> Column:
    """Days since 0001-01-01, so that blocks of days are numbered from zero up."""
    return F.datediff(date, F.lit("0001-01-01").cast("date"))


def dyadic_ranges(start: Column, stop: Column, levels: int = DYADIC_LEVELS) -> Column:
    """The aligned blocks that make up the days start..stop: array of (size, block), none if start > stop or null.

    A block of size s holds the 2**s days numbered block * 2**s and on.  At
    each size only the first whole block, if it is a right half, and the last,
    if it is a left half, are not part of a larger whole block.
    """
    first, last = _day_number(start), _day_number(stop) + 1
    sizes = []
    for s in range(levels):
        low, high = F.shiftright(first + ((1 << s) - 1), s), F.shiftright(last, s) - 1
        odd = low.bitwiseAND(F.lit(1)) == 1
        even = high.bitwiseAND(F.lit(1)) == 0
        if s == levels - 1:                                # the largest size: every whole block
            largest = F.lit(s).alias("size")
            sizes.append(F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda i: F.struct(largest, i.alias("block")))))
        else:
            sizes += [F.when((low <= high) & odd, F.array(F.struct(F.lit(s).alias("size"), low.alias("block")))),
                      F.when((low <= high) & even, F.array(F.struct(F.lit(s).alias("size"), high.alias("block"))))]
    return F.flatten(F.array_compact(F.array(*sizes)))


def window_matches(entities: DataFrame, campaigns: DataFrame, *, entity_key: str, entity_type: str,
                   entity_date: str, campaign_key: str, audience: str = "target_audience",
                   start: str = "start_date", end: str = "end_date",
                   grace_days: int = DELAYED_CONVERSION_DAYS, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Every (entity, campaign) with equal type and start <= date <= end + grace.

    Entities look up only block sizes that some campaign has, so one read of
    the entities gives at most as many rows as the longest window has sizes.
    Output: entity_key, campaign_key, entity_date.
    """
    window_end = F.date_add(F.col(end), grace_days)
    camp = campaigns.select(F.col(campaign_key), F.col(audience).alias("__type"),
                            F.explode(dyadic_ranges(F.col(start), window_end)).alias("__r")) \
        .select(campaign_key, "__type", F.col("__r.size").alias("__size"), F.col("__r.block").alias("__block"))
    sizes = F.coalesce(camp.agg(F.collect_set("__size").alias("s")).scalar(), F.array().cast("array<int>"))
    ent = entities.filter(F.col(entity_date).isNotNull()).select(
        F.col(entity_key), F.col(entity_type).alias("__type"), F.col(entity_date), F.explode(sizes).alias("__size")) \
        .withColumn("__block", F.call_function("shiftright", _day_number(F.col(entity_date)), F.col("__size")))
    return lookup_join(ent, camp, ["__type", "__size", "__block"], "inner", hot_rows).select(entity_key, campaign_key, entity_date)


def choose_one(pairs: DataFrame, key: str, choice: str, seed=42) -> DataFrame:
    """One of the eligible choices per key, picked by hash (repeatable).

    ``min_by`` is a partial aggregate, so a key with many choices is reduced
    map-side before the shuffle.
    """
    h = hash32(key, choice, seed=seed, salt="choice")
    return pairs.groupBy(key).agg(
        F.min_by(F.col(choice), F.struct(h.alias("h"), F.col(choice).alias("c"))).alias(choice))


def open_campaigns(campaigns: DataFrame, *, campaign_key: str, audience: str = "target_audience",
                   start: str = "start_date", end: str = "end_date",
                   grace_days: int = DELAYED_CONVERSION_DAYS, task_days: int = TASK_DAYS) -> DataFrame:
    """Every (campaign, audience, day) of the campaigns' windows (with the grace days), once: (campaign_key, __type, __day).

    One row per campaign and day, so its size follows the campaigns, not the
    entities.  The days are summed when this is called, and the (narrow)
    windows are spread by campaign over tasks that make about ``task_days``
    rows each: a campaign table stored in one file would otherwise make, and
    fold, all days in one task.
    """
    windows = campaigns.select(F.col(campaign_key), F.col(audience).alias("__type"), F.col(start).alias("__first"),
                               F.date_add(F.col(end), grace_days).alias("__last")).filter("__first <= __last").distinct()
    days = windows.agg(F.sum(F.datediff("__last", "__first").cast("bigint") + 1)).first()[0] or 0
    cores = campaigns.sparkSession.sparkContext.defaultParallelism
    spread = windows.repartition(max(cores, -(-days // task_days)), campaign_key, "__type")
    return spread.select(campaign_key, "__type", F.explode(F.sequence("__first", "__last")).alias("__day")).distinct()


def _ranked(days: DataFrame, campaign_key: str) -> DataFrame:
    return days.withColumn("__rank", F.row_number().over(Window.partitionBy("__type", "__day").orderBy(campaign_key)))


def campaign_days(campaigns: DataFrame, *, campaign_key: str, audience: str = "target_audience",
                  start: str = "start_date", end: str = "end_date",
                  grace_days: int = DELAYED_CONVERSION_DAYS) -> DataFrame:
    """Every (audience, day) with the campaigns open on it, numbered from 1 by key, and their count."""
    days = open_campaigns(campaigns, campaign_key=campaign_key, audience=audience, start=start, end=end, grace_days=grace_days)
    return _ranked(days, campaign_key).withColumn("__open", F.count(F.lit(1)).over(Window.partitionBy("__type", "__day")))


def choose_match(entities: DataFrame, campaigns: DataFrame, *, entity_key: str, entity_type: str,
                 entity_date: str, campaign_key: str, audience: str = "target_audience", start: str = "start_date",
                 end: str = "end_date", grace_days: int = DELAYED_CONVERSION_DAYS, seed=42,
                 hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """J6 + R7 without the pairs: one eligible campaign per entity, by hash (repeatable).

    The entity's (type, day) tells how many campaigns are open; the hash of
    its key modulo that count picks one by its number.  Each entity passes two
    look-ups that find one row at most, so rows grow with the entities and
    the campaign days, never with their pairs.  The campaign days are
    measured: broadcast where they fit, otherwise the entities of a heavy
    (type, day) are dealt over several tasks.  Output: entity_key, campaign_key.
    """
    days = open_campaigns(campaigns, campaign_key=campaign_key, audience=audience, start=start, end=end, grace_days=grace_days)
    ent = entities.filter(F.col(entity_date).isNotNull()).select(
        F.col(entity_key), F.col(entity_type).alias("__type"), F.col(entity_date).alias("__day"))
    size = lambda c: F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint")
    per_day = days.groupBy("__type", "__day").agg(F.count(F.lit(1)).alias("__open"), F.sum(size(campaign_key)).alias("__keys"))
    # both look-up tables measured in one pass; a rank has no more digits than the count
    width = size("__type") + size("__day") + size("__open")
    got = per_day.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b"), F.sum("__open").alias("all_n"),
                      F.sum(F.col("__open") * width + F.col("__keys")).alias("all_b")).first()
    open_days = Measured(per_day.select("__type", "__day", "__open"), got.n, got.b or 0)
    all_days = Measured(_ranked(days, campaign_key), got.all_n or 0, got.all_b or 0)
    counted = lookup_join(ent, open_days, ["__type", "__day"], "inner", hot_rows)
    picked = counted.withColumn("__rank", (F.pmod(hash32(entity_key, seed=seed, salt="choice"), F.col("__open")) + 1).cast("int"))
    return lookup_join(picked, all_days, ["__type", "__day", "__rank"], "inner", hot_rows).select(entity_key, campaign_key)


def attribute_accounts(accounts: DataFrame, campaigns: DataFrame, *, account_key: str = "account_id",
                       account_type: str = "account_type", acquisition_date: str = "acquisition_date",
                       campaign_key: str = "campaign_id", fraction: float | str = ATTRIBUTED_SHARE,
                       grace_days: int = DELAYED_CONVERSION_DAYS, seed=42) -> DataFrame:
    """Attribute a share of accounts to one eligible campaign each.

    The quota is floor(fraction x accounts that have an acquisition date),
    counted before eligibility; it is filled from eligible accounts in a
    repeatable random (hash) order, and accounts without an eligible campaign
    stay unattributed.  Output: account_key, campaign_key.
    """
    candidates = accounts.filter(F.col(acquisition_date).isNotNull())
    quota = candidates.agg(sample_size(fraction, F.count(F.lit(1))).alias("n"))
    chosen = choose_match(candidates, campaigns, entity_key=account_key, entity_type=account_type,
                          entity_date=acquisition_date, campaign_key=campaign_key, grace_days=grace_days, seed=seed)
    return first_n_by_hash(chosen, quota, [account_key], seed, salt="order")


def with_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right`` (semi-join).

    The right side is reduced to distinct keys first (map-side), so a key
    repeated a billion times costs one row per task.
    """
    keys = right.select(F.col(right_key).alias("__k")).distinct()
    return left.join(keys, left[left_key] == keys["__k"], "left_semi")
