"""Calendar spines, sequence re-anchoring and bootstrap resampling.

All row generation is ``explode(sequence(...))`` on each input row, so output
size per row is bounded by the window length and the work is spread with the
input partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..fixed_values import ACTIVITY_WINDOW_DAYS, JITTER_BP
from ..functions.hashing import hash32, key_text
from .joins import measured
from .sampling import dense_number



def _date(v: Column | str | dt.date) -> Column:
    if isinstance(v, Column):
        return v
    return F.lit(v).cast("date")


SPINE_ROWS = 2_000_000  # rows of a spine that one task makes


def entity_day_spine(entities: DataFrame, key: str, join_col: str, as_of: Column | dt.date | str,
                     window_days: int = ACTIVITY_WINDOW_DAYS, day_col: str = "activity_date",
                     partitions: int | None = None) -> DataFrame:
    """One row per entity and day from max(join date, window start) to the as-of date.

    Entities that join after the as-of date get no rows; a null join date
    means the whole window.  The explode multiplies each entity row by up to
    ``window_days``, so the (narrow) entity rows are first hash-spread over
    ``partitions`` tasks - a small entity table stored in one file would
    otherwise generate the whole spine in one task.  By default they are
    counted and as many tasks are taken as give each about
    ``SPINE_ROWS`` rows, one per core at least.
    """
    end = _date(as_of)
    start = F.date_sub(end, window_days - 1)
    first = F.greatest(F.coalesce(F.col(join_col), start), start)
    if partitions is None:
        cores = entities.sparkSession.sparkContext.defaultParallelism
        partitions = max(cores, -(-entities.count() * window_days // SPINE_ROWS))
    spread = entities.filter(first <= end).select(key, first.alias("__first"), end.alias("__end")) \
        .repartition(partitions, key)
    return spread.select(key, F.explode(F.sequence("__first", "__end")).alias(day_col))


def reanchor(df: DataFrame, key: str, date: str, end: Column | dt.date | str,
             join_col: str | None = None, out: str = "activity_date") -> DataFrame:
    """Move each entity's k-th of n days to end - (n - k), keeping order and closing gaps.

    Dates are compared as dates, not text (Q10).  Rows that land before the
    entity's join date are dropped.  The window holds one entity's rows, which
    for day-grain input is bounded by the number of days.
    """
    # remaining columns break ties among equal dates, so the order is total
    ties = [F.col(f.name) for f in df.schema.fields
            if f.name not in (key, date) and not isinstance(f.dataType, MapType)]
    w = Window.partitionBy(key).orderBy(F.col(date), *ties)
    wall = Window.partitionBy(key)
    moved = df.withColumn(
        out, F.date_add(_date(end), (F.row_number().over(w) - F.count(F.lit(1)).over(wall)).cast("int")))
    if join_col is not None:
        moved = moved.filter(F.col(join_col).isNull() | (F.col(out) >= F.col(join_col)))
    return moved


def jitter_factor(keys: Sequence[str | Column], measure: str, seed=42, bp: int = JITTER_BP) -> Column:
    """Factor in [1 - bp/10000, 1 + bp/10000], exact to 4 places, one per key and measure."""
    h = hash32(*keys, seed=seed, salt=measure)
    return (F.lit(10000) + h % (2 * bp + 1) - F.lit(bp)).cast("decimal(10,0)") * F.lit("0.0001").cast("decimal(5,4)")


def bootstrap(spine: DataFrame, spine_keys: Sequence[str], pool: DataFrame, pool_keys: Sequence[str],
              measures: Mapping[str, str], seed=42) -> DataFrame:
    """Each spine row takes one pool row (by hash) and jitters its measures.

    ``measures`` maps a pool column to ``"int"`` (rounded half up, floored at
    0) or ``"decimal"`` (rounded to 2 places).  The pool is numbered 1..P in
    hash order (R5); each spine row picks number ``hash % P + 1`` and looks it
    up.  The numbered pool is measured (and counted) when this is called: it
    is broadcast where it fits, so the spine is not shuffled; beyond that the
    two sides meet in a shuffled hash join built on the pool (the picks are
    uniformly spread).
    """
    numbered = dense_number(pool.select(*pool_keys, *measures), pool_keys, seed, "__pick", salt="pool")
    side = measured(numbered.select("__pick", *measures))
    size = F.lit(side.rows or None).cast("bigint")
    # the text that the pick and every jitter hash, made once per row where it is not shuffled
    keys = ["__key"] if side.fits else list(spine_keys)
    keyed = spine.withColumn("__key", key_text(*spine_keys)) if side.fits else spine
    chosen = keyed.withColumn("__pick", (hash32(*keys, seed=seed, salt="pick") % size + 1).cast("bigint"))
    # Always a hint: the size estimate of an explode does not grow with the
    # explode factor, so a spine of members x days looks tiny to the planner
    # and would be broadcast itself.
    joined = chosen.join(side.df.hint("broadcast" if side.fits else "shuffle_hash"), "__pick", "inner")
    out = []
    for m, kind in measures.items():
        scaled = F.col(m).cast("decimal(20,2)") * jitter_factor(keys, m, seed)
        if kind == "int":
            out.append(F.greatest(F.round(scaled, 0), F.lit(0)).cast("bigint").alias(m))
        else:
            out.append(F.round(scaled, 2).cast("decimal(18,2)").alias(m))
    return joined.select(*[c for c in spine.columns], *out)
