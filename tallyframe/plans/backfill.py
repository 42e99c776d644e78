"""Activity backfill (K17): real activity re-anchored onto a shared window,
bootstrap-resampled activity for everyone else, one union with origin labels
and dense workout ids.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import padded_id
from ..operators.calendar import bootstrap, entity_day_spine, reanchor
from ..operators.sampling import dense_number

DEFAULT_MEASURES = {"steps": "int", "value_sum": "decimal"}


def activity_backfill(members: DataFrame, activity: DataFrame, as_of: DataFrame,
                      measures: Mapping[str, str] = DEFAULT_MEASURES, window_days: int = 60,
                      seed=42, seed_flag: str = "is_fitbit_seed") -> DataFrame:
    """K17.

    * members flagged ``seed_flag`` keep their own activity, each member's
      sequence moved to end on the as-of date with gaps closed (R3), rows
      before the join date dropped;
    * every other member gets one row per day of the window from
      max(join date, window start) (R6), each row a jittered copy of a random
      real day (R4, the pool is every real row);
    * the two parts are appended with a ``data_source`` label (U1) and
      numbered densely into ``wkt_0000001``-style ids (R5 + P28).

    ``as_of`` is a one-row frame with ``as_of_date``.
    """
    cols = list(measures)
    when = as_of.select("as_of_date").scalar()   # one value, inlined as a scalar subquery
    m = members.select("member_id", "join_date", seed_flag)
    seeds = m.filter(F.col(seed_flag)).select("member_id", "join_date")
    others = m.filter(~F.col(seed_flag)).select("member_id", "join_date")

    # the seed members' activity has four consumers (re-anchoring, pool
    # numbering, pool histogram, output histogram).  The semi-join on seed keys
    # is pushed by Catalyst below the activity aggregate, so each read
    # aggregates only the seed members' rows; the join date is added after.
    real = activity.select("member_id", "activity_date", *cols) \
        .join(seeds.select("member_id"), "member_id", "left_semi") \
        .join(seeds, "member_id", "inner")
    shifted = reanchor(real.withColumnRenamed("activity_date", "original_date"),
                       "member_id", "original_date", when, join_col="join_date")
    real_rows = shifted.select(
        "member_id", "activity_date",
        *[(F.col(c).cast("bigint") if k == "int" else F.col(c).cast("decimal(18,2)")).alias(c)
          for c, k in measures.items()],
        F.lit("real_fitbit").alias("data_source"))

    spine = entity_day_spine(others, "member_id", "join_date", when, window_days)
    synth = bootstrap(spine, ["member_id", "activity_date"], real.select("member_id", "activity_date", *cols),
                      ["member_id", "activity_date"], measures, seed)
    synth_rows = synth.withColumn("data_source", F.lit("synthetic"))

    both = real_rows.unionByName(synth_rows)
    # the resampling join is 1:1 on spine rows, so the output keys are the
    # shifted keys plus the spine keys: the id histogram is taken from those
    # and the join runs once
    keys = real_rows.select("member_id", "activity_date").unionByName(spine.select("member_id", "activity_date"))
    numbered = dense_number(both, ["member_id", "activity_date"], seed, "__n", salt="workout", histogram_from=keys)
    return numbered.select(padded_id("wkt", "__n").alias("workout_id"), "member_id", "activity_date",
                           *cols, "data_source")
