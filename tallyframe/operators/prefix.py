"""Running totals over a whole table without a task that sees all of it.

A window ordered over everything runs in one task.  Here the rows are
range-partitioned on the order (Spark samples the bounds), each range gets
its number, and the running total is taken in levels: inside a range, and
over the sums of the ranges.  The ranges' sums are one row per partition;
beyond ``LEVEL_ROWS`` of them, they are ranged and summed the same way.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

LEVEL_ROWS = 100_000        # range sums that one task adds up
PART = "__part"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows, written to the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ranged(df: DataFrame, order: Sequence[Column | str], keep: Callable[[DataFrame], DataFrame] = checkpointed,
           partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned on ``order`` with the range's number in ``__part``, in shared storage.

    Numbers rise with the order.  They are only meaningful because the rows
    are written once (``keep``): a range's bounds are sampled when the job
    runs, and later readers see the numbers that were written.
    """
    spread = df.repartitionByRange(*([partitions] if partitions else []), *order)
    return keep(spread.withColumn(PART, F.spark_partition_id()))


def running_totals(df: DataFrame, order: Sequence[Column | str], sums: Mapping[str, str],
                   keep: Callable[[DataFrame], DataFrame] = checkpointed, level_rows: int = LEVEL_ROWS,
                   partitions: int | None = None) -> DataFrame:
    """``df`` with, per ``out: column`` of ``sums``, the column's total over all earlier rows.

    ``order`` must be total (or tie only between rows that may share a task:
    rows equal in it stay in one range, in no defined order).  Null amounts count as
    zero.  No task holds more than one range, or ``level_rows`` range sums.
    """
    data = list(df.columns)
    amounts = {out: f"__amount_{i}" for i, out in enumerate(sums)}
    rows = df.withColumns({amounts[out]: F.coalesce(F.col(c), F.lit(0)) for out, c in sums.items()})
    parts = ranged(rows, order, keep, partitions)
    totals = parts.groupBy(PART).agg(*[F.sum(a).alias(a) for a in amounts.values()])
    befores = {a: f"__before{a}" for a in amounts.values()}
    if parts.select(PART).agg(F.max(PART)).first()[0] is None:
        return df.withColumns({out: F.lit(0).cast("bigint") for out in sums})
    before = _before(totals, befores, keep, level_rows)
    inner = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = parts.join(before, PART, "inner")
    return joined.select(*data, *[(F.col(befores[a]) + F.sum(a).over(inner) - F.col(a)).alias(out) for out, a in amounts.items()])


def _before(totals: DataFrame, befores: Mapping[str, str], keep, level_rows: int) -> DataFrame:
    """Per ``__part`` the totals of the parts before it."""
    n = totals.agg(F.max(PART)).first()[0] + 1
    if n <= level_rows:
        w = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return totals.select(PART, *[(F.sum(a).over(w) - F.col(a)).alias(b) for a, b in befores.items()])
    lower = totals.withColumn("__lower", F.col(PART)).withColumn(PART, F.floor(F.col(PART) / level_rows).cast("int"))
    upper = _before(lower.groupBy(PART).agg(*[F.sum(a).alias(a) for a in befores]),
                    {a: f"__upper{a}" for a in befores}, keep, level_rows)
    w = Window.partitionBy(PART).orderBy("__lower").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return lower.join(upper, PART, "inner").select(
        F.col("__lower").alias(PART), *[(F.col(f"__upper{a}") + F.sum(a).over(w) - F.col(a)).alias(b) for a, b in befores.items()])


def with_position(df: DataFrame, order: Sequence[Column | str], col: str = "position",
                  keep: Callable[[DataFrame], DataFrame] = checkpointed) -> DataFrame:
    """O1: each row's place (from 1) in the order; ``order`` must be total."""
    return running_totals(df.withColumn("__one", F.lit(1).cast("bigint")), order, {"__rows": "__one"}, keep) \
        .withColumn(col, F.col("__rows") + 1).drop("__one", "__rows")
