import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallyframe.operators.prefix import running_totals


@pytest.mark.parametrize("partitions,level_rows", [(1, 100), (7, 100), (40, 4)])
def test_running_totals(spark, partitions, level_rows):
    rng = random.Random(partitions)
    rows = [(rng.randrange(50), i, rng.choice([None, rng.randrange(9)])) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, i int, v int").repartition(5)
    got = {r.i: (r.before, r.seen) for r in running_totals(
        df.withColumn("one", F.lit(1)), [F.col("a").desc(), "i"], {"before": "v", "seen": "one"},
        level_rows=level_rows, partitions=partitions).collect()}
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    before = [0, *itertools.accumulate(r[2] or 0 for r in order)]
    assert got == {r[1]: (before[k], k) for k, r in enumerate(order)}


def test_running_totals_of_nothing(spark):
    df = spark.createDataFrame([], "i int, v bigint")
    out = running_totals(df, ["i"], {"before": "v"})
    assert out.columns == ["i", "v", "before"] and out.collect() == []


def test_sums_are_taken_in_levels(spark):
    """No window without a partition sees more than the range sums of one level."""
    df = spark.range(1000).withColumn("v", F.col("id"))
    got = running_totals(df, ["id"], {"before": "v"}, level_rows=3, partitions=30).collect()
    assert sorted((r.id, r.before) for r in got) == [(i, i * (i - 1) // 2) for i in range(1000)]
