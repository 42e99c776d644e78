"""Equi-joins that deal hot keys over several tasks, or need no shuffle of the big side at all."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEY_ROWS = 4_000_000  # rows of one key that one join task should receive
BROADCAST_BYTES = 64 << 20   # of a measured side
ROW_BYTES = 16               # that a row takes beside its values, about
SKETCH_ITEMS, SKETCH_KEYS, SKETCH_GROUPS = 100_000, 10_000, 256


def skew_split_join(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner",
                    hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``big.join(small, on, how)`` for how in (inner, left), robust to a key
    that holds a large share of ``big``.

    Keys with more than ``hot_rows`` rows in ``big`` are found with a map-side
    combined count; there are at most rows / ``hot_rows`` of them, so only
    that list of keys is broadcast.  Rows of such a key are dealt by a hash of
    all their columns over as many parts as its count asks for, and its rows
    of ``small`` are repeated for each part; then one shuffled join on key and
    part serves hot and ordinary keys alike.  The rows are the same for any
    ``hot_rows``.
    """
    if how not in ("inner", "left"):
        raise ValueError("skew_split_join supports inner and left joins")
    keys = [on] if isinstance(on, str) else list(on)
    hot = F.broadcast(big.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).filter(F.col("__rows") > hot_rows)
                      .select(*keys, F.ceil(F.col("__rows") / hot_rows).cast("int").alias("__parts")))
    whole = F.xxhash64(*[F.col(c) for c in big.columns])
    dealt = big.join(hot, keys, "left") \
        .withColumn("__part", F.pmod(whole, F.coalesce("__parts", F.lit(1))).cast("int")).drop("__parts")
    repeated = small.join(hot, keys, "left") \
        .withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return dealt.join(repeated, [*keys, "__part"], how).drop("__part")


@dataclass(frozen=True)
class Measured:
    """A frame with its number of rows and the bytes of its values, counted once."""
    df: DataFrame
    rows: int
    bytes: int

    @property
    def fits(self) -> bool:
        return self.bytes + ROW_BYTES * self.rows <= BROADCAST_BYTES


def measured(df: DataFrame) -> Measured:
    """Count ``df`` (one small aggregate is brought to the driver)."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("bigint")).alias("b")).first()
    return Measured(df, int(got.n), int(got.b or 0))


def heavy_keys(df: DataFrame, keys: list[str], hot_rows: int) -> list[tuple[int, int]]:
    """(key hash, parts) of the keys with about ``hot_rows`` rows or more.

    A frequent-items sketch of the key hashes: every task keeps a bounded
    sketch, sketches are merged in ``SKETCH_GROUPS`` groups and then in one.
    No key is shuffled, unlike a count per key.  A key whose share is above
    1 / 37,000 is never missed; counts are lower bounds.  At most
    ``SKETCH_KEYS`` pairs reach the driver.
    """
    hashed = df.select(F.xxhash64(*keys).alias("__kh"), F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("__group"))
    parts = hashed.groupBy("__group").agg(F.expr(f"approx_top_k_accumulate(__kh, {SKETCH_ITEMS})").alias("s"))
    top = parts.groupBy(F.lit(0).alias("one")).agg(F.expr(f"approx_top_k_combine(s, {SKETCH_ITEMS})").alias("s")) \
        .select(F.explode(F.expr(f"approx_top_k_estimate(s, {SKETCH_KEYS})")).alias("t"))
    hot = top.select("t.item", "t.count").filter(F.col("count") > hot_rows).collect()
    return [(r["item"], -(-r["count"] // hot_rows)) for r in hot]


def lookup_join(big: DataFrame, small: DataFrame | Measured, on: str | list[str], how: str = "inner",
                hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """``big.join(small, on, how)`` for how in (inner, left): a large table looks rows up in a smaller one.

    ``small`` is measured (or passed in measured).  If it fits
    ``BROADCAST_BYTES`` it is broadcast and ``big`` is read once and not
    shuffled, so no key of it can be hot.  Beyond that, ``big``'s heavy keys
    are found by a sketch over its key columns alone; without any the join is
    a plain shuffled one, otherwise the rows of heavy keys are dealt by a hash
    of all their columns over as many parts as their count asks for and meet
    a copy of their rows of ``small`` in each part.  A side measured too large
    is sort-merged, whatever the planner takes it for.

    The size, and the list of heavy keys, are snapshots taken when this is
    called; the rows of the result do not depend on them.
    """
    if how not in ("inner", "left"):
        raise ValueError("lookup_join supports inner and left joins")
    keys = [on] if isinstance(on, str) else list(on)
    side = small if isinstance(small, Measured) else measured(small)
    if side.fits:
        return big.join(F.broadcast(side.df), keys, how)
    hot = heavy_keys(big, keys, hot_rows)
    # merge: the planner's estimate of an exploded side does not grow with the explode factor, so it would broadcast it
    if not hot:
        return big.join(side.df.hint("merge"), keys, how)
    pairs = F.arrays_zip(F.lit([h for h, _ in hot]).cast("array<bigint>").alias("h"), F.lit([p for _, p in hot]).cast("array<int>").alias("p"))
    table = F.broadcast(big.sparkSession.range(1).select(F.explode(pairs).alias("e")).select(F.col("e.h").alias("__kh"), F.col("e.p").alias("__parts")))
    whole = F.xxhash64(*[F.col(c) for c in big.columns])
    parts = F.coalesce("__parts", F.lit(1))
    dealt = big.withColumn("__kh", F.xxhash64(*keys)).join(table, "__kh", "left") \
        .withColumn("__part", F.pmod(whole, parts).cast("int")).drop("__parts", "__kh")
    repeated = side.df.withColumn("__kh", F.xxhash64(*keys)).join(table, "__kh", "left") \
        .withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts", "__kh")
    return dealt.join(repeated.hint("merge"), [*keys, "__part"], how).drop("__part")
