"""Repeatable sampling and numbering without a single-partition step.

Randomness is a hash of the row key and a seed (see
:mod:`tallyframe.functions.hashing`), so results do not depend on how the
data is partitioned and survive task retries unchanged.

Global order
    Rows are ordered by (hash, key columns, content hash, remaining columns),
    whatever the sizes.  The content hash only orders rows that share all key
    columns; it lets the rows of one hot key spread over any number of tasks
    in that same order.  A histogram
    over the top ``BUCKET_BITS`` bits of the 32-bit hash (at most 2^16 rows)
    gives every bucket its offset; the running
    sum over that bounded histogram is the only unpartitioned window.  Rows
    are ranked inside their bucket only and shifted by the bucket's offset.
    Never ``monotonically_increasing_id`` or ``spark_partition_id``.

Hot buckets
    A bucket holding more than ``hot_rows`` rows (one key or one group of
    copies can hold a third of a table) is never ranked by one task.  Its
    exact copies are first collapsed map-side into (row, multiplicity); the
    bucket is split along the order, level by level and only where a level is
    still too large: by the low 16 hash bits, then by the key columns, then by
    as many leading bits of the content hash as the key's size asks for.  A
    running sum over the parts gives each distinct row a range of numbers;
    rows are then re-expanded in chunks of at most ``EXPAND_CHUNK`` copies
    spread over tasks.  The order is the one of small buckets, so the result
    is the same whichever path runs.

Driver-side decisions
    Which path a query takes is decided from one row of statistics read
    from the (checkpointed, bounded) histogram: the largest bucket, the total and,
    for a sample, the cut bucket.  Nothing else reaches the driver, and the
    plan handed to Spark contains only the path that is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from ..functions.hashing import TWO_32, hash32
from ..session import ensure_checkpoint_dir
from .prefix import running_totals
from .quality import require_capacity

BUCKET_BITS = 16
LOW_BITS = 32 - BUCKET_BITS          # hash bits below the bucket: order-preserving sub-buckets
CONTENT_BITS = 63                    # content hash, non-negative
HOT_BUCKET_ROWS = 4_000_000          # rows one task may rank in a window
EXPAND_CHUNK = 1_000_000             # copies one task may emit for one row
_H, _B, _C = "__h", "__bucket", "__content"


def _orderable(schema) -> list[str]:
    return [f.name for f in schema.fields if not isinstance(f.dataType, MapType)]


def _hashed(df: DataFrame, keys: Sequence[str], seed, salt: str | None = None) -> DataFrame:
    h = hash32(*keys, seed=seed, salt=salt)
    return _with_content(df.withColumn(_H, h).withColumn(_B, F.shiftright(F.col(_H), LOW_BITS)), df.columns)


def _with_content(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The hash of ``columns``, but for those that have no order."""
    content = F.xxhash64(*[F.col(c) for c in _orderable(df.select(*columns).schema)])
    return df.withColumn(_C, F.shiftrightunsigned(content, 64 - CONTENT_BITS))


def _order(schema, keys: Sequence[str]) -> list[Column]:
    """(hash, keys, content hash, every other orderable column): a total order up to exact copies."""
    rest = [c for c in _orderable(schema) if c not in keys]
    return [F.col(_H)] + [F.col(k) for k in keys] + [F.col(_C)] + [F.col(c) for c in rest]


def bucket_offsets(hashed: DataFrame) -> DataFrame:
    """Histogram of hash buckets with the number of rows in earlier buckets.

    At most 2^BUCKET_BITS rows; the unpartitioned running sum is over that
    bounded frame only.
    """
    counts = hashed.groupBy(_B).agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("__through", F.sum("__cnt").over(w)) \
        .withColumn("__before", F.col("__through") - F.col("__cnt"))


def expand(df: DataFrame, count_col: str, first_col: Column | int, out_col: str,
           chunk: int = EXPAND_CHUNK, spread: Sequence[str] = ()) -> DataFrame:
    """Each row becomes ``count`` rows numbered first, first + 1, ...

    Counts up to ``chunk`` are exploded in place; larger counts are first cut
    into chunks, the chunks are spread over tasks, and each task explodes at
    most ``chunk`` rows.  Rows with a count below 1 disappear.
    """
    m = F.col(count_col).cast("bigint")
    first = first_col if isinstance(first_col, Column) else F.lit(first_col)
    base = df.withColumn("__first", first.cast("bigint"))
    small = base.filter((m >= 1) & (m <= chunk)) \
        .withColumn("__i", F.explode(F.sequence(F.lit(0).cast("bigint"), m - 1)))
    big = base.filter(m > chunk) \
        .withColumn("__c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((m - 1) / chunk).cast("bigint"))))
    big = big.repartition(F.xxhash64(*[F.col(c) for c in spread], F.col("__c"))) \
        .withColumn("__i", F.explode(F.sequence(F.col("__c") * chunk,
                                                F.least(m, (F.col("__c") + 1) * chunk) - 1))) \
        .drop("__c")
    return small.unionByName(big) \
        .withColumn(out_col, F.col("__first") + F.col("__i")).drop("__first", "__i")


def _rank_cold(rows: DataFrame, order: list[Column], data_cols: Sequence[str]) -> DataFrame:
    """Rank (1-based) inside the bucket, one window partition per bucket.

    The content hash is as long as a narrow row: it is made after the shuffle.
    """
    rows = _with_content(rows.drop(_C).repartition(F.col(_B)), data_cols)
    return rows.withColumn("__rn", F.row_number().over(Window.partitionBy(_B).orderBy(*order)))


def _rank_hot(rows: DataFrame, order: list[Column], keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Distinct rows of hot buckets with their copies ``__m`` and the rank
    ``__first`` of their first copy inside the bucket (see module doc)."""
    collapsed = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__m"))
    collapsed = collapsed.withColumn("__low", F.col(_H).bitwiseAND((1 << LOW_BITS) - 1)) \
        .withColumn("__keys", F.struct(*[F.col(k) for k in keys]))
    # hash values, and then keys, with more distinct rows than one task should order;
    # at most rows / hot_rows of either, so they are broadcast
    count = F.count(F.lit(1)).alias("__n")
    hashes = collapsed.groupBy(_H).agg(count).filter(F.col("__n") > hot_rows).select(_H, F.lit(True).alias("__hot"))
    split = collapsed.join(F.broadcast(hashes), _H, "left") \
        .withColumn("__keys", F.when(F.col("__hot"), F.col("__keys")))
    wide = split.filter("__hot").groupBy(_H, F.col("__keys").alias("__wide")).agg(count).filter(F.col("__n") > hot_rows) \
        .select(F.col(_H).alias("__wh"), "__wide",
                F.least(F.ceil(F.log2(F.col("__n") / hot_rows)) + 1, F.lit(CONTENT_BITS)).cast("int").alias("__bits"))
    split = split.join(F.broadcast(wide), (F.col(_H) == F.col("__wh")) & F.col("__keys").eqNullSafe(F.col("__wide")), "left") \
        .withColumn("__part", F.when(F.col("__bits").isNotNull(),
                                     F.expr(f"shiftright({_C}, {CONTENT_BITS} - __bits)")).otherwise(F.lit(0))) \
        .drop("__hot", "__wh", "__wide", "__bits")
    part = [_B, "__low", "__keys", "__part"]
    sub = split.groupBy(*part).agg(F.sum("__m").alias("__sm"))
    wsub = Window.partitionBy(_B).orderBy("__low", "__keys", "__part") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sub = sub.withColumn("__sub_before", F.sum("__sm").over(wsub) - F.col("__sm")).drop("__sm") \
        .select(*[F.col(c).alias(f"__s{c}") for c in part], "__sub_before")
    same = [F.col(c).eqNullSafe(F.col(f"__s{c}")) if c == "__keys" else F.col(c) == F.col(f"__s{c}") for c in part]
    joined = split.join(sub, same, "inner").drop(*[f"__s{c}" for c in part])
    w = Window.partitionBy(*part).orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return joined.withColumn("__first", F.col("__sub_before") + F.sum("__m").over(w) - F.col("__m") + 1) \
        .drop("__low", "__keys", "__part", "__sub_before")


def _histogram(source: DataFrame) -> DataFrame:
    """Bucket histogram, checkpointed (at most 2^BUCKET_BITS rows).

    It is read by the driver-side decision below and by the query itself;
    writing it once to the session's shared checkpoint folder cuts its
    lineage, so neither reader recomputes the input and a lost executor
    costs nothing.
    """
    ensure_checkpoint_dir(source.sparkSession)
    hist = bucket_offsets(source).cache()       # so the checkpoint write does not recompute it
    saved = hist.checkpoint(eager=True)
    hist.unpersist()
    return saved


def dense_number(df: DataFrame, keys: Sequence[str], seed=42, col: str = "row_no",
                 salt: str | None = None, with_total: bool = False,
                 histogram_from: DataFrame | None = None, hot_rows: int = HOT_BUCKET_ROWS) -> DataFrame:
    """1-based dense row number in (hash, keys, content hash, rest) order.

    The numbers are a snapshot: the histogram is taken when this is called.
    The rows are shuffled once, by bucket, for the in-bucket ranking; the
    bucket histogram is a map-side combined count.  One row of statistics
    (largest bucket, total) is read on the driver to choose the plan: hot
    buckets get the split path only when they exist.  When the input is
    expensive to recompute, pass ``histogram_from``: any cheaper frame with
    exactly the same multiset of ``keys`` (e.g. the key columns before a 1:1
    enrichment join).  With ``with_total`` the row count is added as
    ``__total``.
    """
    data_cols = list(df.columns)
    hashed = _hashed(df, keys, seed, salt)
    order = _order(df.schema, keys)
    source = hashed if histogram_from is None else _hashed(histogram_from.select(*keys), keys, seed, salt)
    hist = _histogram(source)
    stats = hist.agg(F.max("__cnt").alias("max_cnt"), F.sum("__cnt").alias("total")).first()
    max_cnt, total = stats["max_cnt"] or 0, stats["total"] or 0
    extra = [F.lit(total).cast("bigint").alias("__total")] if with_total else []
    keep = data_cols + (["__total"] if with_total else []) + [col]
    info = hist.select(_B, "__before", "__cnt")

    if max_cnt <= hot_rows:
        ranked = _rank_cold(hashed, order, data_cols).join(F.broadcast(info), _B, "inner")
        return ranked.select(*data_cols, *extra,
                             (F.col("__before") + F.col("__rn")).cast("bigint").alias(col))

    cold = hashed.join(F.broadcast(info.filter(F.col("__cnt") <= hot_rows)), _B, "inner")
    cold = _rank_cold(cold, order, data_cols).withColumn(col, (F.col("__before") + F.col("__rn")).cast("bigint"))
    hot = hashed.join(F.broadcast(info.filter(F.col("__cnt") > hot_rows)), _B, "inner")
    hot = expand(_rank_hot(hot, order, keys, hot_rows), "__m", F.col("__before") + F.col("__first"), col, spread=[_H])
    return cold.select(*data_cols, *extra, col).unionByName(hot.select(*data_cols, *extra, col)).select(*keep)


def sample_size(fraction: float | str | Decimal, total: Column) -> Column:
    """n = floor(fraction * total) in exact decimal arithmetic."""
    frac = F.lit(str(Decimal(str(fraction)))).cast("decimal(12,9)")
    return F.floor(frac * total).cast("bigint")


def first_n_by_hash(df: DataFrame, n: Column | int | DataFrame, keys: Sequence[str], seed=42,
                    salt: str | None = None, hot_rows: int = HOT_BUCKET_ROWS) -> DataFrame:
    """O4 / R1 core: the ``n`` first rows in (hash, keys, content hash, rest) order.

    From the bucket histogram the driver reads one row: the target ``n``,
    the first bucket not wholly taken, the rows before it and its size.  The
    plan is then two filters on the bucket number: buckets before the cut are
    kept without any ranking, and only the cut bucket is ranked (by the
    hot-bucket path when it is large).  ``n`` is an int, an expression over
    ``__total`` (the row count of ``df``), or a one-row frame whose only
    column is the count.
    """
    data_cols = list(df.columns)
    hashed = _hashed(df, keys, seed, salt)
    order = _order(df.schema, keys)
    hist = _histogram(hashed)
    totals = hist.agg(F.sum("__cnt").alias("__total"))
    if isinstance(n, DataFrame):
        totals = totals.withColumn("__n", n.select(n.columns[0]).scalar())
    else:
        totals = totals.withColumn("__n", n if isinstance(n, Column) else F.lit(n))
    t = totals.select(F.coalesce(F.col("__total"), F.lit(0)).alias("total"),
                      F.col("__n").cast("bigint").alias("n")).first()
    total, target = t["total"], max(0, min(t["n"] or 0, t["total"]))
    if target == 0:
        return df.filter(F.lit(False))
    if target >= total:
        return df
    cut = hist.filter(F.col("__through") > target).orderBy(_B).select(_B, "__before", "__cnt").first()
    whole = hashed.filter(F.col(_B) < cut[_B]).select(*data_cols)
    need = target - cut["__before"]
    rows = hashed.filter(F.col(_B) == cut[_B])
    if cut["__cnt"] <= hot_rows:
        part = _rank_cold(rows, order, data_cols).filter(F.col("__rn") <= need)
    else:
        hot = _rank_hot(rows, order, keys, hot_rows)
        take = F.greatest(F.lit(0), F.least(F.col("__m"), F.lit(need) - F.col("__first") + 1))
        part = expand(hot.withColumn("__take", take), "__take", 0, "__copy", spread=[_H])
    return whole.unionByName(part.select(*data_cols))


def exact_n_sample(df: DataFrame, fraction: float | str, keys: Sequence[str], seed=42,
                   hot_rows: int = HOT_BUCKET_ROWS) -> DataFrame:
    """Exactly floor(fraction * rows) rows, without replacement, repeatable."""
    return first_n_by_hash(df, sample_size(fraction, F.col("__total")), keys, seed, hot_rows=hot_rows)


def cumulative_thresholds(weights: Sequence[float | str]) -> list[int]:
    """Integer cut points on [0, 2^32) for the cumulative weights (exact)."""
    ws = [Fraction(str(w)) for w in weights]
    total = sum(ws)
    out, run = [], Fraction(0)
    for w in ws:
        run += w
        out.append(int(run / total * TWO_32))
    out[-1] = TWO_32
    return out


def weighted_choice(h: Column, labels: Sequence, weights: Sequence[float | str]) -> Column:
    """R2: the first label whose cumulative cut point exceeds the hash integer."""
    cuts = cumulative_thresholds(weights)
    out = F.lit(labels[-1])
    for label, cut in reversed(list(zip(labels[:-1], cuts[:-1]))):
        out = F.when(h < F.lit(cut), F.lit(label)).otherwise(out)
    return out


def weighted_assign(df: DataFrame, keys: Sequence[str], labels: Sequence, weights: Sequence,
                    col: str, seed=42) -> DataFrame:
    """R2: add a label drawn with the given weights, repeatable per key."""
    return df.withColumn(col, weighted_choice(hash32(*keys, seed=seed, salt=col), labels, weights))


def replicate_rows(df: DataFrame, count_col: str, col: str = "copy_no", chunk: int = EXPAND_CHUNK) -> DataFrame:
    """N copies of each row, numbered 1..n (n <= 0 or null gives none).

    A row with a huge n is cut into chunks spread over tasks (see :func:`expand`).
    """
    n = F.coalesce(F.col(count_col).cast("bigint"), F.lit(0).cast("bigint"))
    out = expand(df.withColumn("__n", n), "__n", 1, col, chunk=chunk, spread=list(df.columns))
    return out.withColumn(col, F.col(col).cast("int")).drop("__n")


def zip_by_rank(a: DataFrame, a_keys: Sequence[str], b: DataFrame, b_keys: Sequence[str],
                seed=42, col: str = "pair_no") -> DataFrame:
    """Pair the i-th row of ``a`` with the i-th row of ``b`` (both in hash order).

    Rows beyond the shorter side stay unpaired.  The pairing key is a dense
    number, uniformly spread, so the equi-join has no hot key.
    """
    an = dense_number(a, a_keys, seed, col, salt="left")
    bn = dense_number(b, b_keys, seed, col, salt="right")
    return an.join(bn, col, "inner")


def serve_in_order(entities: DataFrame, entity_keys: Sequence[str], count_col: str, pool: DataFrame,
                   pool_keys: Sequence[str], seed=42, col: str = "pair_no", hot_rows: int = HOT_BUCKET_ROWS) -> DataFrame:
    """J9 with counts: entities in hash order each take the next ``count_col`` rows of the pool.

    Entity i takes the pool rows numbered (sum of earlier counts) + 1, ...;
    null and negative counts take none.  The running sum is taken in levels
    over ranges of the entities' order
    (:func:`~tallyframe.operators.prefix.running_totals`), so no task orders
    them all or adds up a list that grows with them.  A pool smaller than the
    demand is refused (Q-P): both sides are counted first.
    """
    n = F.greatest(F.coalesce(F.col(count_col).cast("bigint"), F.lit(0).cast("bigint")), F.lit(0).cast("bigint"))
    wanted = entities.withColumn("__want", n)
    demand = int(wanted.agg(F.sum("__want")).first()[0] or 0)
    require_capacity(pool, demand, "pool rows")
    numbered = dense_number(wanted, entity_keys, seed, "__no", salt="left", hot_rows=hot_rows)
    placed = running_totals(numbered, ["__no"], {"__before": "__want"}).withColumn("__first", F.col("__before") + 1).drop("__before", "__no")
    slots = expand(placed.withColumnRenamed("__first", "__from"), "__want", F.col("__from"), col, spread=list(entity_keys)) \
        .drop("__want", "__from")
    return slots.join(dense_number(pool, pool_keys, seed, col, salt="right", hot_rows=hot_rows), col, "inner")
