"""Data-quality checks as DataFrame operators (unique, not null, accepted
values, relationships), a suite report, and a capacity precondition.

Every check pre-aggregates by the tested column before anything is joined,
so a value that fills a third of a table is reduced map-side to one row per
task; nothing is collected except the final one-row-per-test report.

Semantics (the reference's YAML only names the tests):

* unique           a non-null value occurring more than once fails;
                   failures = number of such values
* not_null         failures = null rows
* accepted_values  a non-null value outside the list fails;
                   failures = number of distinct bad values
* relationships    a non-null child value absent from the parent column
                   fails; failures = orphan rows
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bloom import surely_absent

SMALL_DEMAND = 1_000_000        # rows; a limit gathers them in one task
REPORT_COLUMNS = ["model", "column_name", "test_name", "failures", "passed"]


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Q-U detail: each non-null value seen more than once, with its count."""
    return df.select(column).filter(F.col(column).isNotNull()).groupBy(column) \
        .agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q-N detail: null rows per column, all columns in one pass over the table."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    return agg.selectExpr(f"stack({len(columns)}, {stack}) as (column_name, failures)")


def unexpected_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q-A detail: each non-null value outside ``values``, with its row count."""
    c = F.col(column)
    return df.select(column).filter(c.isNotNull() & ~c.isin(list(values))) \
        .groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type in which values of two column types are compared.

    Equal types stay; whole numbers take the wider type; with decimals, a
    decimal that holds both (38 digits at most: a value of one side that does
    not fit cannot equal any of the other); with floats, double; of two date
    or time types, the timestamp.  Text is compared as the other side's type,
    and text that does not parse equals nothing.
    """
    if a == b:
        return a
    kinds = {type(a), type(b)}
    if T.StringType in kinds:
        return b if isinstance(a, T.StringType) else a
    if kinds <= set(_INTEGRAL):
        return max((a, b), key=lambda t: _DIGITS[type(t)])
    if kinds <= {*_INTEGRAL, T.DecimalType}:
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in (a, b))
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[type(t)] for t in (a, b))
        return T.DecimalType(min(38, whole + scale), scale)
    if kinds <= {*_INTEGRAL, T.DecimalType, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if kinds <= set(_TIMES):
        return T.TimestampType() if T.TimestampType in kinds else T.TimestampNTZType()
    raise TypeError(f"values of {a.simpleString()} and {b.simpleString()} cannot be compared")


def as_type(column: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """``column`` in the type it is compared in; null where it has no such value."""
    out = column if given == wanted else column.try_cast(wanted)
    # one zero: as in joins and groupings
    return out + F.lit(0.0) if isinstance(wanted, (T.FloatType, T.DoubleType)) else out


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q-R detail (J10): each non-null child value missing from the parent, with its row count.

    Both sides are compared in their :func:`common_type`.  The child is
    grouped by value first (map-side combined), so what follows sees one row
    per distinct value however skewed the child is.  A Bloom filter of the
    parent's keys tells the values that are surely missing; only the doubtful
    ones meet the parent's distinct keys in the anti join.
    """
    own, other = child.schema[column].dataType, parent.schema[parent_column].dataType
    wanted = common_type(own, other)
    keys = child.select(column).filter(F.col(column).isNotNull()).groupBy(column) \
        .agg(F.count(F.lit(1)).alias("occurrences")).withColumn("__v", as_type(F.col(column), own, wanted))
    parent_keys = parent.select(as_type(F.col(parent_column), other, wanted).alias("__parent_key"))
    told = surely_absent(keys, "__v", parent_keys, "__parent_key", "__absent")
    doubtful = told.filter(~F.col("__absent")).join(parent_keys.distinct(), F.col("__v") == F.col("__parent_key"), "left_anti")
    return told.filter("__absent").unionByName(doubtful).select(column, "occurrences")


def _row(model: str, column: str, test: str, failures) -> DataFrame:
    return failures.select(
        F.lit(model).alias("model"), F.lit(column).alias("column_name"), F.lit(test).alias("test_name"),
        F.col("failures").cast("bigint").alias("failures"),
        (F.col("failures") == 0).alias("passed"))


def check_unique(df: DataFrame, column: str, model: str) -> DataFrame:
    return _row(model, column, "unique", duplicate_values(df, column).agg(F.count(F.lit(1)).alias("failures")))


def check_not_null(df: DataFrame, columns: Sequence[str], model: str) -> DataFrame:
    n = null_counts(df, columns)
    return n.select(
        F.lit(model).alias("model"), "column_name", F.lit("not_null").alias("test_name"),
        F.col("failures").cast("bigint").alias("failures"), (F.col("failures") == 0).alias("passed"))


def check_accepted_values(df: DataFrame, column: str, values: Sequence, model: str) -> DataFrame:
    bad = unexpected_values(df, column, values).agg(F.count(F.lit(1)).alias("failures"))
    return _row(model, column, "accepted_values", bad)


def check_relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                        model: str) -> DataFrame:
    orphans = orphan_values(child, column, parent, parent_column).agg(
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("failures"))
    return _row(model, column, "relationships", orphans)


@dataclass
class Suite:
    """Q-S: declared tests over named tables: one scan per table and one grouping for all tests.

    Every row tells, per test on its table, the value the test is about (if
    any): the value of a unique column, a null, a value outside the list, a
    child's reference, a parent's key.  All of them meet in one grouping by
    (test, value), combined map-side: a row of it is a key, a count and
    whether a parent has the value, however many tests there are.  A parent
    tells its keys once per test that refers to them, so an orphan is a value
    without a parent's entry and no join is needed.  References are compared
    in the :func:`common_type` of child and parent.
    """

    unique: list[tuple[str, str]] = field(default_factory=list)
    not_null: list[tuple[str, str]] = field(default_factory=list)
    accepted_values: list[tuple[str, str, Sequence]] = field(default_factory=list)
    relationships: list[tuple[str, str, str, str]] = field(default_factory=list)

    def run(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        entries: dict[str, list[Column]] = {}     # per model: what its rows tell
        tests: list[tuple[str, str, str]] = []    # model, column, test; its place is its number

        def tell(model: str, value: Column, known: bool = False) -> None:
            """Adds an entry of the test declared next; ``known`` ones are a parent's keys."""
            entries.setdefault(model, []).append(F.struct(F.lit(len(tests)).alias("g"), F.lit(known).alias("known"), value.cast("string").alias("v")))

        def declare(model: str, column: str, test: str, value: Column) -> None:
            tell(model, value)
            tests.append((model, column, test))

        kind = {m: {f.name: f.dataType for f in df.schema.fields} for m, df in tables.items()}
        whole = []                                          # columns whose text does not tell values apart
        for model, col in self.unique:
            if isinstance(kind[model][col], (T.ArrayType, T.MapType, T.StructType)):
                whole.append(check_unique(tables[model], col, model))
            else:
                declare(model, col, "unique", as_type(F.col(col), kind[model][col], kind[model][col]))
        for model, col in self.not_null:
            declare(model, col, "not_null", F.when(F.col(col).isNull(), F.lit("")))
        for model, col, values in self.accepted_values:
            declare(model, col, "accepted_values", F.when(~F.col(col).isin(list(values)), F.col(col)))
        for model, col, parent, parent_col in self.relationships:
            own, other = kind[model][col], kind[parent][parent_col]
            wanted = common_type(own, other)
            tell(parent, as_type(F.col(parent_col), other, wanted), known=True)
            value = as_type(F.col(col), own, wanted)
            # a value that the parent's type does not have is an orphan: told under a text no key has
            declare(model, col, "relationships", F.when(F.col(col).isNotNull(), F.coalesce(value.cast("string"), F.lit("\x00 not of the parent's type"))))
        if not tests:
            return reduce(lambda a, b: a.unionByName(b), whole)

        told = reduce(lambda a, b: a.unionByName(b), [
            tables[m].select(F.inline(F.array(*cols))).filter(F.col("v").isNotNull())   # no lambda: those are interpreted
            for m, cols in entries.items()])
        values = told.groupBy("g", "v").agg(F.max("known").alias("known"), F.count_if(~F.col("known")).alias("n"))
        n = F.col("n")
        per_group = values.groupBy("g").agg(F.array(
            F.count_if(n > 1), F.coalesce(F.sum(n), F.lit(0)), F.count_if(n > 0),
            F.coalesce(F.sum(F.when(~F.col("known"), n)), F.lit(0))).alias("counts"))
        measure = {"unique": 1, "not_null": 2, "accepted_values": 3, "relationships": 4}
        rows = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(c).alias("column_name"), F.lit(t).alias("test_name"),
                                  F.lit(g).alias("__g"), F.lit(measure[t]).alias("__m")) for g, (m, c, t) in enumerate(tests)])
        session = next(iter(tables.values())).sparkSession
        declared = session.range(1).select(F.explode(rows).alias("r")).select("r.*")
        found = declared.join(F.broadcast(per_group), F.col("__g") == F.col("g"), "left")      # one row per group
        failures = F.coalesce(F.element_at("counts", F.col("__m")), F.lit(0)).cast("bigint")
        report = found.select("model", "column_name", "test_name", failures.alias("failures")) \
            .withColumn("passed", F.col("failures") == 0)
        return reduce(lambda a, b: a.unionByName(b), [report, *whole])


class CapacityError(RuntimeError):
    """Raised by :func:`require_capacity` before any dependent work starts."""


def require_capacity(pool: DataFrame, demand: int, what: str = "rows") -> int:
    """Q-P: stop when a pool is smaller than what is demanded.

    The number of rows found is returned; for a small demand the count stops there.
    """
    have = pool.limit(demand).count() if demand <= SMALL_DEMAND else pool.count()
    if have < demand:
        raise CapacityError(f"need {demand} {what} but the pool has only {have}")
    return have
