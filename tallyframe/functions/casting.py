"""Declarative text-to-type casts for raw tables (every raw column is text).

A cast spec is an ordered list of :class:`ColumnCast`; :func:`apply_casts`
turns it into one ``select`` so Catalyst sees plain ``Cast`` expressions that
stay inside whole-stage codegen and let untouched columns be pushed down.

ANSI mode is expected to be on: a value that does not parse raises instead of
silently becoming null.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ColumnCast:
    """One output column of a staging projection.

    name          output column name
    source        raw column name (defaults to ``name``)
    dtype         Spark SQL type name, or ``None`` to keep the text
    blank_is_null turn ``''`` into null before the cast (quoted blanks)
    integral_text parse integral-looking text such as ``4.0`` into an int,
                  failing on a non-zero fraction (see :func:`int_from_text`)
    trim          strip surrounding white space first (P22)
    """

    name: str
    source: str | None = None
    dtype: str | None = None
    blank_is_null: bool = False
    integral_text: bool = False
    trim: bool = False

    def column(self) -> Column:
        c = F.col(self.source or self.name)
        if self.trim:
            c = F.trim(c)
        if self.blank_is_null:
            c = blank_to_null(c)
        if self.integral_text:
            c = int_from_text(c, self.dtype or "int")
        elif self.dtype is not None:
            c = c.cast(self.dtype)
        return c.alias(self.name)


def blank_to_null(c: Column) -> Column:
    """An empty string means missing."""
    return F.nullif(c, F.lit(""))


def int_from_text(c: Column, dtype: str = "int") -> Column:
    """Integral-looking text (``4.0``) to an integer.

    A straight text-to-int cast rejects ``4.0``; ``try_cast`` would turn every
    such value into null. Parse as decimal, require a zero fraction, then cast.
    A non-zero fraction (``4.5``) raises.
    """
    d = c.cast("decimal(38,6)")
    return (
        F.when(d.isNull(), F.lit(None).cast(dtype))
        .when(d == F.floor(d), d.cast(dtype))
        .otherwise(F.raise_error(F.concat(F.lit("non-integral value for integer column: "), c)).cast(dtype))
    )


def apply_casts(df: DataFrame, spec: list[ColumnCast]) -> DataFrame:
    """P1 + P3-P9: explicit projection with renames and casts."""
    return df.select(*[s.column() for s in spec])
