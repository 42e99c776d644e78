"""Scalar column expressions (P10-P28). All are built-in Spark expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..fixed_values import MILES_TO_KM


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def threshold_flag(cols: Sequence[Column | str], threshold: int | float) -> Column:
    """P10: sum of the columns >= threshold; anything else, null included, is false."""
    total = None
    for c in cols:
        total = _c(c) if total is None else total + _c(c)
    return F.coalesce(total >= F.lit(threshold), F.lit(False))


def case_insensitive_map(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Map lower-cased text through ``mapping``; unmatched values keep their text."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k.lower()), F.lit(v)]
    m = F.create_map(*pairs)
    # try_element_at: a missing key gives null instead of an ANSI error
    return F.coalesce(F.try_element_at(m, F.lower(_c(c))), _c(c))


def default_zero(c: Column | str) -> Column:
    """A missing measure counts as zero."""
    return F.coalesce(_c(c), F.lit(0))


def guarded_ratio(num: Column | str, den: Column | str, places: int = 2,
                  dtype: str = "decimal(18,2)") -> Column:
    """P14 + P15: ``round(num / den, places)`` when ``den > 0``, else null.

    Not ``try_divide``: a negative denominator must also give null. Decimal
    inputs keep decimal division, so the rounding is half away from zero.
    """
    n, d = _c(num), _c(den)
    return F.when(d > 0, F.round(n / d, places)).cast(dtype)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """Whole days from ``earlier`` to ``later`` as bigint."""
    return F.datediff(_c(later), _c(earlier)).cast("bigint")


def flag01(cond: Column) -> Column:
    """P20: 1 where the condition holds, else 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def clamp(c: Column | str, low: Column | None = None, high: Column | None = None) -> Column:
    """Bound a value from below and/or above."""
    out = _c(c)
    if low is not None:
        out = F.greatest(out, low)
    if high is not None:
        out = F.least(out, high)
    return out


def first_keyword_band(c: Column | str, bands: Sequence[tuple[str, tuple[int, int]]],
                       default: tuple[int, int]) -> Column:
    """The first keyword (in declared order) contained in the lower-cased
    text picks a (low, high) pair; otherwise the default pair."""
    text = F.lower(F.coalesce(_c(c), F.lit("")))
    out = F.struct(F.lit(default[0]).alias("low"), F.lit(default[1]).alias("high"))
    for kw, (lo, hi) in reversed(list(bands)):
        out = F.when(text.contains(kw.lower()),
                     F.struct(F.lit(lo).alias("low"), F.lit(hi).alias("high"))).otherwise(out)
    return out


def any_keyword(c: Column | str, keywords: Sequence[str]) -> Column:
    """True when the lower-cased text contains any keyword."""
    text = F.lower(F.coalesce(_c(c), F.lit("")))
    out = F.lit(False)
    for kw in keywords:
        out = out | text.contains(kw.lower())
    return out


def title_label(theme: Column | str, code: Column | str, sep: str = " - ") -> Column:
    """P25: ``theme || sep || Title Case(code with '_' as spaces)``."""
    return F.concat_ws(sep, _c(theme), F.initcap(F.regexp_replace(_c(code), "_", " ")))


def lifecycle_status(end: Column | str, as_of: Column) -> Column:
    """``completed`` when the end date is before the as-of date, else ``active``."""
    return F.when(_c(end) < as_of, F.lit("completed")).otherwise(F.lit("active"))


def miles_to_km(c: Column | str, dtype: str = "decimal(18,2)") -> Column:
    """Miles to kilometres, rounded half-up to 2 places (decimal arithmetic)."""
    return F.round(_c(c).cast("decimal(18,6)") * F.lit(MILES_TO_KM).cast("decimal(8,5)"), 2).cast(dtype)


def truncating_int(c: Column | str) -> Column:
    """Numeric text such as ``123.0`` to int, truncating toward zero."""
    return _c(c).cast("double").cast("int")


def padded_id(prefix: str, n: Column | str, width: int = 7) -> Column:
    """``prefix_0000042`` style identifiers from a dense number."""
    number = _c(n).cast("bigint")
    text = number.cast("string")
    # the formatter is slow: only what it alone pads (a sign, a null) goes through it
    return F.when(number >= 0, F.concat(F.lit(f"{prefix}_"), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))) \
        .otherwise(F.format_string(f"{prefix}_%0{width}d", number))
