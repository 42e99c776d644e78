"""Repeatable pseudo-randomness from keys.

The generators this library re-expresses draw from a seeded RNG, which gives a
different stream when the work is split across tasks. Here a row's "random"
number is a function of its key and a seed only:

    h(key)   = first 8 hex digits of md5(key || ':' || seed) as an integer in [0, 2^32)

The same integer is computed by ``conv(substr(md5(..), 1, 8), 16, 10)`` in
Spark and ``('0x' || substr(md5(..), 1, 8))::bigint`` in DuckDB, so results
have exact SQL oracles and do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def key_text(*keys: Column | str) -> Column:
    """The text of the keys that :func:`hash32` hashes; as a single key it gives the same hash."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.concat_ws("|", *[c.cast("string") for c in cols])


def hash32(*keys: Column | str, seed: int | str = 42, salt: str | None = None) -> Column:
    """Integer in [0, 2^32) derived from the keys, the seed and an optional salt."""
    text = key_text(*keys)
    if salt is not None:
        text = F.concat(text, F.lit(":" + str(salt)))
    text = F.concat(text, F.lit(":" + str(seed)))
    # md5 hex always parses, so the value is never null; saying so (coalesce)
    # keeps Catalyst from inferring is-not-null filters on the hash and
    # pushing a second md5 per row into scans below aggregates
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))
