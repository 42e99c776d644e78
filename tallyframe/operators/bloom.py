"""A Bloom filter over the keys of a table, as a DataFrame of 64-bit words.

Each key sets four bits of one word, so a look-up is one equi-join on the
word's number.  The words are counted from the keys (about sixteen bits a
key) up to ``MOST_WORDS``, which bounds what is broadcast (32 MB of words);
beyond it the filter only lets more keys through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_WORDS = 1 << 22
BITS_PER_KEY = 4                 # set in its word
_W, _M = "__word", "__mask"


def _mask(key: Column) -> Column:
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS_PER_KEY)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _word(key: Column, words: Column) -> Column:
    return F.pmod(F.xxhash64(key), words)


def surely_absent(values: DataFrame, column: str, keys: DataFrame, key: str, out: str = "absent",
                  most_words: int = MOST_WORDS) -> DataFrame:
    """``values`` with a flag ``out``: true only where no key can equal the value (both of one type).

    ``keys`` is read twice for the filter: its count, and the words, which
    are combined map-side.  A null value is flagged.
    """
    known = keys.select(F.col(key).alias("__k")).filter(F.col("__k").isNotNull())
    words = known.agg(F.least(F.greatest(F.ceil(F.count(F.lit(1)) / 4), F.lit(1)), F.lit(most_words)).cast("bigint").alias("n")).scalar()
    table = known.select(_word(F.col("__k"), words).alias(_W), _mask(F.col("__k")).alias(_M)) \
        .groupBy(_W).agg(F.bit_or(_M).alias("__bits"))
    asked = values.withColumns({_W: F.when(F.col(column).isNotNull(), _word(F.col(column), words)), _M: _mask(F.col(column))})
    found = asked.join(F.broadcast(table), _W, "left")
    held = F.coalesce(F.col("__bits").bitwiseAND(F.col(_M)) == F.col(_M), F.lit(False))
    return found.withColumn(out, ~held).drop(_W, _M, "__bits")
