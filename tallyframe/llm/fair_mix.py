"""Mixing sources to target weights by weighted fair queueing (operator 13, [native]).

Every source queues its documents in shuffled order, up to ``max_repeats``
times over.  A document's *virtual finish time* is the number of words its
source has queued up to and including it, divided by the source's target:
all sources reach time 1 together.  The queues are merged by a global range
sort on that time, and the merged stream is cut where it holds the budget.

* The size of a document is its number of words ``[^\\x20\\x09-\\x0D]+``.
* Targets share the budget by weight; a target stops at ``max_repeats`` times
  its source's size and the excess is shared again among the others, until
  none is above (:func:`targets`).
* The document in service when its source reaches its target is queued as
  two pieces, cut there, so a long document does not move its source away
  from its target.  Pieces past that one can never be reached: the second
  pieces alone hold the words that whole numbers leave of the budget.
* Repeated rows (equal source, id and size) are queued one after another and
  are told apart by a copy number.

Scale: one pass over the texts counts words; all else works on (source, id,
size).  A running total inside a source goes over buckets of the shuffle
hash, so no task holds a source; the order over all sources, their numbering
and their water level are :func:`~tallyframe.operators.prefix.running_totals`,
which never sort in one task.  Only DataFrame operations are used.

Defined cases: a null text has size 0; documents of size 0 are returned with
nothing taken; a null source is a source of its own, the last one; null ids
are ids like any other; an empty table gives an empty result; other columns
of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.shared import stored
from tallyframe.operators.prefix import running_totals
from tallyframe.operators.sampling import expand

WHITE = r"\x20\x09-\x0D"
ID, COPY = "__doc", "__copy"


@dataclass(frozen=True)
class Settings:
    weights: Sequence[int] = (5, 2, 1)   # of the sources in code point order, repeating
    max_repeats: int = 3
    seed: int = 13
    bucket_rows: int = 1024              # documents of one source that a task orders, about ...
    most_bits: int = 20                  # ... while a source has at most 2 ** most_bits buckets


def word_count(text: Column) -> Column:
    """Number of words of a text; one pass that keeps one character a word."""
    one_each = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]*+[^{WHITE}]++", "x")
    return F.length(F.regexp_replace(one_each, f"[{WHITE}]++$", "")).cast("bigint")


def sizes(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """(id, source, size, copies): each distinct document head and how often it occurs."""
    return docs.select(F.col(doc_id).alias(ID), F.col(source).alias("source"), word_count(F.col(text)).alias("size")) \
        .groupBy(ID, "source", "size").agg(F.count(F.lit(1)).alias("copies"))


def targets(sources: DataFrame, budget: int | None = None, settings: Settings = Settings()) -> DataFrame:
    """(source, source_size) -> the same with weight and target (double).

    The water level: with sources in order of the level at which they fill up
    (``max_repeats`` x size / weight), a source is full if, were the level just
    its own, the full ones before it and the others' shares would not pass the
    budget.  Compared in whole numbers: level x common multiple of the weights.
    """
    s = settings
    unit = lcm(*s.weights)
    kinds = F.array(*[F.lit(int(w)) for w in s.weights])
    last = F.struct(F.col("source").isNull(), F.col("source"))
    numbered = running_totals(sources.withColumn("__one", F.lit(1)), [last], {"__no": "__one"}, keep=stored)
    wide = "decimal(38,0)"
    rows = numbered.withColumn("weight", F.get(kinds, (F.col("__no") % len(s.weights)).cast("int")).cast("bigint")) \
        .withColumn("__cap", (F.col("source_size") * s.max_repeats).cast(wide)) \
        .withColumn("__level", (F.col("__cap") * (unit / F.col("weight")).cast("bigint")).cast(wide))
    rows = rows.select("source", "source_size", "weight", "__cap", "__level")
    whole = rows.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights"), F.sum("__cap").alias("room")).first()
    total = min(int(whole.words or 0) if budget is None else int(budget), int(whole.room or 0))
    levels = running_totals(rows, ["__level", last], {"__filled": "__cap", "__passed": "weight"}, keep=stored)
    # at the source's own level: full ones before it hold their caps, the rest (itself included) level x weight
    at = F.col("__filled") * unit + F.col("__level") * (F.lit(int(whole.weights or 0)) - F.col("__passed"))
    full = levels.withColumn("__full", at <= F.lit(total * unit).cast(wide))
    sums = full.agg(F.sum(F.when(~F.col("__full"), F.col("weight"))).alias("left"), F.sum(F.when(F.col("__full"), F.col("__cap"))).alias("held")).first()
    share = F.lit(float((total - int(sums.held or 0)) / (sums.left or 1)))
    return full.select("source", "source_size", "weight",
                       F.when(F.col("__full"), F.col("__cap").cast("double")).otherwise(share * F.col("weight")).alias("target"))


def mix(docs: DataFrame, budget: int | None = None, settings: Settings = Settings(), doc_id: str = "doc_id",
        source: str = "source", text: str = "text") -> DataFrame:
    """The mixed stream: one row per queued piece of a document, and one per document without any.

    ``__doc, source, size, __copy`` tell the document; ``source_size`` and
    ``target`` its source; ``round`` (0 for the first time over), ``start``
    and ``length`` the piece's words; ``finish`` its virtual finish time;
    ``position`` the words of the stream before it; ``taken`` how many of the
    piece's words fit the budget (all but for the last piece, and none after
    it).  Without ``budget`` the stream is as long as all documents together.
    """
    s = settings
    heads = stored(sizes(docs, doc_id, source, text))
    per_source = heads.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    goal = targets(per_source, budget, s)
    facts = heads.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("size") * F.col("copies")).alias("words")).first()
    bits = min(s.most_bits, max(0, ((facts.rows or 0) // s.bucket_rows).bit_length()))
    total = int(facts.words or 0) if budget is None else int(budget)

    # the shuffle: documents of a source in order of a hash, in buckets of its leading bits
    h = F.xxhash64(F.lit(s.seed), F.col(ID).cast("string"), F.col("size"))
    shuffled = heads.withColumn("__h", h).withColumn("__bucket", F.shiftright("__h", 64 - bits).cast("int") if bits else F.lit(0)) \
        .withColumn("__words", F.col("size") * F.col("copies"))
    key = F.struct(F.col("source").isNull(), F.coalesce("source", F.lit("")))       # null-safe join key
    buckets = shuffled.groupBy("source", "__bucket").agg(F.sum("__words").alias("__sum"))
    before = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    buckets = buckets.withColumn("__before", F.sum("__sum").over(before) - F.col("__sum")) \
        .withColumn("__key", key).drop("source", "__sum") \
        .join(goal.withColumn("__key", key).select("__key", "source_size", "target"), "__key")
    inside = Window.partitionBy("__key", "__bucket").orderBy("__h", ID, "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = shuffled.withColumn("__key", key).join(buckets, ["__key", "__bucket"]) \
        .withColumn("__before", F.col("__before") + F.sum("__words").over(inside) - F.col("__words"))
    copies = expand(queued.select(ID, "source", "size", "copies", "source_size", "target", "__before"), "copies", 0, COPY,
                    spread=[ID, "size"]).withColumn("__before", F.col("__before") + F.col(COPY) * F.col("size"))

    # every time over that begins before the target, cut where the target is reached
    cut = F.floor("target").cast("bigint")
    begin = F.col("__before") + F.col("round") * F.col("source_size")
    rounds = F.filter(F.sequence(F.lit(0), F.lit(s.max_repeats - 1)),
                      lambda r: F.col("__before") + r * F.col("source_size") < F.col("target"))
    times = copies.withColumn("round", F.explode_outer(F.when(F.col("size") > 0, rounds))).withColumn("__begin", begin)
    middle = F.greatest(F.lit(0), F.least(F.col("size"), cut - F.col("__begin")))
    pieces = times.withColumn("__piece", F.explode_outer(F.when(F.col("round").isNotNull(), F.filter(F.array(
        F.struct(F.lit(0).cast("bigint").alias("start"), middle.alias("length")),
        F.struct(middle.alias("start"), (F.col("size") - middle).alias("length"))), lambda p: p["length"] > 0)))) \
        .select(ID, "source", "size", COPY, "source_size", "target", "round", "__begin", "__piece.start", "__piece.length") \
        .withColumn("finish", (F.col("__begin") + F.col("start") + F.col("length")) / F.col("target"))

    # documents that are not queued come last and add nothing; their hash spreads them over the ranges
    idle = F.when(F.col("length").isNull(), F.xxhash64(ID, "size", COPY))
    order = [F.col("finish").asc_nulls_last(), idle, F.col("source").asc_nulls_last(), F.col("__begin"), F.col("start"), F.col(COPY)]
    stream = running_totals(pieces, order, {"position": "length"}, keep=stored)
    taken = F.greatest(F.lit(0), F.least(F.coalesce("length", F.lit(0)), F.lit(total) - F.col("position")))
    return stream.drop("__begin").withColumn("taken", taken.cast("bigint"))


def per_document(stream: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per document: (doc_id, size, source_size, target, taken, source)."""
    return stream.groupBy(ID, "source", "size", COPY).agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("taken").alias("taken")) \
        .select(F.col(ID).alias(doc_id), "size", "source_size", "target", "taken", "source")


def mixed_words(docs: DataFrame, stream: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: (position, doc_id, source, text) of every taken piece; sort by ``position``.

    A piece's text is its words joined by one space.  Copies of a row share
    one text, so they are joined by (id, source, size) as one.
    """
    texts = docs.select(F.col(doc_id).alias(ID), F.col(source).alias("source"), F.col(text).alias("__text")) \
        .withColumn("size", word_count(F.col("__text")))
    one = texts.groupBy(F.col(ID).alias("__i"), F.col("source").alias("__s"), F.col("size").alias("__n")).agg(F.min("__text").alias("__text"))
    words = F.expr(f"split(trim(BOTH ' ' FROM regexp_replace(__text, '[{WHITE}]+', ' ')), ' ')".replace("\\", "\\\\"))
    got = stream.where("taken > 0").join(one, F.col(ID).eqNullSafe(F.col("__i")) & F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__n")))
    return got.select("position", F.col(ID).alias(doc_id), "source",
                      F.array_join(F.slice(words, F.col("start").cast("int") + 1, F.col("taken").cast("int")), " ").alias("text"))
