"""A training corpus from ``documents``: five stages, each one operator of ``tallyframe.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.

Defined cases, as each operator states them for itself: any column may be
null and extra columns are dropped; a null or empty text is not toxic and
fails the quality rules; a null doc_id counts as larger than any other; of
rows with one doc_id all or none stay as near duplicates, and neither removes
passages of the other; an empty table passes through as an empty table, and
packs into no sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import jaccard_join, packing, quality_rules, substring_dedup, toxicity
from tallyframe.llm.catalog import table, tokenizer
from tallyframe.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones, scores under its limit."""
    docs = docs.select(COLUMNS)
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules.reject(docs.select(COLUMNS))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of near duplicates."""
    docs = docs.select(COLUMNS)
    first = jaccard_join.join(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    return docs.join(first.withColumnRenamed("doc_id", "__tf_id"), F.col("doc_id").eqNullSafe(F.col("__tf_id")), "left_semi")


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of 50-word passages that an earlier document has; ``n_chars`` follows."""
    out = substring_dedup.dedup(docs, carry=["lang", "source", "n_chars"], keep_text=True)
    return out.select("doc_id", "text", "lang", "source",
                      F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces, packed into sequences."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("substring dedup", drop_repeated_passages),
    ("best-fit packing", pack_sequences),
]

#: no stage but the exact word rules can be told in SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
