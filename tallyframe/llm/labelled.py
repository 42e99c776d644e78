"""Labelled rows for the classifiers: a bounded, repeatable sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, folds: int, held: int) -> Column:
    """Whether crc32 of the id's text falls in the held-out fold; a null id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == held, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, column: str, folds: int, held: int, max_rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents outside the held-out fold.

    Taken in order of a hash of the id, so the sample is the same on every
    run.  Null ids and labels are left out; of repeated labels the largest
    counts.  The label side is bounded by ``max_rows``, so it is broadcast.
    """
    rows = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~fold("doc_id", folds, held))
            .groupBy("doc_id").agg(F.max(F.col(column)).cast("int").alias("__tf_label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    return docs.select("doc_id", "text").join(F.broadcast(rows), "doc_id")
