"""The queries of this package: each dealt operator over its whole table.

Text and vector operators have no exact SQL twin unless listed in
:data:`ORACLES`; the others are tested against brute force, round trips or
held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import collocations, fair_mix, jaccard_join, license_scan, near_vectors, packing, piece_tokens, quality_fm, quality_rules, substring_dedup, suffix_dedup, toxicity, whitening
from tallyframe.llm.oracles import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file, which every executor has."""
    folder = os.environ.get("PUBLIC_TOKENIZERS")
    if folder:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.quality_scores(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


@query
def op9_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_tokens.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op13_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix.per_document(fair_mix.mix(table(spark, sf_dir, "documents")))
