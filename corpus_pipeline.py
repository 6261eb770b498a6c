"""A training corpus from raw documents: quality, near duplicates, benchmark passages, personal data, tokens."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm import bpe, decontaminate, neardup, pii, quality
from shelfwise.llm.shared import bounded_broadcast, settle_counted, ship, table
from shelfwise.sources.scratch import settle


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text scores at least 0.5; learned from the stage's own rows and the labels."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class: that with the smallest id, then the smallest hash of its text, then of all columns.

    Rows that repeat an id are one document only if their texts are equal; different texts of one id are
    classed each by itself. Rows without an id have no class and stay.
    """
    ship(spark)
    doc_id, mark = F.col("doc_id").cast("long"), F.xxhash64("text")
    marks = docs.where(F.col("doc_id").isNotNull()).select(doc_id.alias("_several"), mark.alias("_mark"))
    several, n_several = settle_counted(marks.groupBy("_several").agg(F.min("_mark").alias("_low"), F.max("_mark").alias("_high")).where("_low < _high").select("_several"), "several-texts")
    keyed = docs.where(F.col("doc_id").isNotNull()).withColumn("_row_key", doc_id)
    if n_several:  # their rows go by a hash of id and text
        keyed = keyed.join(bounded_broadcast(several, n_several, neardup.BROADCAST_ROWS), F.col("_row_key") == F.col("_several"), "left")
        keyed = keyed.withColumn("_row_key", F.when(F.col("_several").isNotNull(), F.xxhash64("_row_key", "text")).otherwise(F.col("_row_key"))).drop("_several")
    classes = neardup.classes(keyed.select(F.col("_row_key").alias("doc_id"), "text"))
    if n_several:
        keys = keyed.select("_row_key", doc_id.alias("_id"), mark.alias("_mark")).distinct()
        first = classes.distinct().join(keys, F.col("doc_id") == F.col("_row_key")).groupBy("class_id").agg(F.min(F.struct("_id", "_mark", "_row_key")).alias("_first"))
        kept = first.select(F.col("_first._row_key").alias("_kept_key"))
    else:
        kept = classes.where("class_id = doc_id").select(F.col("doc_id").alias("_kept_key")).distinct()
    named = keyed.join(settle(kept, "kept"), F.col("_row_key") == F.col("_kept_key"), "left_semi")
    place = F.row_number().over(Window.partitionBy("_row_key").orderBy(F.xxhash64(*docs.columns)))
    named = named.withColumn("_place", place).where("_place = 1").select(*docs.columns)
    return named.unionByName(docs.where(F.col("doc_id").isNull()))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    return decontaminate.without_contained(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, personal data in `text` replaced by its kind; `n_chars` follows the new text."""
    ship(spark)
    masked = pii.mask(docs, pii.train())
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its token identifiers."""
    ship(spark)
    return bpe.with_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("personal_data", mask_personal_data),
    ("tokens", encode_tokens),
]

ORACLE_SQL: str | None = None
"""Compression, sampling and tokenisation cannot be written in SQL; tests/llm compares with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
