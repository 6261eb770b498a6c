"""One query per operator, with its production parameters, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import (
    ann,
    bpe,
    decontaminate,
    fingerprints,
    html_text,
    langid,
    neardup,
    pii,
    quality,
    token_count,
    url_filter,
    vector_codes,
    whitening,
)
from shelfwise.llm.shared import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"), pii.train())


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.train(docs))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), html_text.train())


def op6_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_language": op2_language,
    "op3_url_filter": op3_url_filter,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_main_text": op5_main_text,
    "op6_token_count": op6_token_count,
    "op7_decontamination": op7_decontamination,
    "op8_bpe": op8_bpe,
    "op9_neighbours": op9_neighbours,
    "op10_quality": op10_quality,
    "op11_whitening": op11_whitening,
    "op12_vector_codes": op12_vector_codes,
    "op13_fingerprints": op13_fingerprints,
}

ORACLES: dict[str, str] = {
    "op3_url_filter": url_filter.ORACLE,
    "op7_decontamination": decontaminate.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
"""The others have no SQL form; tests/llm holds them against brute force, the libraries or held-out labels."""
