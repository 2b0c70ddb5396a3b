"""Registered queries of the training-data operators; their SQL twins are in ``oracles``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voxledger.llm import (
    collocations,
    decontaminate,
    embedding_join,
    langid,
    licenses,
    mixing,
    quality,
    quartile_digest,
    secrets,
    simhash,
    token_alignment,
    token_counts,
    warc_zip,
)
from voxledger.llm.common import documents
from voxledger.llm.oracles import ORACLES

TOKENIZER = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_table(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_table(documents(spark, sf_dir))


def op3_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_table(documents(spark, sf_dir, "embeddings"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_table(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = token_counts.PieceVocabulary.load(public_tokenizers.path(TOKENIZER))
    return token_counts.token_table(documents(spark, sf_dir), vocabulary)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.archive_table(spark, documents(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_table(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_table(documents(spark, sf_dir))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(documents(spark, sf_dir))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_table(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocation_table(documents(spark, sf_dir))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.fingerprint_table(documents(spark, sf_dir))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_alignment.alignment_table(
        documents(spark, sf_dir), public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(TOKENIZER)
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_simhash,
        op3_embedding_join,
        op4_language,
        op5_token_counts,
        op6_warc,
        op7_quality,
        op8_secrets,
        op9_mixing,
        op10_licenses,
        op11_collocations,
        op12_fingerprints,
        op13_alignment,
    )
}

__all__ = ["ORACLES", "QUERIES"]
