"""From raw documents to a training mix: five stages, each written and read again before the next.

Language identification rejects documents of no language, SimHash keeps one of each near-duplicate group, decontamination removes documents that hold benchmark passages, the secret scan masks
credentials, and mixing assigns what is left to a curriculum. The first four return the columns of
``documents``; the last returns the mix. Every stage gets all that the one before it kept.

This file belongs to the subpackage ``voxledger.llm``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.llm import decontaminate, langid, mixing, secrets, simhash
from voxledger.llm.common import documents
from voxledger.session import configure, remove_dir, shared_dir


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; null texts and texts without letters go.

    The network learns from the stage's own input, outside the held-out fold.
    """
    configure(spark)
    return langid.keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that with the smallest id: see ``simhash.keep_one``.

    Groups are texts whose SimHash over three-word shingles differs in two bits at most. Null and empty
    texts are one group, repeated rows too; clashing names stay; an empty table gives an empty one.
    """
    configure(spark)
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth stand in a benchmark window.

    Null and empty texts have no words and stay, as do repeated rows; texts are searched whole.
    """
    return decontaminate.remove_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with credentials in their texts masked and ``n_chars`` counted anew.

    Every found span is masked; a value in more than two sources or a hundred documents is an example.
    """
    configure(spark)
    return secrets.mask_secrets(docs, n_chars="n_chars", copied=True)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: one row per document and epoch, sorted by training position."""
    configure(spark)
    return mixing.curriculum(docs).select(
        F.col("id").alias("doc_id"), "source", "epoch", "taken", "position"
    )


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

# A trained network and XXH64 can't be told in SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is stored in the shared folder.

    A stage's folder goes when the next one's is complete; the last one's stays, as the result reads it.
    """
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_dir(spark, before)
        before = path
    return docs
