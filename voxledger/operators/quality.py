"""Policies and custom rules that a configuration states per source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxledger.functions import variants as V


@dataclass(frozen=True)
class CustomRule:
    """A field that some sources must have, or a pattern its text must match."""

    path: str
    required_for: list[str] = field(default_factory=list)
    pattern: str | None = None


def custom_rule_rows(records: DataFrame, rules: list[CustomRule]) -> DataFrame:
    """One row per broken custom rule: (file, source, field, rule)."""
    hits: list[Column] = []
    for rule in rules:
        value = V.leaf(F.col("v"), rule.path)
        if rule.required_for:
            missing = value.isNull() & F.col("source").isin(*rule.required_for)
            hits.append(F.when(missing, F.struct(F.lit(rule.path).alias("field"), F.lit("required").alias("rule"))))
        if rule.pattern:
            text = V.as_text(F.col("v"), rule.path)
            wrong = value.isNotNull() & ~F.coalesce(text.rlike(rule.pattern), F.lit(False))
            hits.append(F.when(wrong, F.struct(F.lit(rule.path).alias("field"), F.lit("format").alias("rule"))))
    rows = records.where("load_error IS NULL").select(
        "file", "source", F.explode_outer(F.array_compact(F.array(*hits))).alias("h")
    )
    return rows.where("h IS NOT NULL").select("file", "source", "h.*")


def apply_policy(files: DataFrame, policy: DataFrame) -> DataFrame:
    """Join the per-source policy and judge format, size and checksum.

    ``policy``: source, formats (array), max_bytes, need_checksum.
    """
    judged = files.join(policy, "source", "left")
    return judged.withColumn(
        "policy",
        F.when(F.col("formats").isNull(), "no_policy")
        .when(~F.array_contains("formats", F.col("format")), "format")
        .when(F.col("nbytes") > F.col("max_bytes"), "too_large")
        .when(F.col("need_checksum") & F.col("sha256").isNull(), "no_checksum")
        .otherwise("ok"),
    )
