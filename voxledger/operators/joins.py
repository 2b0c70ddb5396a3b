"""Keyed lookups: directories, fallbacks, work lists, overlays.

A hot key is left to adaptive execution, which splits its partitions by their measured size; the session
settings let it do so even where that costs one more shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_or_error(rows: DataFrame, table: DataFrame, key: str, value: str, message: str) -> DataFrame:
    """Left lookup; a miss becomes an ``error`` text with the key, the row stays."""
    hit = table.select(key, value)
    return rows.join(hit, key, "left").withColumn(
        "error", F.when(F.col(value).isNull(), F.format_string(message, F.col(key).cast("string")))
    )


def primary_or_fallback(keys: DataFrame, primary: DataFrame, fallback: DataFrame, key: str, value: str) -> DataFrame:
    """First result that exists per key, with where it came from."""
    first = primary.select(key, F.col(value).alias("_a"))
    second = fallback.select(key, F.col(value).alias("_b"))
    origin = F.when(F.col("_a").isNotNull(), "primary").when(F.col("_b").isNotNull(), "fallback").otherwise("failed")
    return (
        keys.join(first, key, "left").join(second, key, "left")
        .withColumns({value: F.coalesce("_a", "_b"), "origin": origin})
        .drop("_a", "_b")
    )


def work_list(planned: DataFrame, finished: DataFrame, keys: list[str]) -> DataFrame:
    """Planned minus finished."""
    return planned.join(finished.select(*keys), keys, "left_anti")


def known_only(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose key a dimension lists."""
    return rows.join(dimension.select(key), key, "left_semi")


def overlay(defaults: DataFrame, per_source: DataFrame, environment: DataFrame, value: str = "value") -> DataFrame:
    """Parameters by precedence: environment, then per source, then default.

    ``defaults`` and ``environment``: (name, value); ``per_source``: (source,
    name, value).  Every source gets every default.
    """
    env = environment.select("name", F.col(value).alias("_env"))
    own = per_source.select("source", "name", F.col(value).alias("_own"))
    base = defaults.select("source", "name", F.col(value).alias("_default"))
    merged = base.join(own, ["source", "name"], "full").join(env, "name", "left")
    return merged.select("source", "name", F.coalesce("_env", "_own", "_default").alias(value))
