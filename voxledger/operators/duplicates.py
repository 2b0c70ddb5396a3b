"""Duplicate records by id, by content hash and by metadata pattern.

A group of copies is described by its size and its first member; members point
at that first member.  Pairs within a group are never listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_groups(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Groups of more than one row per key: size, first and last member."""
    return (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("copies"), F.min(member).alias("first"), F.max(member).alias("last"))
        .where("copies > 1")
    )


def duplicate_members(rows: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Each copy linked to the first member of its group.

    The group table has a row per group; a group with a third of all rows makes a hot key, whose
    partition adaptive execution splits.
    """
    groups = duplicate_groups(rows, keys, member).select(*keys, "first", "copies")
    linked = rows.join(groups, keys)
    return linked.where(F.col(member) != F.col("first"))


def pattern_key(*fields: Column) -> Column:
    """Fingerprint of the fields a reprocessed data set repeats."""
    return F.sha2(F.concat_ws("\u0001", *[F.coalesce(f.cast("string"), F.lit("\u0002")) for f in fields]), 256)
