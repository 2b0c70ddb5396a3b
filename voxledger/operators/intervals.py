"""Byte ranges as intervals: what is covered, and the gaps that are left.

Finished ranges may overlap, lie inside each other, repeat or be empty. Sorted by start, a gap begins
where a start lies beyond the greatest end so far. That greatest end is carried over spans of the order,
so a file with very many ranges is dealt out over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxledger.operators.ordered import SPAN_ROWS, span_of


def missing_ranges(files: DataFrame, done: DataFrame, rows_per_span: int = SPAN_ROWS) -> DataFrame:
    """Gaps (``file``, ``start_byte``, ``end_byte``, inclusive) of ``files`` (``file``, ``total``) outside of ``done``.

    ``done``: ``file``, ``start_byte``, ``end_byte`` (inclusive). Ranges are clipped to their file; empty ones
    (end before start, NULL ends) and those of unknown files count for nothing. A file without ranges is
    one gap, a complete or empty file has none. Files are expected once.
    """
    clipped = done.join(files.select("file", "total"), "file").select(
        "file",
        F.greatest("start_byte", F.lit(0).cast("bigint")).alias("start"),
        F.least(F.col("end_byte"), F.col("total") - 1).alias("end"),
    ).where("start <= end AND start IS NOT NULL AND end IS NOT NULL")
    rows = clipped.withColumn("_span", span_of(clipped, "start", rows_per_span))
    ends = rows.groupBy("file", "_span").agg(F.max("end").alias("reach"))
    earlier = Window.partitionBy("file").orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("file", "_span", F.coalesce(F.max("reach").over(earlier), F.lit(-1).cast("bigint")).alias("carried"))
    inside = Window.partitionBy("file", "_span").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("before", F.max("end").over(inside)).join(carried, ["file", "_span"])
    reach = F.greatest(F.col("carried"), F.coalesce("before", F.lit(-1).cast("bigint")))
    between = local.where(F.col("start") > reach + 1).select("file", (reach + 1).alias("start_byte"), (F.col("start") - 1).alias("end_byte"))
    last = files.join(ends.groupBy("file").agg(F.max("reach").alias("reach")), "file", "left")
    tail = last.where(F.coalesce("reach", F.lit(-1)) < F.col("total") - 1).select(
        "file", (F.coalesce("reach", F.lit(-1).cast("bigint")) + 1).alias("start_byte"), (F.col("total") - 1).alias("end_byte")
    )
    return between.unionByName(tail)


def resume_plan(files: DataFrame, done: DataFrame, chunk_bytes: int, rows_per_span: int = SPAN_ROWS) -> DataFrame:
    """Ranges of at most ``chunk_bytes`` still to be fetched, cut on the file's fixed chunk grid."""
    gaps = missing_ranges(files, done, rows_per_span)
    grid = lambda c: F.call_function("div", F.col(c), F.lit(chunk_bytes).cast("bigint"))
    cut = gaps.select("*", F.explode(F.sequence(grid("start_byte"), grid("end_byte"))).alias("chunk_id"))
    return cut.select(
        "file", "chunk_id", F.greatest("start_byte", F.col("chunk_id") * chunk_bytes).alias("start_byte"),
        F.least("end_byte", (F.col("chunk_id") + 1) * chunk_bytes - 1).alias("end_byte"),
    )
