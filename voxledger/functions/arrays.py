"""Arithmetic on shape-like array columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def product(values: Column) -> Column:
    return F.aggregate(values, F.lit(1).cast("bigint"), lambda acc, x: acc * x.cast("bigint"))


def ceil_div(a: Column, b: Column) -> Column:
    return F.call_function("div", a + b - 1, b)


def floor_div(a: Column, b: Column) -> Column:
    """Whole quotient of non-negative numbers."""
    return F.call_function("div", a, b)


def cells(shape: Column, chunks: Column) -> Column:
    """Number of chunks a grid has: the product of the per-axis counts."""
    return product(F.zip_with(shape, chunks, ceil_div))


def text_of(values: Column, sep: str = ",") -> Column:
    return F.array_join(F.transform(values, lambda x: x.cast("string")), sep)


def linear_index(coords: Column, shape: Column) -> Column:
    """C-order position of a coordinate (last axis fastest)."""
    return F.aggregate(
        F.zip_with(coords, shape, lambda c, s: F.struct(c.cast("bigint").alias("c"), s.cast("bigint").alias("s"))),
        F.lit(0).cast("bigint"),
        lambda acc, p: acc * p["s"] + p["c"],
    )


def unravel(index: Column, shape: list[Column]) -> list[Column]:
    """Coordinates of a C-order position, one column per axis."""
    out, rest = [], index.cast("bigint")
    for size in reversed(shape[1:]):
        out.append((rest % size).cast("bigint"))
        rest = floor_div(rest, size)
    out.append(rest)
    return out[::-1]


#: Axes that ``explode_axes`` can expand; records allow two to four.
MOST_AXES = 8


def explode_axes(df: DataFrame, first: str, last: str, name: str, axes: int = MOST_AXES) -> DataFrame:
    """One row per index tuple ``name`` between the arrays ``first`` and ``last`` (inclusive).

    One axis is expanded at a time, and rows are spread over tasks after the first, so no value or task
    holds all tuples. Rows may differ in their number of axes, up to ``axes``.
    """
    none = F.array().cast("array<bigint>")
    fits = F.assert_true(F.size(first) <= axes, F.lit(f"more than {axes} axes"))
    out = df.withColumn(name, F.when(fits.isNull(), none))
    for n in range(axes):
        steps = F.when(F.size(first) > n, F.sequence(F.get(first, F.lit(n)), F.get(last, F.lit(n)))).otherwise(
            F.array(F.lit(None).cast("bigint"))
        )
        out = out.withColumn("_step", F.explode(steps))
        out = out.withColumn(name, F.when(F.col("_step").isNull(), F.col(name)).otherwise(F.concat(name, F.array("_step"))))
        if n == 0:
            out = out.repartition(F.xxhash64(*[c for c in df.columns if c not in (first, last)], "_step"))
    return out.drop("_step")
