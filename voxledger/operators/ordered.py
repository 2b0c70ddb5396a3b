"""Running totals and previous values without one task per key.

A window partitioned by a hot key sorts all of its rows in one task.  Here the
order is cut into spans of equal row counts: a small table holds one row per key and span,
the window over that table carries totals across spans, and the row-level
window stays inside a span.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN_ROWS = 100_000  # rows of all keys in a span
FINE = 64  # spans are found in two steps of this many bounds


def span_of(df: DataFrame, order: str, rows_per_span: int = SPAN_ROWS) -> Column:
    """The span of a row: the order column cut at quantiles, so spans hold about equal numbers of rows.

    One pass counts rows and takes at most 4,096 quantiles, whatever the values are; the bounds are a
    constant of the plan. Rows with equal order values share a span, so a span is only a way to deal
    work: any bounds give the same sums.
    """
    total = df.agg(F.count(order)).first()[0]
    spans = min(FINE * FINE, -(-total // rows_per_span))
    if spans <= 1:
        return F.lit(0)
    cuts = [i / spans for i in range(1, spans)]
    bounds = sorted(set(df.agg(F.percentile_approx(order, cuts, 10 * spans)).first()[0]))
    # Bound lists of FINE values each; the first values of the lists are the coarse bounds.
    lists = [bounds[i : i + FINE] for i in range(0, len(bounds), FINE)]
    kind = "array<bigint>"
    coarse = F.from_json(F.lit(json.dumps([x[0] for x in lists])), kind)
    fine = F.from_json(F.lit(json.dumps(lists)), f"array<{kind}>")
    value = F.col(order).cast("bigint")
    at = F.size(F.filter(coarse, lambda b: b <= value))
    within = F.size(F.filter(F.element_at(fine, F.greatest(at, F.lit(1))), lambda b: b <= value))
    return F.when(at == 0, F.lit(0)).otherwise((at - 1) * FINE + within)


def running(
    df: DataFrame,
    keys: list[str],
    order: str,
    measures: dict[str, Column],
    inclusive: bool = False,
    rows_per_span: int = SPAN_ROWS,
) -> DataFrame:
    """Running sums of ``measures`` per key by a unique integer order column.

    Sums cover the rows before the current one, and the row itself when
    ``inclusive``.
    """
    rows = df.withColumn("_span", span_of(df, order, rows_per_span))
    rows = rows.withColumns({f"_m_{name}": value for name, value in measures.items()})
    totals = rows.groupBy(*keys, "_span").agg(*[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in measures])
    before = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, "_span", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in measures]
    )
    inside = (
        Window.partitionBy(*keys, "_span")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    local = rows.select("*", *[F.coalesce(F.sum(f"_m_{n}").over(inside), F.lit(0)).alias(f"_l_{n}") for n in measures])
    joined = local.join(carried, [*keys, "_span"])
    return joined.select(
        *df.columns, *[(F.col(f"_c_{n}") + F.col(f"_l_{n}")).alias(n) for n in measures]
    )


def previous(df: DataFrame, keys: list[str], order: str, values: dict[str, str], rows_per_span: int = SPAN_ROWS) -> DataFrame:
    """The previous row's values per key by a unique integer order column."""
    rows = df.withColumn("_span", span_of(df, order, rows_per_span))
    last = F.max_by(F.struct(*values.values()), F.col(order))
    ends = rows.groupBy(*keys, "_span").agg(last.alias("_last"))
    over_spans = Window.partitionBy(*keys).orderBy("_span")
    carried = ends.select(*keys, "_span", F.lag("_last").over(over_spans).alias("_carried"))
    inside = Window.partitionBy(*keys, "_span").orderBy(order)
    local = rows.select(
        "*",
        F.row_number().over(inside).alias("_n"),
        F.lag(F.struct(*values.values())).over(inside).alias("_before"),
    )
    joined = local.join(carried, [*keys, "_span"])
    chosen = F.when(F.col("_n") == 1, F.col("_carried")).otherwise(F.col("_before"))
    return joined.withColumn("_p", chosen).select(
        *df.columns, *[F.col("_p")[source].alias(name) for name, source in values.items()]
    )
