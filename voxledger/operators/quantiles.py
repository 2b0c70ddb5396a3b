"""Quantiles of the voxels of a volume, by summaries that merge.

The summary of a block is at most ``size`` voxel values with weights, in order: its distinct values, or, where
there are more, values at even steps of rank, each with the weight of its step. Summaries of neighbouring
blocks are merged in a tree over block positions, which does not depend on how rows lie. Taking even steps
moves a rank by at most half a step, so the error of the whole is at most ``levels / (2 size)`` of all voxels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxledger.functions.arrays import floor_div, linear_index, product
from voxledger.operators import blocks as B

SIZE = 1_024  # values of a summary
FAN_IN = 64

SUMMARY = f"{B.KEY_DDL}, pos bigint, error double, values array<double>, weights array<bigint>"


def summarize(values: np.ndarray, weights: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray, float]:
    """At most ``size`` values in order, their weights, and by how much of the weight a rank may have moved."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    values, weights = values[first], np.add.reduceat(weights, first) if len(first) else weights
    if len(values) <= size:
        return values, weights, 0.0
    reach = np.cumsum(weights)
    total = int(reach[-1])
    # Step i covers the ranks from cut i on to the next; the value in its middle stands for them.
    cut = np.arange(size + 1) * total // size
    middle = (cut[:-1] + cut[1:] + 1) // 2
    taken = values[np.searchsorted(reach, np.maximum(middle, 1))]
    # The least and the greatest value stay what they are.
    taken[0], taken[-1] = values[0], values[-1]
    return taken, np.diff(cut), 0.5 / size + 1.0 / total


def block_summaries(blocks: DataFrame, size: int = SIZE) -> DataFrame:
    """A summary per block, at its position in the array; voxels that are NaN are left out."""
    arrays = B.inventory(blocks).select(*B.KEY, B.grid_of(F.col("shape"), F.col("chunks")).alias("grid"))
    placed = blocks.join(arrays, B.KEY).select(*B.KEY, linear_index(F.col("idx"), F.col("grid")).alias("pos"), "shape", "dtype", "payload")

    def run(row: dict):
        a = B._array(row).ravel().astype("float64")
        values, weights, error = summarize(a[~np.isnan(a)], np.ones(int((~np.isnan(a)).sum()), np.int64), size)
        yield {**{k: row[k] for k in (*B.KEY, "pos")}, "error": error, "values": values.tolist(), "weights": weights.tolist()}

    return B._map(placed, run, SUMMARY)


def merge_summaries(summaries: DataFrame, rounds: int, size: int = SIZE, fan_in: int = FAN_IN) -> DataFrame:
    """One summary per array: ``rounds`` times up to ``fan_in`` neighbours become one."""
    keys = [*B.KEY, "pos"]
    schema = B._arrow_schema(SUMMARY)

    def join(table: pa.Table) -> pa.Table:
        # A group is fan_in summaries; they are sorted so that their order does not matter.
        rows = table.sort_by([("place", "ascending")])
        values, weights, error = summarize(*(rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("values", "weights")), size)
        head = {k: [rows.column(k)[0].as_py()] for k in keys}
        worst = max(rows.column("error").to_pylist()) + error
        return pa.table(
            {**head, "error": [worst], "values": pa.array([values.tolist()], pa.list_(pa.float64())), "weights": pa.array([weights.tolist()], pa.list_(pa.int64()))},
            schema=schema,
        )

    out = summaries
    for _ in range(rounds):
        up = out.withColumns({"place": F.col("pos"), "pos": floor_div(F.col("pos"), F.lit(fan_in))})
        out = up.groupBy(*keys).applyInArrow(join, SUMMARY)
    return out


def volume_quantiles(blocks: DataFrame, shares: list[float], size: int = SIZE, fan_in: int = FAN_IN) -> DataFrame:
    """Per array and share ``q``: the least value that at least ``q`` of the voxels do not exceed, and ``rank_error``.

    ``rank_error`` bounds how far the value's rank may be from ``q``, as a share of the voxels; it is 0 where an
    array has at most ``size`` different values. Arrays without voxels (or with only NaN) have NULL values.
    """
    most = B.inventory(blocks).agg(F.max(product(B.grid_of(F.col("shape"), F.col("chunks"))))).first()[0] or 1
    rounds, reach = 1, fan_in
    while reach < most:
        rounds, reach = rounds + 1, reach * fan_in
    merged = merge_summaries(block_summaries(blocks, size), rounds, size, fan_in)
    ddl = f"{B.KEY_DDL}, q double, value double, rank_error double"

    def read(row: dict):
        reach_ = np.cumsum(row["weights"])
        for q in shares:
            value = None
            if len(reach_):
                rank = max(1, int(np.ceil(q * int(reach_[-1]) - 1e-9)))
                value = row["values"][int(np.searchsorted(reach_, rank))]
            yield {**{k: row[k] for k in B.KEY}, "q": q, "value": value, "rank_error": row["error"]}

    return B._map(merged.select(*B.KEY, "error", "values", "weights"), read, ddl)
