"""Size classes, chunk shapes, grids and pyramid levels as column expressions.

Everything here works on the array inventory only; no payload is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.functions.arrays import ceil_div, cells, explode_axes, product

MIB = 1048576


def item_size(dtype: Column) -> Column:
    """Bytes per value; an unknown type counts as four."""
    out = F.lit(contract.DEFAULT_ITEM_SIZE)
    for name, size in contract.ITEM_SIZES.items():
        out = F.when(dtype == name, F.lit(size)).otherwise(out)
    return out


def size_mb(shape: Column, itemsize: Column) -> Column:
    """Size in MB; 100 where the shape is unknown."""
    return F.coalesce(product(shape) * itemsize / F.lit(float(MIB)), F.lit(100.0))


def size_class(mb: Column, small: float = 50, medium: float = 200) -> Column:
    return F.when(mb < small, "SMALL").when(mb < medium, "MEDIUM").otherwise("LARGE")


def route(mb: Column, max_mb: float, mode: str = "stream", chunk_mb: int = 32, stream_mb: int = 64) -> list[Column]:
    """(strategy, chunk_mb) of each array by its size.

    Above ``max_mb`` the mode decides: ``stream``, ``downsample``, else skip.
    """
    above = {"stream": ("stream", stream_mb), "downsample": ("downsample", chunk_mb)}.get(mode, ("skipped", None))
    over, large, medium = mb > max_mb, mb >= 200, mb >= 50
    strategy = F.when(over, above[0]).when(large, "stream").when(medium, "chunked").otherwise("direct")
    chunk = (
        F.when(over, F.lit(above[1]).cast("int"))
        .when(large, stream_mb)
        .when(medium, min(8, chunk_mb))
        .otherwise(chunk_mb)
    )
    return [strategy.alias("strategy"), chunk.alias("chunk_mb")]


def split_label(mb: Column, max_mb: float, mode: str) -> Column:
    """``normal``, or for arrays over the limit ``skipped`` / ``special``."""
    return F.when(mb <= max_mb, "normal").otherwise("skipped" if mode == "skip" else "special")


@dataclass(frozen=True)
class Step:
    """An axis longer than ``above`` is cut in ``parts``, no piece below ``least``."""

    above: int
    least: int
    parts: int


@dataclass(frozen=True)
class MemoryPlan:
    """Fixed values of one chunk planner for arrays computed in memory.

    ``bands`` are (lower size in MB, inclusive, steps), largest first.
    """

    whole_mb: float
    small_mb: float
    small_inclusive: bool
    small_chunk: int
    bands: tuple[tuple[float, bool, tuple[Step, ...]], ...]
    max_chunks: int
    fallback: Step


# ---- fixed values: two published generations of the planner -----------------
BALANCED = MemoryPlan(
    whole_mb=4, small_mb=50, small_inclusive=False, small_chunk=64,
    bands=(
        (200, True, (Step(1024, 128, 4), Step(256, 64, 4))),
        (50, True, (Step(512, 64, 6), Step(128, 32, 4))),
    ),
    max_chunks=2000, fallback=Step(0, 32, 6),
)
# -----------------------------------------------------------------------------


def _cut(dim: Column, chunk: Column, steps: tuple[Step, ...]) -> Column:
    out = dim
    for s in reversed(steps):
        out = F.when(dim > s.above, F.greatest(F.lit(s.least), F.floor(dim / s.parts))).otherwise(out)
    return F.least(chunk, out).cast("bigint")


def memory_chunks(shape: Column, chunks: Column, mb: Column, plan: MemoryPlan = BALANCED) -> Column:
    """Chunk shape for an array computed in memory.

    Tiny arrays stay whole, small ones get a fixed edge, and longer axes of
    larger arrays are cut by the band of the array's size.  A plan with too
    many chunks falls back to one coarse rule.
    """

    def by_band(dim: Column, chunk: Column) -> Column:
        out = F.least(chunk, dim).cast("bigint")
        for low, inclusive, steps in reversed(plan.bands):
            inside = mb >= low if inclusive else mb > low
            out = F.when(inside, _cut(dim, chunk, steps)).otherwise(out)
        return out

    cut = F.zip_with(shape, chunks, by_band)
    coarse = F.zip_with(shape, chunks, lambda d, c: _cut(d, c, (plan.fallback,)))
    unchanged = cut == chunks
    planned = F.when(~unchanged & (cells(shape, cut) > plan.max_chunks), coarse).otherwise(cut)
    small = mb <= plan.small_mb if plan.small_inclusive else mb < plan.small_mb
    return (
        F.when(mb <= plan.whole_mb, shape)
        .when(small, F.transform(chunks, lambda c: F.least(c, F.lit(plan.small_chunk)).cast("bigint")))
        .otherwise(planned)
    )


def stream_chunks(shape: Column, itemsize: Column, chunk_mb: int = 8, cpus: int = 8) -> Column:
    """Chunk shape for an array streamed to storage.

    A chunk holds up to 8 MB; an axis that would give fewer than four pieces
    per core is cut finer.  Never longer than the axis itself.
    """
    elements = F.floor(F.lit(min(chunk_mb, 8) * MIB) / itemsize)
    # The tiny addend keeps exact roots (128 from 2097152) from falling short.
    base = F.greatest(F.lit(32), F.floor(F.pow(elements, F.lit(1.0) / F.size(shape)) + 1e-9)).cast("bigint")
    pieces = cpus * 4

    def axis(dim: Column) -> Column:
        fine = F.greatest(F.lit(16), F.floor(dim / pieces))
        return F.least(dim, F.when(F.floor(dim / base) < pieces, fine).otherwise(F.least(dim, base))).cast("bigint")

    return F.transform(shape, axis)


def axis_offsets(dim: Column, chunk: Column) -> Column:
    """(start, size) of the chunks along one axis; the last may be short."""
    return F.transform(
        F.sequence(F.lit(0).cast("bigint"), dim.cast("bigint") - 1, chunk.cast("bigint")),
        lambda start: F.struct(start.alias("start"), F.least(chunk, dim - start).cast("bigint").alias("size")),
    )


def chunk_grid(arrays: DataFrame, chunks: str = "chunks") -> DataFrame:
    """One row per chunk of arrays of any number of axes: ``idx``, ``origin``, ``size``.

    Axes are expanded one by one and spread over tasks after the first, so the grid of one huge array
    is not produced by a single task.
    """
    keep = list(arrays.columns)
    counts = F.zip_with("shape", chunks, lambda d, c: ceil_div(d, c) - 1)
    bounds = arrays.select(*keep, F.transform("shape", lambda d: F.lit(0).cast("bigint")).alias("_first"), counts.cast("array<bigint>").alias("_last"))
    out = explode_axes(bounds, "_first", "_last", "idx")
    origin = F.zip_with("idx", chunks, lambda i, c: i * c)
    left = F.zip_with("shape", origin, lambda d, o: d - o)
    size = F.zip_with(left, chunks, lambda n, c: F.least(n, c))
    return out.select(*keep, "idx", origin.alias("origin"), size.alias("size"))


def pyramid_levels(shape: Column, itemsize: Column, chunk_mb: int, factor: int = 4) -> Column:
    """Levels needed until a strided copy is at most four chunks in size.

    Level ``n`` has shape ``ceil(dim / factor^n)``; the shape is the real one, not an estimate by exact
    division.  The largest axis bounds the count: once it is one voxel long, so are all others.
    """
    target = chunk_mb * 4
    power = F.lit(float(factor))

    def mb_at(level: Column) -> Column:
        reduced = F.transform(shape, lambda d: F.ceil(d / F.pow(power, level)).cast("bigint"))
        return size_mb(reduced, itemsize)

    longest = F.greatest(F.lit(1).cast("bigint"), F.array_max(shape))
    last = (F.ceil(F.log(float(factor), longest.cast("double"))) + 1).cast("int")
    fit = F.filter(F.sequence(F.lit(0), last), lambda n: mb_at(n) <= target)
    return F.coalesce(F.array_min(fit), last)


def level_shape(shape: Column, level: Column, factor: int = 4) -> Column:
    return F.transform(shape, lambda d: F.ceil(d / F.pow(F.lit(float(factor)), level)).cast("bigint"))


def level_voxel_size(voxel: Column, level: Column, factor: int = 4) -> Column:
    scale = F.pow(F.lit(float(factor)), level)
    return F.transform(voxel, lambda x: x * scale)


def pyramid_record(levels: DataFrame) -> DataFrame:
    """Per array, the ``level_n`` map a pyramid record stores.

    A map holds at most one entry per level, so its size is fixed.
    """
    entry = F.struct(
        F.concat(F.lit("level_"), F.col("level").cast("string")).alias("k"),
        F.struct("shape", "voxel_size_nm", "downsample_factor", "global_mean").alias("v"),
    )
    return levels.groupBy("dataset_id", "array_name").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("pyramid_levels"),
        F.max("level").alias("final_level"),
        F.max("downsample_factor").alias("total_reduction_factor"),
    )
