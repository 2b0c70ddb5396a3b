"""The block table: dense arrays stored as one row per block.

Payloads are C-order bytes, little-endian.  Every row carries the edges of its
grid (``chunk``), and ``idx = origin div chunk`` holds in every block table, so
a lookup by index is right after any stride or rechunk.  Operators that read
payloads run as ``mapInArrow`` over small batches; blocks meet only by block
index, never by box overlap, and strides are taken before anything is shuffled.
An array without voxels is one empty block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from itertools import product as cross

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxledger.functions.arrays import MOST_AXES, explode_axes, floor_div, linear_index, product
from voxledger.session import shared_checkpoint

KEY = ["dataset_id", "array_name", "level"]
KEY_DDL = "dataset_id string, array_name string, level int"
BLOCKS = (
    f"{KEY_DDL}, chunk array<bigint>, idx array<bigint>, origin array<bigint>, shape array<bigint>, dtype string, payload binary"
)
SEGMENT_BYTES = 16 << 20  # byte ranges that are joined into one value
CROP_EDGE = 128  # voxels per axis of a crop's pieces
LIST_BOXES = 1_000  # boxes that meet a block's payload together, about
SLICE_BYTES = 1 << 18  # Arrow bytes that are Python objects at a time, about


def _dtype(name: str) -> np.dtype:
    return np.dtype(name).newbyteorder("<")


def _array(row: dict) -> np.ndarray:
    return np.frombuffer(row["payload"], _dtype(row["dtype"])).reshape(row["shape"])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dicts.  Batches are bounded in rows and bytes by the session settings.

    Small numbers and lists take many times their Arrow bytes as Python objects, so a batch becomes objects
    in slices of about ``SLICE_BYTES`` (one row at least).
    """
    for batch in batches:
        names = batch.schema.names
        step = max(1, batch.num_rows * SLICE_BYTES // max(batch.nbytes, 1))
        for start in range(0, batch.num_rows, step):
            for values in zip(*(column.to_pylist() for column in batch.slice(start, step).columns)):
                yield dict(zip(names, values))


def _emit(rows: Iterator[dict], schema: pa.Schema, limit_bytes: int = 1 << 23, limit_rows: int = 8192):
    """Group output rows into record batches bounded by rows and payload bytes."""
    held = {name: [] for name in schema.names}
    count = size = 0
    for row in rows:
        for name, column in held.items():
            column.append(row[name])
        size += len(row.get("payload") or b"")
        count += 1
        if size >= limit_bytes or count >= limit_rows:
            yield pa.RecordBatch.from_pydict(held, schema)
            held = {name: [] for name in schema.names}
            count = size = 0
    if count:
        yield pa.RecordBatch.from_pydict(held, schema)


def _map(df: DataFrame, fn: Callable[[dict], Iterable[dict]], ddl: str) -> DataFrame:
    """Apply a row-to-rows function over Arrow batches."""
    schema = _arrow_schema(ddl)
    return df.mapInArrow(lambda batches: _emit((out for row in _rows(batches) for out in fn(row)), schema), ddl)


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


# ---- building blocks -----------------------------------------------------------
def byte_blocks(df: DataFrame, dataset_id: Column, payload: Column, block_bytes: int, array_name: str = "raw") -> DataFrame:
    """Cut each binary value into uint8 blocks of one axis, without leaving the JVM.

    An empty or NULL value is one empty block.
    """
    size = F.octet_length("payload").cast("bigint")
    whole = df.select(dataset_id.cast("string").alias("dataset_id"), F.coalesce(payload, F.lit(b"")).alias("payload"))
    starts = F.sequence(F.lit(0).cast("bigint"), floor_div(F.greatest(size - 1, F.lit(0)), F.lit(block_bytes)))
    rows = whole.select("dataset_id", "payload", size.alias("total"), F.explode(starts).alias("i"))
    start = F.col("i") * block_bytes
    return rows.select(
        "dataset_id",
        F.lit(array_name).alias("array_name"),
        F.lit(0).alias("level"),
        F.array(F.lit(block_bytes).cast("bigint")).alias("chunk"),
        F.array("i").alias("idx"),
        F.array(start).alias("origin"),
        F.array(F.least(F.lit(block_bytes).cast("bigint"), F.col("total") - start)).alias("shape"),
        F.lit("uint8").alias("dtype"),
        F.substring("payload", (start + 1).cast("int"), F.lit(block_bytes)).alias("payload"),
    )


def decode_raw(df: DataFrame) -> DataFrame:
    """Typed volumes from raw bytes: rows with ``shape``, ``dtype`` and ``payload``.

    ``error`` names a size that does not match the shape; such rows keep no
    payload.
    """
    from voxledger.plans.chunking import item_size

    expected = product(F.col("shape")) * item_size(F.col("dtype"))
    actual = F.octet_length("payload").cast("bigint")
    wrong = expected != actual
    text = F.format_string("3D block has size %d (expected %d)", actual, expected)
    return df.withColumns({"error": F.when(wrong, text), "payload": F.when(~wrong, F.col("payload"))})


def raw_blocks(decoded: DataFrame, chunk: list[int]) -> DataFrame:
    """Block table from decoded raw volumes (key columns, ``shape``, ``dtype``, ``payload``).

    Each value is cut where it lies; rows with an ``error`` give no block.
    """
    whole = decoded.where("error IS NULL").select(*KEY, "shape", "dtype", "payload")

    def cut(row: dict):
        at = [0] * len(row["shape"])
        yield from _pieces({**row, "origin": at, "idx": at, "chunk": chunk})

    return _map(whole, cut, BLOCKS)


@F.pandas_udf(T.BinaryType())
def pack_values(values: pd.Series, dtype: pd.Series) -> pd.Series:
    """Bytes of a value list."""
    return pd.Series([np.asarray(v).astype(_dtype(t)).tobytes() for v, t in zip(values, dtype)], dtype=object)


@F.pandas_udf(T.BinaryType())
def _pack_sparse(offsets: pd.Series, values: pd.Series, shape: pd.Series, dtype: pd.Series) -> pd.Series:
    out = []
    for o, v, s, t in zip(offsets, values, shape, dtype):
        block = np.zeros(int(np.prod(s)), _dtype(t))
        block[np.asarray(o, "int64")] = v
        out.append(block.tobytes())
    return pd.Series(out, dtype=object)


def blocks_from_voxels(voxels: DataFrame, shape: list[Column], chunk: list[int], dtype: str) -> DataFrame:
    """Block table from (dataset_id, array_name, level, coords, value) voxel rows.

    A group holds the voxels of one block, so its size is the chunk size.
    Voxels that are absent read as zero.
    """
    n = len(chunk)
    c = [F.col("coords")[i] for i in range(n)]
    idx = [floor_div(c[i], F.lit(chunk[i])) for i in range(n)]
    origin = [idx[i] * chunk[i] for i in range(n)]
    size = [F.least(F.lit(chunk[i]).cast("bigint"), shape[i] - origin[i]) for i in range(n)]
    offset = F.lit(0).cast("bigint")
    for i in range(n):
        offset = offset * size[i] + (c[i] - origin[i])
    edges = F.array(*[F.lit(n).cast("bigint") for n in chunk])
    rows = voxels.select(
        *KEY, F.array(*idx).alias("idx"), F.array(*origin).alias("origin"), F.array(*size).alias("shape"),
        offset.cast("int").alias("offset"), "value",
    )
    grouped = rows.groupBy(*KEY, "idx", "origin", "shape").agg(
        F.collect_list(F.struct("offset", "value")).alias("v")
    )
    return grouped.select(
        *KEY, edges.alias("chunk"), "idx", "origin", "shape", F.lit(dtype).alias("dtype"),
        _pack_sparse(F.col("v.offset"), F.col("v.value"), "shape", F.lit(dtype)).alias("payload"),
    )


def inventory(blocks: DataFrame) -> DataFrame:
    """Array inventory of a block table: shape, chunk edges, type, blocks, bytes; any number of axes.

    Payloads are only measured; what is aggregated is one small row per block and axis.
    """
    axis = F.posexplode(F.zip_with("origin", "shape", lambda o, s: o + s)).alias("axis", "end")
    rows = blocks.select(*KEY, "chunk", "dtype", F.octet_length("payload").alias("bytes"), axis)
    first = F.col("axis") == 0
    per_axis = rows.groupBy(*KEY, "axis").agg(
        F.max("end").alias("end"),
        F.max("chunk").alias("chunk"),
        F.max("dtype").alias("dtype"),
        F.count_if(first).alias("blocks"),
        F.sum(F.when(first, F.col("bytes")).otherwise(0)).alias("nbytes"),
    )
    return per_axis.groupBy(*KEY).agg(
        F.array_sort(F.collect_list(F.struct("axis", "end"))).alias("ends"),
        F.max("chunk").alias("chunks"),
        F.max("dtype").alias("dtype"),
        F.sum("blocks").alias("blocks"),
        F.sum("nbytes").alias("nbytes"),
    ).select(*KEY, F.col("ends.end").alias("shape"), "chunks", "dtype", "blocks", "nbytes")


def grid_of(shape: Column, chunks: Column) -> Column:
    """Blocks per axis; an axis without voxels has one, empty block."""
    return F.zip_with(shape, chunks, lambda d, c: F.greatest(F.lit(1).cast("bigint"), floor_div(d + c - 1, c)))


def inventory_or_derive(blocks: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Use a stored inventory when there is one, else derive it; none at all is an error."""
    found = stored if stored is not None else inventory(blocks)
    if found.isEmpty():
        raise ValueError("no arrays found")
    return found


# ---- statistics ------------------------------------------------------------------
def _stats(row: dict):
    a = _array(row)
    yield {
        **{k: row[k] for k in KEY},
        "n": a.size,
        "total": float(a.sum(dtype="float64" if a.dtype.kind == "f" else "int64")),
        "low": float(a.min()) if a.size else None,
        "high": float(a.max()) if a.size else None,
        "nbytes": len(row["payload"]),
    }


def volume_stats(blocks: DataFrame) -> DataFrame:
    """Count, mean, range and bytes per array from block partials in one pass."""
    part = _map(
        blocks.select(*KEY, "shape", "dtype", "payload"),
        _stats,
        "dataset_id string, array_name string, level int, n bigint, total double, low double, high double, nbytes bigint",
    )
    return part.groupBy(*KEY).agg(
        F.sum("n").alias("voxels"),
        (F.sum("total") / F.sum("n")).alias("mean"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("nbytes").alias("nbytes"),
    )


def histogram(blocks: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """Voxels per equal-width bin; the last bin is closed on the right.

    Voxels below ``low`` are in bin -1, those above ``high`` in bin ``bins``, NaN in bin NULL: every
    voxel is counted.
    """

    def count(row: dict):
        a = _array(row)
        found, _ = np.histogram(a[(a >= low) & (a <= high)], bins, (low, high))
        missing = int(np.isnan(a).sum()) if a.dtype.kind in "fc" else 0
        sides = [(-1, (a < low).sum()), *enumerate(found), (bins, (a > high).sum()), (None, missing)]
        for b, n in sides:
            if n:
                yield {**{k: row[k] for k in KEY}, "bin": b, "n": int(n)}

    part = _map(
        blocks.select(*KEY, "shape", "dtype", "payload"), count,
        "dataset_id string, array_name string, level int, bin int, n bigint",
    )
    return part.groupBy(*KEY, "bin").agg(F.sum("n").alias("n"))


def voxels(blocks: DataFrame) -> DataFrame:
    """Voxel rows (coords, value) of a block table, vectorised per block."""
    ddl = "dataset_id string, array_name string, level int, coords array<bigint>, value double"
    schema = _arrow_schema(ddl)

    def run(batches):
        for row in _rows(batches):
            a = _array(row)
            grid = np.indices(a.shape).reshape(a.ndim, -1).T + np.asarray(row["origin"])
            lists = pa.ListArray.from_arrays(np.arange(0, grid.size + 1, a.ndim, "int32"), pa.array(grid.ravel()))
            keys = [pa.array([row[k]] * a.size, schema.field(k).type) for k in KEY]
            coords = lists.cast(schema.field("coords").type)
            yield pa.RecordBatch.from_arrays([*keys, coords, pa.array(a.ravel().astype("float64"))], schema=schema)

    return blocks.mapInArrow(run, ddl)


# ---- stride, pyramid, rechunk --------------------------------------------------------
def _strided(row: dict, f: int):
    """The kept voxels of a block, cut along the grid of the smaller array."""
    skip = [(-o) % f for o in row["origin"]]
    a = _array(row)
    kept = a[tuple(slice(s, None, f) for s in skip)]
    if kept.size or not a.size:
        small = {
            **row,
            "origin": [(o + s) // f for o, s in zip(row["origin"], skip)],
            "shape": list(kept.shape),
            "payload": kept.tobytes(),
        }
        yield from _pieces(small)


def stride(blocks: DataFrame, factor: int) -> DataFrame:
    """Every ``factor``-th voxel per axis, on the same chunk edges.

    Voxels are dropped where they lie; only what is left meets in the blocks of the new grid.
    """
    return _gather(_map(blocks, lambda row: _strided(row, factor), BLOCKS))


def pyramid(blocks: DataFrame, levels: Column | int, factor: int = 4, keep_all: bool = True) -> DataFrame:
    """Levels 1..n of each array in one pass, since strides compose; chunk edges stay.

    ``levels`` is the level count per row (a column, or one number for all).
    """
    count = levels if isinstance(levels, Column) else F.lit(levels)

    def run(row: dict):
        last = row.pop("_levels")
        for level in range(1 if keep_all else last, last + 1):
            for out in _strided(row, factor**level):
                yield {**out, "level": row["level"] + level}

    counted = blocks.select(*[F.col(c) for c in _names(BLOCKS)], count.cast("int").alias("_levels"))
    return _gather(_map(counted.where("_levels > 0"), run, BLOCKS))


def _names(ddl: str) -> list[str]:
    return T.StructType.fromDDL(ddl).names


def _pieces(row: dict):
    """Cut a block along the grid of its ``chunk``."""
    a, origin = _array(row), row["origin"]
    spans = []
    for o, n, c in zip(origin, a.shape, row["chunk"]):
        spans.append([(i, max(o, i * c), min(o + n, (i + 1) * c)) for i in range(o // c, max(o + n - 1, o) // c + 1)])
    for cell in cross(*spans):
        part = a[tuple(slice(lo - o, hi - o) for (_, lo, hi), o in zip(cell, origin))]
        yield {
            **row,
            "idx": [i for i, _, _ in cell],
            "origin": [lo for _, lo, _ in cell],
            "shape": list(part.shape),
            "payload": part.tobytes(),
        }


def _gather(pieces: DataFrame) -> DataFrame:
    """Whole blocks from pieces of a block table."""
    joined = _assemble(pieces, [*KEY, "chunk", "idx"], f"{KEY_DDL}, chunk array<bigint>, idx array<bigint>")
    return joined.select(*_names(BLOCKS))


def _assemble(pieces: DataFrame, keys: list[str], key_ddl: str) -> DataFrame:
    """Put the non-overlapping pieces of each key together into their bounding box.

    Pieces arrive sorted by key, so a task holds one result at a time and the
    sort may spill; no group is gathered into a single row.
    """

    def run(batches):
        for _, group in groupby(_rows(batches), lambda row: [row[k] for k in keys]):
            parts = list(group)
            starts = np.array([p["origin"] for p in parts])
            shapes = np.array([p["shape"] for p in parts])
            low = starts.min(axis=0)
            box = np.empty((starts + shapes).max(axis=0) - low, _dtype(parts[0]["dtype"]))
            if sum(len(p["payload"]) for p in parts) < box.nbytes:
                box[...] = 0
            for part, at, size in zip(parts, starts - low, shapes):
                box[tuple(slice(a, a + n) for a, n in zip(at, size))] = _array(part)
            yield {
                **{k: parts[0][k] for k in keys}, "origin": low.tolist(), "shape": list(box.shape),
                "dtype": parts[0]["dtype"], "payload": box.tobytes(),
            }

    ddl = f"{key_ddl}, origin array<bigint>, shape array<bigint>, dtype string, payload binary"
    schema = _arrow_schema(ddl)
    near = pieces.select(*keys, "origin", "shape", "dtype", "payload").repartition(*keys).sortWithinPartitions(*keys)
    return near.mapInArrow(lambda batches: _emit(run(batches), schema), ddl)


def rechunk(blocks: DataFrame, chunk: list[int] | Column) -> DataFrame:
    """The same voxels on another grid, one for all arrays or one per row.

    Source blocks are cut where they lie; the pieces of one target block meet
    by its index, so what meets is never larger than a block.
    """
    target = chunk if isinstance(chunk, Column) else F.lit(chunk)
    cut = blocks.select(
        *[F.col(c) if c != "chunk" else target.cast("array<bigint>").alias(c) for c in _names(BLOCKS)]
    )
    return _gather(_map(cut, _pieces, BLOCKS))


# ---- crops ---------------------------------------------------------------------------
def clipped_boxes(requests: DataFrame, grid: DataFrame) -> DataFrame:
    """Requested boxes, clipped to their array: ``lo``, ``hi`` and the block indices ``_first`` to ``_last``.

    ``grid`` has the key columns, edges ``_c`` and extent ``_dims``. Boxes outside of the array go.
    """
    asked = requests.join(grid, KEY)
    stop = F.zip_with("start", "size", lambda a, n: a + n)
    low = F.transform("start", lambda a: F.greatest(a, F.lit(0).cast("bigint")))
    high = F.zip_with(stop, "_dims", lambda e, d: F.least(e, d))
    some = F.forall(F.zip_with("lo", "hi", lambda a, b: a < b), lambda ok: ok)
    return asked.withColumns({"lo": low, "hi": high}).where(some).withColumns(
        {
            "_first": F.zip_with("lo", "_c", floor_div),
            "_last": F.zip_with("hi", "_c", lambda b, c: floor_div(b - 1, c)),
        }
    )


def crop_pieces(
    requests: DataFrame, blocks: DataFrame, arrays: DataFrame, list_boxes: int = LIST_BOXES, axes: int = MOST_AXES
) -> DataFrame:
    """The parts of blocks that each requested box covers, with the box's clipped start as ``lo``.

    ``requests``: request_id, key columns, ``start``, ``size``.  The box is turned axis by axis into
    rows of the block indices it touches (``axes``: the most axes an array has), so the join is an equality
    on array and block index and no value holds a whole box.  Boxes are clipped to the array.  The boxes
    of a block are counted and gathered in lists of about ``list_boxes``; each list meets the payload once,
    so a block that few boxes want is joined once, and one that very many want is cut by many tasks.
    """
    grid = arrays.select(*KEY, F.col("chunks").alias("_c"), F.col("shape").alias("_dims"))
    boxes = clipped_boxes(requests.select("request_id", *KEY, "start", "size"), grid)
    boxes = boxes.select("request_id", *KEY, "lo", "hi", "_first", "_last")
    wanted = explode_axes(boxes, "_first", "_last", "idx", axes).select("request_id", *KEY, "lo", "hi", "idx")
    counts = wanted.groupBy(*KEY, "idx").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > list_boxes)
    many = F.floor(F.coalesce("_n", F.lit(0)) / list_boxes).cast("bigint") + 1
    group = F.pmod(F.xxhash64("request_id", F.lit(1)), many).alias("_group")
    dealt = wanted.join(counts, [*KEY, "idx"], "left").select(*wanted.columns, group)
    lists = dealt.groupBy(*KEY, "idx", "_group").agg(F.collect_list(F.struct("request_id", "lo", "hi")).alias("boxes"))
    met = lists.drop("_group").join(blocks.drop("chunk"), [*KEY, "idx"])

    def trim(row: dict):
        whole = _array(row)
        for box in row["boxes"]:
            lo = [max(o, a) for o, a in zip(row["origin"], box["lo"])]
            hi = [min(o + n, b) for o, n, b in zip(row["origin"], row["shape"], box["hi"])]
            part = whole[tuple(slice(a - o, b - o) for a, b, o in zip(lo, hi, row["origin"]))]
            yield {
                **{k: row[k] for k in (*KEY, "idx", "dtype")}, "request_id": box["request_id"], "lo": box["lo"],
                "origin": lo, "shape": list(part.shape), "payload": part.tobytes(),
            }

    return _map(met, trim, CROP_PIECES)


CROP_PIECES = (
    f"request_id bigint, {KEY_DDL}, lo array<bigint>, idx array<bigint>, origin array<bigint>, shape array<bigint>, "
    "dtype string, payload binary"
)


def assemble_crops(pieces: DataFrame, edge: int = CROP_EDGE) -> DataFrame:
    """Each crop as blocks of a grid of its own, ``edge`` voxels per axis from the crop's start.

    A crop within one edge is one row; a larger one has a row per ``part`` of its grid, of the same
    columns.  ``origin`` is the place in the array.
    """

    def cut(row: dict):
        local = {**row, "chunk": [edge] * len(row["lo"]), "origin": [o - a for o, a in zip(row["origin"], row["lo"])]}
        for piece in _pieces(local):
            yield {**piece, "part": piece["idx"], "origin": [o + a for o, a in zip(piece["origin"], row["lo"])]}

    keys = f"request_id bigint, {KEY_DDL}, part array<bigint>"
    cut_ddl = f"{keys}, origin array<bigint>, shape array<bigint>, dtype string, payload binary"
    return _assemble(_map(pieces, cut, cut_ddl), ["request_id", *KEY, "part"], keys)


def block_lookup(points: DataFrame, blocks: DataFrame, arrays: DataFrame, size: int = 128) -> DataFrame:
    """Boxes of edge ``size`` at (z, y, x), clipped at the array's end."""
    requests = points.select(
        "request_id", *KEY,
        F.array(*[F.col(c).cast("bigint") for c in ("z", "y", "x")]).alias("start"),
        F.array(*[F.lit(size).cast("bigint")] * 3).alias("size"),
    )
    return crop_pieces(requests, blocks, arrays, axes=3)


def crop_fits(start: Column, stop: Column, size: Column) -> Column:
    """A box of ``size`` fits the inclusive bounds on every axis."""
    extent = F.zip_with(stop, start, lambda b, a: b - a + 1)
    return F.forall(F.zip_with(extent, size, lambda e, n: e >= n), lambda ok: ok)


def random_origin(request_id: Column, start: Column, stop: Column, size: Column, seed: int = 0) -> Column:
    """A uniform crop origin that depends only on request, axis and seed."""
    room = F.zip_with(F.zip_with(stop, start, lambda b, a: b - a + 1), size, lambda e, n: e - n + 1)

    def draw(a: Column, i: Column) -> Column:
        word = F.substring(F.md5(F.concat_ws(":", request_id.cast("string"), i.cast("string"), F.lit(str(seed)))), 1, 15)
        return a + F.pmod(F.conv(word, 16, 10).cast("bigint"), room[i])

    return F.when(crop_fits(start, stop, size), F.transform(start, draw))


def resolve_bounds(info: Column) -> list[Column]:
    """(start, stop) from a saved info document, by the first form it has.

    Points are used in the order given; only ``Size`` is turned from X,Y,Z.
    """
    nums = lambda path: F.try_variant_get(info, path, "array<bigint>")
    both = lambda a, b: nums(a).isNotNull() & nums(b).isNotNull()
    size = nums("$.Size")
    corner = F.transform(F.reverse(F.slice(size, 1, 3)), lambda n: n - 1)
    zero = F.array(*[F.lit(0).cast("bigint")] * 3)
    forms = [
        (nums("$.bounds[0]").isNotNull(), nums("$.bounds[0]"), nums("$.bounds[1]")),
        (both("$.Extended.MinZyx", "$.Extended.MaxZyx"), nums("$.Extended.MinZyx"), nums("$.Extended.MaxZyx")),
        (both("$.Extents.MinPoint", "$.Extents.MaxPoint"), nums("$.Extents.MinPoint"), nums("$.Extents.MaxPoint")),
        (size.isNotNull(), zero, corner),
    ]
    start = stop = F.lit(None).cast("array<bigint>")
    for given, a, b in reversed(forms):
        start, stop = F.when(given, a).otherwise(start), F.when(given, b).otherwise(stop)
    return [start.alias("start"), stop.alias("stop")]


# ---- digests -------------------------------------------------------------------------
def block_digests(blocks: DataFrame) -> DataFrame:
    return blocks.select(*KEY, "idx", "origin", F.sha2("payload", 256).alias("sha256"))


def value_sha256(values: DataFrame, key: str, payload: Column) -> DataFrame:
    """Size and SHA-256 of volumes that are one value each.

    A plain SHA-256 reads its bytes in order and can't be split; a volume that is a block table has a
    ``tree_digest`` instead, whatever its size.
    """
    whole = values.select(key, F.coalesce(payload, F.lit(b"")).alias("_whole"))
    return whole.select(key, F.octet_length("_whole").cast("bigint").alias("nbytes"), F.sha2("_whole", 256).alias("sha256"))


def tree_digest(blocks: DataFrame, fan_in: int = 1024) -> DataFrame:
    """A hash tree over block hashes in block order, for arrays of any size.

    Each round joins up to ``fan_in`` neighbouring hashes, so no group grows
    with the array.  An array takes rounds until one hash is left (at least
    one), so its digest does not depend on the other arrays.
    """
    axes = blocks.select(*KEY, F.posexplode("idx").alias("axis", "i"))
    sides = axes.groupBy(*KEY, "axis").agg((F.max("i") + 1).alias("n")).groupBy(*KEY)
    grid = sides.agg(F.array_sort(F.collect_list(F.struct("axis", "n"))).alias("g")).select(*KEY, F.col("g.n").alias("grid"))
    # One small row per array, kept while the number of rounds is read from it.
    arrays = shared_checkpoint(grid.withColumn("left", product(F.col("grid"))))
    most = arrays.agg(F.max("left")).first()[0] or 1
    hashes = block_digests(blocks).join(arrays, KEY)
    level = hashes.select(*KEY, "left", linear_index(F.col("idx"), F.col("grid")).alias("pos"), "sha256")
    step, reach = 0, 1
    while step == 0 or reach < most:
        joined = F.sha2(F.array_join("h.sha256", ""), 256)
        finished = (F.col("left") == 1) & F.lit(step > 0)
        level = level.groupBy(*KEY, "left", floor_div(F.col("pos"), F.lit(fan_in)).alias("up")).agg(
            F.array_sort(F.collect_list(F.struct("pos", "sha256"))).alias("h")
        )
        level = level.select(
            *KEY, F.ceil(F.col("left") / fan_in).cast("bigint").alias("left"), F.col("up").alias("pos"),
            F.when(finished, F.col("h")[0]["sha256"]).otherwise(joined).alias("sha256"),
        )
        step, reach = step + 1, reach * fan_in
    return level.select(*KEY, F.col("sha256").alias("tree_sha256"))


# ---- byte ranges ------------------------------------------------------------------------
def byte_ranges(files: DataFrame, chunk_bytes: int) -> DataFrame:
    """Fixed-size ranges (inclusive ends) that cover each file of ``total`` bytes.

    A file without bytes has one range that ends before it starts.
    """
    last = floor_div(F.greatest(F.col("total") - 1, F.lit(0)), F.lit(chunk_bytes))
    rows = files.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("chunk_id"))
    start = F.col("chunk_id") * chunk_bytes
    return rows.withColumns(
        {"start_byte": start, "end_byte": F.least(start + chunk_bytes - 1, F.col("total") - 1)}
    )


def reassemble(chunks: DataFrame, key: str, chunk_bytes: int, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Join neighbouring chunks of ``chunk_bytes`` in id order into segments of at most ``segment_bytes``.

    Every key comes back whole, as one row per ``seq``; in the order of ``seq`` the payloads are the file.
    """
    per = max(1, segment_bytes // chunk_bytes)
    joined = chunks.groupBy(key, floor_div(F.col("chunk_id"), F.lit(per)).alias("seq")).agg(
        F.array_sort(F.collect_list(F.struct("chunk_id", "payload"))).alias("p"), F.count(F.lit(1)).alias("chunks")
    )
    out = joined.select(key, "seq", "chunks", _joined(F.col("p.payload")).alias("payload"))
    return out.withColumn("nbytes", F.octet_length("payload").cast("bigint"))


@F.pandas_udf(T.BinaryType())
def _joined(parts: pd.Series) -> pd.Series:
    return pd.Series([b"".join(bytes(x) for x in p) for p in parts], dtype=object)


def batch_number(arrays: DataFrame, blocks: DataFrame, size: int) -> DataFrame:
    """Batches of ``size`` blocks in block order, from the index alone: no window."""
    grid = arrays.select(*KEY, grid_of(F.col("shape"), F.col("chunks")).alias("_g"))
    position = linear_index(F.col("idx"), F.col("_g"))
    numbered = blocks.join(grid, KEY).withColumn("position", position)
    return numbered.withColumn("batch", floor_div(F.col("position"), F.lit(size))).drop("_g")
