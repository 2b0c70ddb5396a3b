"""A store of block tables: files laid out along a Z-order curve, with a zone map beside them.

The blocks of an array lie on a Z-order curve over block indices. A *cell* is a cube of neighbouring
blocks, about a file's worth of bytes: one stretch of the curve. Rows are dealt to files by array and cell and
sorted by the curve, so a cell is in one file (or few), next to its neighbours. The zone map has a row
per file, array and cell: range of the curve, least and greatest block index, extent, blocks, bytes.

A store is a folder with ``data/write=<id>`` (files are never changed) and ``zones/<number>``, one
whole zone map per write. The newest complete zone map is the store: a write shows when its zone map is
there, readers of the one before go on undisturbed, and of two writers at once one fails. Every file
that a zone map names holds current rows only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.functions.arrays import MOST_AXES, explode_axes, floor_div, product
from voxledger.operators import blocks as B
from voxledger.plans.chunking import item_size
from voxledger.session import shared_checkpoint

CURVE_BITS = 62  # of a curve position, shared by the axes
CELL_BYTES = 64 << 20  # payload of a cell, at most

STORED = f"{B.BLOCKS}, curve bigint, fold int, nbytes bigint"
ZONES = (
    f"file string, {B.KEY_DDL}, fold int, cell bigint, curve_low bigint, curve_high bigint, idx_low array<bigint>, "
    "idx_high array<bigint>, end array<bigint>, chunk array<bigint>, dtype string, blocks bigint, nbytes bigint"
)


# ---- the curve ---------------------------------------------------------------------
def curve_position(idx: Column) -> Column:
    """Place of a block index on the Z-order curve: the bits of the axes in turn, the last axis lowest.

    The axes share ``CURVE_BITS``; an index beyond its bits counts as the last one. So positions never fall
    as indices grow, and far blocks of a huge grid only share a position.
    """
    n = F.size(idx)
    bits = floor_div(F.lit(CURVE_BITS), F.greatest(n, F.lit(1))).cast("int")
    last = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits) - 1

    def put(code: Column, place: Column) -> Column:
        axis, bit = n - 1 - place % n, floor_div(place, n).cast("int")
        one = F.call_function("shiftright", F.least(F.get(idx, axis), last), bit).bitwiseAND(F.lit(1).cast("bigint"))
        return code.bitwiseOR(F.call_function("shiftleft", one, place))

    return F.aggregate(F.sequence(F.lit(0), (bits * n - 1).cast("int")), F.lit(0).cast("bigint"), put)


def cell_fold(chunk: Column, dtype: Column, cell_bytes: int = CELL_BYTES) -> Column:
    """log2 of a cell's edge in blocks: the largest cube of blocks with at most ``cell_bytes``."""
    block = F.greatest(product(chunk) * item_size(dtype), F.lit(1))
    return F.greatest(F.lit(0), F.floor(F.log2(F.lit(cell_bytes) / block) / F.size(chunk))).cast("int")


def cell_of(curve: Column, fold: Column, axes: Column) -> Column:
    return F.call_function("shiftright", curve, (fold * axes).cast("int"))


# ---- writing -----------------------------------------------------------------------
def write_blocks(blocks: DataFrame, path: str, codec: str = "lz4_raw", spread: bool = True, cell_bytes: int = CELL_BYTES) -> list[str]:
    """Store a block table; data sets that are stored already are replaced, all others stay.

    Returns the names of the files with the rows of ``blocks``.

    ``blocks`` is computed once. Rows are dealt to files by array and cell, and files by measured bytes, so
    a large volume has as many writers as its size asks for. With ``spread`` off every task writes the
    rows it has: right for blocks that were made in block order. Old files that hold a replaced data
    set next to others are replaced by a file of those others.
    """
    spark = blocks.sparkSession
    fold = cell_fold(F.col("chunk"), F.col("dtype"), cell_bytes)
    rows = blocks.select(*[F.col(c) for c in B._names(B.BLOCKS)], curve_position(F.col("idx")).alias("curve"), fold.alias("fold"))
    added = _write_files(rows.withColumn("nbytes", F.octet_length("payload").cast("bigint")), path, codec, spread)
    number, old = _newest(spark, path)
    zones = added
    if old is not None:
        replaced = added.select("dataset_id").distinct()
        touched = old.join(replaced, "dataset_id", "left_semi").select("file").distinct()
        rest = old.join(touched, "file", "left_semi").join(replaced, "dataset_id", "left_anti")
        zones = zones.unionByName(old.join(touched, "file", "left_anti"))
        if files := _names(rest):
            others = read_files(spark, path, files).join(replaced, "dataset_id", "left_anti")
            zones = zones.unionByName(_write_files(others.select(*B._names(STORED)), path, codec, True))
    zones.hint("rebalance").write.mode("errorifexists").parquet(f"{path}/zones/{number + 1:08d}")
    return _names(added)


def _names(zone_rows: DataFrame) -> list[str]:
    """File names of zones: as many as a scan's list of files holds on the driver."""
    return [r["file"] for r in zone_rows.select("file").distinct().collect()]


def _write_files(rows: DataFrame, path: str, codec: str, spread: bool) -> DataFrame:
    """Write ``rows`` (``STORED``) as new files and return their zones, read from the small columns."""
    name = f"write={uuid.uuid4().hex}"
    cell = cell_of(F.col("curve"), F.col("fold"), F.size("idx"))
    order = [*B.KEY, "curve"]
    placed = rows.withColumn("_cell", cell).hint("rebalance", *B.KEY, "_cell").drop("_cell") if spread else rows
    (
        placed.sortWithinPartitions(*order)
        .write.option("maxRecordsPerFile", 1_000_000)
        .option("compression", codec)
        .parquet(f"{path}/data/{name}")
    )
    spark = rows.sparkSession
    return shared_checkpoint(_zones(spark.read.schema(STORED).parquet(f"{path}/data/{name}"), name))


def _zones(stored: DataFrame, name: str) -> DataFrame:
    """Zones of stored files; payloads are not read."""
    small = stored.select(
        F.concat(F.lit(f"{name}/"), F.col("_metadata.file_name")).alias("file"), *B.KEY, "fold",
        cell_of(F.col("curve"), F.col("fold"), F.size("idx")).alias("cell"), "curve", "idx",
        F.zip_with("origin", "shape", lambda o, s: o + s).alias("end"), "chunk", "dtype", "nbytes",
    )
    at = ["file", *B.KEY, "fold", "cell"]
    # One aggregate of plain numbers per axis; axes beyond the array's are null and dropped.
    per_axis = [
        f(F.get(c, F.lit(i))).alias(f"{name_}{i}")
        for i in range(MOST_AXES)
        for name_, c, f in (("l", "idx", F.min), ("h", "idx", F.max), ("e", "end", F.max))
    ]
    made = small.groupBy(*at).agg(
        F.min("curve").alias("curve_low"), F.max("curve").alias("curve_high"), *per_axis, F.max("chunk").alias("chunk"),
        F.max("dtype").alias("dtype"), F.count(F.lit(1)).alias("blocks"), F.sum("nbytes").alias("nbytes"),
    )
    gather = lambda name_: F.array_compact(F.array(*[F.col(f"{name_}{i}") for i in range(MOST_AXES)]))
    return made.select(
        *at, "curve_low", "curve_high", gather("l").alias("idx_low"), gather("h").alias("idx_high"), gather("e").alias("end"),
        "chunk", "dtype", "blocks", "nbytes",
    ).select(*B._names(ZONES))


# ---- reading -----------------------------------------------------------------------
def _newest(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """Number and rows of the newest complete zone map; (0, None) for a folder without a store."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/zones")
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return 0, None
    names = [s.getPath().getName() for s in system.listStatus(place)]
    done = [n for n in names if n.isdigit() and system.exists(spark._jvm.org.apache.hadoop.fs.Path(place, f"{n}/_SUCCESS"))]
    if not done:
        return 0, None
    return int(max(done)), spark.read.schema(ZONES).parquet(f"{path}/zones/{max(done)}")


def zones(spark: SparkSession, path: str) -> DataFrame:
    """The zone map of a store: what each file holds of each array and cell."""
    found = _newest(spark, path)[1]
    if found is None:
        raise ValueError(f"no block store in {path}")
    return found


def stored_inventory(zone_map: DataFrame) -> DataFrame:
    """The array inventory of a store from its zone map alone: no data file is opened."""
    axes = zone_map.select(*B.KEY, F.posexplode("end").alias("axis", "end"))
    ends = axes.groupBy(*B.KEY, "axis").agg(F.max("end").alias("end")).groupBy(*B.KEY)
    shape = ends.agg(F.array_sort(F.collect_list(F.struct("axis", "end"))).alias("ends"))
    sums = zone_map.groupBy(*B.KEY).agg(
        F.max("chunk").alias("chunks"), F.max("dtype").alias("dtype"), F.sum("blocks").alias("blocks"),
        F.sum("nbytes").alias("nbytes"), F.max("fold").alias("fold"),
    )
    return shape.join(sums, B.KEY).select(*B.KEY, F.col("ends.end").alias("shape"), "chunks", "dtype", "blocks", "nbytes", "fold")


def read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    """Rows (``STORED``) of some files of a store."""
    if not files:
        return spark.createDataFrame([], STORED)
    return spark.read.schema(STORED).parquet(*[f"{path}/data/{f}" for f in sorted(files)])


def read_blocks(spark: SparkSession, path: str, dataset_id: str | None = None) -> DataFrame:
    """A stored block table, or one data set of it: only files that hold it are read then."""
    found = zones(spark, path)
    if dataset_id is not None:
        found = found.where(F.col("dataset_id") == dataset_id)
    rows = read_files(spark, path, _names(found))
    if dataset_id is not None:
        rows = rows.where(F.col("dataset_id") == dataset_id)
    return rows.select(*B._names(B.BLOCKS))


def matching_files(requests: DataFrame, zone_map: DataFrame, axes: int = MOST_AXES) -> DataFrame:
    """Files that can hold a block of a requested box (key columns, ``start``, ``size``).

    A box turns into the cells it touches, which are stretches of the curve, and the zone map is joined on
    array and cell: an equality, however many boxes and files there are.
    """
    arrays = stored_inventory(zone_map)
    asked = B.clipped_boxes(requests, arrays.select(*B.KEY, F.col("chunks").alias("_c"), F.col("shape").alias("_dims"), "fold"))
    down = lambda c: F.transform(c, lambda i: F.call_function("shiftright", i, F.col("fold")))
    coarse = asked.select(*B.KEY, "fold", down(F.col("_first")).alias("_first"), down(F.col("_last")).alias("_last")).distinct()
    cells = explode_axes(coarse, "_first", "_last", "at", axes)
    # The curve of a cell's place is the cell's number, but for the bits that the fold took from the top.
    corner = F.transform("at", lambda i: F.call_function("shiftleft", i, F.col("fold")))
    wanted = cells.select(*B.KEY, cell_of(curve_position(corner), F.col("fold"), F.size("at")).alias("cell")).distinct()
    return zone_map.join(wanted, [*B.KEY, "cell"], "left_semi").select("file").distinct()


def store_lookup(requests: DataFrame, path: str, axes: int = MOST_AXES) -> DataFrame:
    """The parts of stored blocks that each requested box covers (see ``blocks.crop_pieces``).

    Only files that the zone map names for a touched cell are opened. The list of their names comes to the
    driver, as that of any scan does.
    """
    spark = requests.sparkSession
    zone_map = zones(spark, path)
    files = _names(matching_files(requests, zone_map, axes))
    found = read_files(spark, path, files).select(*B._names(B.BLOCKS))
    return B.crop_pieces(requests, found, stored_inventory(zone_map), axes=axes)
