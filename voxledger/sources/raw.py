"""Raw volume files of any size, read by byte ranges in the tasks.

A raw file is the C-order bytes of its array along the file's own axis order. Slabs of whole planes of the
first stored axis are dealt out as byte ranges; a task reads its range, turns the axes and cuts blocks.
Files are opened by URI through Arrow's file systems.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.functions.arrays import floor_div, product
from voxledger.operators import blocks as B
from voxledger.plans.chunking import item_size

SLAB_BYTES = 16 << 20  # bytes that a task reads at a time; one plane at least
AXES = "zyx"  # the order that arrays have everywhere else

SLABS = f"path string, {B.KEY_DDL}, shape array<bigint>, dtype string, axes string, first bigint, last bigint, offset bigint, length bigint"


def file_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``bytes`` of the files below a folder; contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return listed.select("path", F.col("length").alias("bytes"))


def checked(files: DataFrame) -> DataFrame:
    """``error`` for files (key columns, ``path``, ``bytes``, ``shape``, ``dtype``, ``axes``) that can't be their array.

    ``shape`` is in the order z, y, x; ``axes`` names the order in the file, NULL for the usual one.
    """
    expected = product(F.col("shape")) * item_size(F.col("dtype"))
    axes = F.coalesce("axes", F.lit(AXES))
    wrong_axes = F.array_join(F.array_sort(F.split(axes, "")), "") != "".join(sorted(AXES))
    error = (
        F.when(F.col("bytes").isNull(), F.lit("no such file"))
        .when(wrong_axes | (F.size("shape") != len(AXES)), F.concat(F.lit("axes "), axes, F.lit(" do not fit the shape")))
        .when(F.col("bytes") != expected, F.format_string("3D block has size %d (expected %d)", F.col("bytes"), expected))
    )
    return files.withColumns({"axes": axes, "error": error})


def slabs(files: DataFrame, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """Byte ranges of whole planes of the first stored axis, about ``slab_bytes`` each, of files without ``error``."""
    of = lambda i: F.element_at("shape", F.call_function("locate", F.substring("axes", i + 1, 1), F.lit(AXES)))
    planes = of(0)
    plane = of(1) * of(2) * item_size(F.col("dtype"))
    per = F.greatest(F.lit(1).cast("bigint"), floor_div(F.lit(slab_bytes).cast("bigint"), F.greatest(plane, F.lit(1))))
    rows = files.where("error IS NULL").withColumns({"_planes": planes, "_plane": plane, "_per": per})
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("_planes") - 1, F.lit(0)), F.col("_per")))
    cut = rows.select("*", start.alias("first")).withColumn("last", F.least(F.col("first") + F.col("_per"), F.col("_planes")))
    return cut.select(
        "path", *B.KEY, "shape", "dtype", "axes", "first", "last", (F.col("first") * F.col("_plane")).alias("offset"),
        ((F.col("last") - F.col("first")) * F.col("_plane")).alias("length"),
    )


def read_slabs(ranges: DataFrame, chunk: list[int]) -> DataFrame:
    """Pieces of blocks of the grid ``chunk`` from slabs: each is read by its range and cut where it was read."""
    schema = B._arrow_schema(B.BLOCKS)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        rows = (row for row in B._rows(batches))
        for path, group in groupby(rows, lambda row: row["path"]):
            system, place = pafs.FileSystem.from_uri(path)
            with system.open_input_file(place) as file:
                for row in group:
                    file.seek(row["offset"])
                    raw = file.read(row["length"])
                    if len(raw) != row["length"]:
                        raise ValueError(f"{path}: {row['length']} bytes asked for at {row['offset']}, {len(raw)} found")
                    yield from _cut(row, raw, chunk)

    spread = ranges.repartition("path", "first").sortWithinPartitions("path", "first")
    return spread.mapInArrow(lambda batches: B._emit(pieces(batches), schema), B.BLOCKS)


def _cut(row: dict, raw: bytes, chunk: list[int]) -> Iterator[dict]:
    """Blocks of a slab, in the usual order of axes."""
    order = [row["axes"].index(a) for a in AXES]
    stored = [row["shape"][AXES.index(a)] for a in row["axes"]]
    stored[0] = row["last"] - row["first"]
    array = np.frombuffer(raw, B._dtype(row["dtype"])).reshape(stored).transpose(order)
    origin = [0, 0, 0]
    origin[AXES.index(row["axes"][0])] = row["first"]
    whole = {
        **{k: row[k] for k in (*B.KEY, "dtype")}, "chunk": chunk, "idx": [0, 0, 0], "origin": origin, "shape": list(array.shape),
        "payload": np.ascontiguousarray(array).tobytes(),
    }
    yield from B._pieces(whole)


def raw_file_blocks(files: DataFrame, chunk: list[int], slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """The block table of raw files (see ``checked``), of any size each; files with an ``error`` give no block.

    A task holds one slab. Pieces of a block from several slabs meet by its index.
    """
    return B._gather(read_slabs(slabs(checked(files), slab_bytes), chunk))


def write_raw_files(blocks: DataFrame, folder: str, axes: str = AXES) -> DataFrame:
    """Write every three-axis array as one raw file below ``folder``; returns ``path``, ``bytes`` and the array's row.

    A file is bytes in order, so a task writes it from start to end, one plane of the first stored axis in
    memory at a time; arrays are dealt out over tasks. Names carry a fresh number: a task that is run again
    writes another file, and the returned table names the whole one.
    """
    from voxledger.session import shared_checkpoint

    arrays = B.inventory(blocks).select(*B.KEY, F.col("shape").alias("_shape"))
    first = AXES.index(axes[0])
    planes = B.rechunk(
        blocks.join(arrays, B.KEY).withColumn(
            "chunk", F.transform("_shape", lambda n, i: F.when(i == first, F.lit(1).cast("bigint")).otherwise(F.greatest(n, F.lit(1))))
        ).select(*B._names(B.BLOCKS)),
        F.col("chunk"),
    )
    ddl = f"path string, bytes bigint, {B.KEY_DDL}, shape array<bigint>, dtype string, axes string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        import uuid

        system, place = pafs.FileSystem.from_uri(folder)
        system.create_dir(place, recursive=True)
        for key, group in groupby(B._rows(batches), lambda row: [row[k] for k in B.KEY]):
            name = f"{uuid.uuid4().hex}.raw"
            size, shape = 0, None
            with system.open_output_stream(f"{place.rstrip('/')}/{name}") as out:
                for row in group:
                    plane = np.ascontiguousarray(B._array(row).transpose([AXES.index(a) for a in axes])).tobytes()
                    out.write(plane)
                    size += len(plane)
                    shape = [o + n for o, n in zip(row["origin"], row["shape"])]
            yield {
                "path": f"{folder.rstrip('/')}/{name}", "bytes": size, **dict(zip(B.KEY, key)), "shape": shape,
                "dtype": row["dtype"], "axes": axes,
            }

    schema = B._arrow_schema(ddl)
    near = planes.repartition(*B.KEY).sortWithinPartitions(*B.KEY, F.col("origin")[first])
    return shared_checkpoint(near.mapInArrow(lambda batches: B._emit(run(batches), schema), ddl))
