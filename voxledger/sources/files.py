"""Record files: scans, name filters, listings and union of roots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.functions.globs import any_glob
from voxledger.functions.text import base_name

RECORD_FILES = "file string, dir string, fname string, mtime timestamp, value string"


def _hadoop(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _hadoop(spark, path)
    return system.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, hadoop_path = _hadoop(spark, path)
    return system.getFileStatus(hadoop_path).isDirectory()


def read_record_files(spark: SparkSession, roots: list[str], recursive: bool = True, name_glob: str | None = None) -> DataFrame:
    """Whole text files below the roots; a missing root is skipped.

    Overlapping roots give a file once per root.  The file source does not
    list names that start with ``_`` or ``.``.
    """
    frames = []
    for root in roots:
        if not path_exists(spark, root):
            continue
        reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
        if name_glob:
            reader = reader.option("pathGlobFilter", name_glob)
        frames.append(with_path_parts(reader.text(root, wholetext=True).select(
            F.col("_metadata.file_path").alias("uri"),
            F.col("_metadata.file_modification_time").alias("mtime"),
            "value",
        )))
    if not frames:
        return spark.createDataFrame([], RECORD_FILES)
    return reduce(DataFrame.unionByName, frames)


def with_path_parts(df: DataFrame) -> DataFrame:
    """Split a file URI into ``file``, ``dir`` and ``fname``."""
    path = F.url_decode(F.replace(F.regexp_replace("uri", "^file:/+", "/"), F.lit("+"), F.lit("%2B")))
    return (
        df.withColumn("file", path)
        .withColumns({"fname": base_name(F.col("file")), "dir": F.regexp_replace("file", r"/[^/]*$", "")})
        .select("file", "dir", "fname", "mtime", "value")
    )


def is_candidate(include: list[str] | None = None, exclude: list[str] | None = None) -> Column:
    """Name matches an include pattern, no exclude pattern, and not in the output folder."""
    return (
        any_glob(F.col("fname"), include or contract.INCLUDE_PATTERNS)
        & ~any_glob(F.col("fname"), contract.EXCLUDE_PATTERNS if exclude is None else exclude)
        & (base_name(F.col("dir")) != contract.OUTPUT_DIR_NAME)
    )


def scan(files: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    return files.where(is_candidate(include, exclude))


def scan_union(scans: list[DataFrame], distinct: bool = False) -> DataFrame:
    """Union of scans; overlapping roots repeat files unless ``distinct``."""
    out = reduce(DataFrame.unionByName, scans)
    return out.dropDuplicates(["file"]) if distinct else out


def only_files(listing: DataFrame) -> DataFrame:
    """Listing entries that have a length are files, the others are not."""
    return listing.where(F.col("length").isNotNull())


def file_format(path: Column) -> Column:
    """Format label by suffix; NULL for a suffix no reader supports."""
    out = F.lit(None).cast("string")
    for suffix, label in contract.SUPPORTED_SUFFIXES.items():
        out = F.when(path.endswith(suffix), label).otherwise(out)
    return out


def dispatch_formats(listing: DataFrame, path: str = "file") -> DataFrame:
    """Add ``format`` and, for unsupported suffixes, an ``error`` text."""
    return listing.withColumn("format", file_format(F.col(path))).withColumn(
        "error", F.when(F.col("format").isNull(), F.concat(F.lit("Unsupported file type: "), F.col(path)))
    )


def completion_state(expected: DataFrame, listing: DataFrame, key: str = "file") -> DataFrame:
    """Compare expected sizes with a listing.

    ``complete`` when sizes agree, ``partial`` for another non-empty size,
    ``missing`` otherwise.
    """
    have = listing.select(key, F.col("length").alias("actual"))
    return expected.join(have, key, "left").withColumn(
        "state",
        F.when(F.col("actual") == F.col("expected"), "complete").when(F.col("actual") > 0, "partial").otherwise("missing"),
    )


def image_listing(responses: DataFrame, column: str = "body") -> DataFrame:
    """(id, name) rows of saved list responses; the name defaults to its id."""
    schema = "struct<data:array<struct<`@id`:bigint,Name:string>>>"
    item = responses.withColumn("item", F.explode(F.from_json(column, schema)["data"]))
    return item.select(
        *[c for c in responses.columns if c != column],
        F.col("item")["@id"].alias("image_id"),
        F.coalesce(F.col("item")["Name"], F.concat(F.lit("Image "), F.col("item")["@id"].cast("string"))).alias("name"),
    )
