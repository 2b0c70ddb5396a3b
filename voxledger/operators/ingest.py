"""Whole jobs: consolidate record folders, store arrays with their records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.operators import blocks as B
from voxledger.operators import catalog as C
from voxledger.operators import sinks as K
from voxledger.operators import store as S
from voxledger.operators.validate import strict_gate, validate
from voxledger.plans import chunking as P
from voxledger.sources.files import read_record_files, scan


def consolidate(
    spark: SparkSession,
    roots: list[str],
    output: str,
    generated_at: str,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    required: list[str] | None = None,
    strict: bool = False,
    fail_on_invalid: bool = False,
    document: bool = False,
) -> dict:
    """Scan, validate and catalogue record folders in one read.

    Writes ``catalog`` (tables, see ``sinks.write_catalog_tables``), ``report`` (one row per file) and
    ``report_summary`` below ``output`` and returns the run's counters; with ``document`` also
    ``catalog_document``, the catalogue as one row, which gathers all sources and keys. In strict mode
    with ``fail_on_invalid`` an invalid file raises after the outputs are written.
    """
    results = K.kept_results(validate(scan(read_record_files(spark, roots), include, exclude), roots))
    try:
        K.write_catalog_tables(results, f"{output}/catalog", required)
        if document:
            whole = K.catalog_document(results, generated_at, roots, strict, include, exclude, required)
            whole.coalesce(1).write.mode("overwrite").text(f"{output}/catalog_document")
        K.write_report(results, f"{output}/report", f"{output}/report_summary")
        counters = C.run_counters(results).first().asDict()
        strict_gate(results, strict, fail_on_invalid)
    finally:
        results.unpersist()
    return counters


def key_presence(spark: SparkSession, root: str = "..") -> DataFrame:
    """The older form of the catalogue: key-presence ratios below one root."""
    files = scan(read_record_files(spark, [root]), ["metadata*.json"], ["*.tmp", "*.log"])
    return C.key_ratios(validate(files, [root]))


def plan_arrays(arrays: DataFrame, max_mb: float, mode: str = "stream", cpus: int = 8) -> DataFrame:
    """Size, class, route, target chunks and pyramid levels of an inventory.

    Class and route are labels: they say what a single process would do. Every array has one planner.
    """
    size = P.item_size(F.col("dtype"))
    mb = P.size_mb(F.col("shape"), size)
    return arrays.select(
        *B.KEY, mb.alias("mb"), P.size_class(mb).alias("size_class"), *P.route(mb, max_mb, mode),
        P.stream_chunks(F.col("shape"), size, 8, cpus).alias("target"),
        P.pyramid_levels(F.col("shape"), size, 32).alias("levels"),
    )


def store_arrays(blocks: DataFrame, path: str, max_mb: float, mode: str = "stream", cpus: int = 8) -> DataFrame:
    """Store every array in full on the grid its size asks for, with the levels of its pyramid beside it.

    Returns plan and statistics of what is stored, per array and level. Arrays of any size and route
    run through the same job. A made level has the name ``<array>/pyramid`` and the number of strides
    above its source, so it never meets a level that came with the data. Statistics come from the
    stored table.
    """
    plan = plan_arrays(B.inventory(blocks), max_mb, mode, cpus)
    names = B._names(B.BLOCKS)
    placed = blocks.drop("chunk").join(plan.select(*B.KEY, F.col("target").alias("chunk"), "levels"), B.KEY)
    whole = B.rechunk(placed.select(*names), F.col("chunk"))
    source = F.concat(F.col("array_name"), F.lit("/"), F.col("level").cast("string"), F.lit("/pyramid"))
    made = B.pyramid(placed.withColumns({"array_name": source, "level": F.lit(0)}), F.col("levels"))
    files = S.write_blocks(whole.unionByName(made), path)
    stored = S.read_files(blocks.sparkSession, path, files)
    return plan.join(B.volume_stats(stored), B.KEY, "full")
