"""Writes: validated records, catalogue, report and status tables. Block tables: see ``store``."""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.operators import catalog as C
from voxledger.session import shared_checkpoint


def write_validated(results: DataFrame, path: str) -> None:
    """Records as text rows below ``path``: ``outcome=valid`` and, with their errors, ``outcome=quarantine``.

    One job reads the results once and commits both parts together.
    """
    outcome = F.when(F.col("valid"), F.lit("valid")).otherwise(F.lit("quarantine")).alias("outcome")
    rows = results.select("file", "source", "error_class", "errors", F.to_json("v").alias("record"), outcome)
    rows.write.mode("append").partitionBy("outcome").parquet(path)


def write_report(results: DataFrame, path: str, summary_path: str) -> None:
    """Per-file detail as JSON lines, and the summary as one document."""
    results.select("errors", "file", "source", "valid").write.mode("overwrite").json(path)
    summary = _document(_validation_sections(results), {"summary": _VALIDATION})
    summary.coalesce(1).write.mode("overwrite").text(summary_path)


_VALIDATION = {
    "errors_by_source": "errors_by_source",
    "invalid_files": "counters.invalid_files",
    "total_files": "counters.total_files",
    "valid_files": "counters.valid_files",
    "validation_rate": "counters.validation_rate",
}


def _section(name: str, one_row: DataFrame, body) -> DataFrame:
    """A one-row aggregate as (section, JSON text)."""
    return one_row.select(F.lit(name).alias("section"), F.to_json(body).alias("body"))


def _as_map(df: DataFrame, key: str, value) -> DataFrame:
    """One row with all entries; the document sorts the keys."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(F.col(key).alias("k"), value.alias("v")))).alias("m"))


def _validation_sections(results: DataFrame) -> list[DataFrame]:
    counters = C.run_counters(results)
    by_source = _as_map(
        C.errors_by_source(results).where("source IS NOT NULL"), "source", F.struct("errors", "invalid", "valid")
    )
    return [
        _section("counters", counters, F.struct(*counters.columns)),
        _section("errors_by_source", by_source, F.col("m")),
    ]


def _document(sections: list[DataFrame], layout: dict, constants: dict | None = None) -> DataFrame:
    """Assemble one JSON document from section rows; keys come out sorted."""
    rows = sections[0]
    for part in sections[1:]:
        rows = rows.unionByName(part)
    gathered = rows.agg(F.map_from_entries(F.collect_list(F.struct("section", "body"))).alias("m"))

    def build(node):
        if isinstance(node, dict):
            return F.struct(*[build(node[k]).alias(k) for k in sorted(node)])
        if node in (constants or {}):
            return F.parse_json(F.lit(constants[node]))
        name, _, path = node.partition(".")
        return F.try_variant_get(F.parse_json(F.element_at("m", name)), f"$.{path}" if path else "$", "variant")

    return gathered.select(F.to_json(build(layout)).alias("value"))


def catalog_document(
    results: DataFrame,
    generated_at: str,
    roots: list[str],
    strict: bool = False,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    required: list[str] | None = None,
) -> DataFrame:
    """The catalogue as one row of JSON with keys in sorted order.

    Its size follows the number of sources and distinct keys, not of records;
    error texts are counted here and written as rows by ``write_report``.
    """
    ratios = C.key_ratios(results).groupBy("key").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("source", "ratio")))).alias("by_source")
    )
    missing = C.missing_fields(results, required).groupBy("source").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "files")))).alias("fields")
    )
    sample = C.valid_sample(results).select("file", F.to_json("v").alias("record"))
    sections = [
        *_validation_sections(results),
        _section("distinct_keys", C.distinct_keys(results).agg(F.sort_array(F.collect_list("key")).alias("m")), F.col("m")),
        _section("key_ratios", _as_map(ratios, "key", F.col("by_source")), F.col("m")),
        _section("totals", _as_map(C.files_by_source(results), "source", F.col("total")), F.col("m")),
        _section("sources", C.sources_found(results).agg(F.sort_array(F.collect_list("source")).alias("m")), F.col("m")),
        _section(
            "completeness",
            _as_map(C.completeness(results, required), "source", F.struct("average_fields", "required_fields_present")),
            F.col("m"),
        ),
        _section("missing", _as_map(missing, "source", F.col("fields")), F.col("m")),
        _section(
            "sample",
            sample.agg(F.array_sort(F.collect_list(F.struct("file", "record"))).alias("m")),
            F.transform("m", lambda r: F.parse_json(r["record"])),
        ),
    ]
    settings = {
        "exclude_patterns": contract.EXCLUDE_PATTERNS if exclude is None else exclude,
        "include_patterns": include or contract.INCLUDE_PATTERNS,
        "scan_directories": roots,
        "validation_enabled": strict,
    }
    layout = {
        "data_quality": {
            "common_missing_fields": "missing",
            "completeness_by_source": "completeness",
            "schema_compliance_rate": "counters.validation_rate",
        },
        "legacy_compatibility": {
            "distinct_keys": "distinct_keys",
            "key_ratios_by_source": "key_ratios",
            "total_files_by_source": "totals",
        },
        "metadata": {
            "configuration": "=settings",
            "consolidation_version": "=version",
            "generated_at": "=generated_at",
            "schema_version": "=schema_version",
        },
        "summary": {
            "parsing_errors": "counters.parsing_errors",
            "processed_files": "counters.processed_files",
            "sources_found": "sources",
            "total_files": "counters.total_files",
            "validation_errors": "counters.validation_errors",
        },
        "valid_records_sample": "sample",
        "validation": _VALIDATION,
    }
    constants = {
        "=settings": json.dumps(settings),
        "=version": '"2.0-enhanced"',
        "=generated_at": json.dumps(generated_at),
        "=schema_version": '"1.0"',
    }
    return _document(sections, layout, constants)


def write_catalog_tables(results: DataFrame, path: str, required: list[str] | None = None) -> None:
    """The catalogue as tables below ``path``, for catalogues of any size: ``sources`` (a JSON document
    each), ``key_ratios`` and ``sample``. No table gathers keys or sources into one row."""
    C.source_documents(results, required).write.mode("overwrite").parquet(f"{path}/sources")
    C.key_ratios(results).write.mode("overwrite").parquet(f"{path}/key_ratios")
    sample = C.valid_sample(results).select("file", F.to_json("v").alias("record"))
    sample.write.mode("overwrite").parquet(f"{path}/sample")


def kept_results(results: DataFrame) -> DataFrame:
    """The columns the outputs need, kept while several outputs read them."""
    wanted = ["file", "source", "mtime", "parsed", "load_error", "keys", "valid", "errors", "error_class", "v"]
    return results.select(*wanted).persist(StorageLevel.MEMORY_AND_DISK)


def write_catalog(results: DataFrame, path: str, generated_at: str, roots: list[str], **settings) -> None:
    """Write the catalogue document; the results are read once and kept meanwhile."""
    kept = kept_results(results)
    try:
        catalog_document(kept, generated_at, roots, **settings).coalesce(1).write.mode("overwrite").text(path)
    finally:
        kept.unpersist()


def write_new_version(spark: SparkSession, records: DataFrame, removed: DataFrame, path: str) -> None:
    """A new table version without the removed files; nothing is deleted in place."""
    records.join(removed.select("file"), "file", "left_anti").write.mode("errorifexists").parquet(path)
