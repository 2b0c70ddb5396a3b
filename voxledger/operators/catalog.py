"""Catalogue aggregates over validated records.

All per-source results are hash aggregates with map-side partial results, so a
source that holds a third of the records costs one partial row per task.
Error texts are never gathered into one list: they stay rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.functions import variants as V
from voxledger.functions.text import has_zone, parse_iso


def counts_by(records: DataFrame, field: str) -> DataFrame:
    """Loaded records per value of a top-level field; absent means ``unknown``."""
    value = F.coalesce(V.as_text(F.col("v"), field), F.lit("unknown"))
    return records.where("load_error IS NULL").groupBy(value.alias(field)).agg(F.count(F.lit(1)).alias("files"))


def files_by_source(records: DataFrame) -> DataFrame:
    return records.where("load_error IS NULL").groupBy("source").agg(F.count(F.lit(1)).alias("total"))


def run_counters(results: DataFrame) -> DataFrame:
    """Totals of one run.

    A file that parses but is not an object counts both as processed and as a
    parsing error.
    """
    loaded = F.col("load_error").isNull()
    return results.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("parsed")).alias("processed_files"),
        F.count_if(loaded & ~F.col("valid")).alias("validation_errors"),
        F.count_if(~loaded).alias("parsing_errors"),
        F.count_if(F.col("valid")).alias("valid_files"),
        F.count_if(~F.col("valid")).alias("invalid_files"),
        F.coalesce(
            F.round(F.try_divide(F.count_if(F.col("valid")) * F.lit(100.0), F.count(F.lit(1))), 2), F.lit(0.0)
        ).alias("validation_rate"),
        F.count_distinct(F.when(loaded, F.col("source"))).alias("sources"),
    )


def sources_found(results: DataFrame) -> DataFrame:
    return results.where("load_error IS NULL").select("source").distinct()


def errors_by_source(results: DataFrame) -> DataFrame:
    """Valid, invalid and error counts per source and in total (source NULL)."""
    return results.groupingSets([["source"], []], "source").agg(
        F.count_if(F.col("valid")).alias("valid"),
        F.count_if(~F.col("valid")).alias("invalid"),
        F.sum(F.size("errors")).alias("errors"),
    )


def error_details(results: DataFrame) -> DataFrame:
    """One row per reported error: (source, file, error)."""
    rows = results.select("source", "file", F.explode_outer("errors").alias("error"))
    return rows.where("error IS NOT NULL")


def key_counts(records: DataFrame) -> DataFrame:
    """Records per (key, source), valid or not."""
    rows = records.where("load_error IS NULL").select("source", F.explode_outer("keys").alias("key"))
    return rows.where("key IS NOT NULL").groupBy("key", "source").agg(F.count(F.lit(1)).alias("n"))


def distinct_keys(records: DataFrame) -> DataFrame:
    rows = records.where("load_error IS NULL").select(F.explode_outer("keys").alias("key"))
    return rows.where("key IS NOT NULL").distinct().orderBy("key")


def key_ratios(records: DataFrame) -> DataFrame:
    """Share of a source's records that have each key, to 4 places.

    A marker row per record counts the source's total in the same aggregate;
    the window then runs over (source, key) counts, not over records.
    """
    marked = F.when(F.col("load_error").isNull(), F.concat(F.array(F.lit("")), F.transform("keys", lambda k: F.concat(F.lit("="), k))))
    rows = records.select("source", F.explode_outer(marked).alias("mark"))
    counted = rows.where("mark IS NOT NULL").groupBy("source", "mark").agg(F.count(F.lit(1)).alias("n"))
    total = F.max(F.when(F.col("mark") == "", F.col("n"))).over(Window.partitionBy("source"))
    with_total = counted.withColumn("total", F.coalesce(total, F.lit(1))).where("mark <> ''")
    return with_total.select(
        F.substring("mark", 2, 1 << 30).alias("key"), "source", "n", F.round(F.col("n") / F.col("total"), 4).alias("ratio")
    )


def has_required(required: list[str] | None = None) -> Column:
    """All required keys present and, where metadata is an object, a description."""
    present = F.array_contains("keys", F.lit((required or contract.REQUIRED_TOP)[0]))
    for key in (required or contract.REQUIRED_TOP)[1:]:
        present = present & F.array_contains("keys", F.lit(key))
    described = F.coalesce(V.as_text(F.col("v"), "metadata.core.description"), F.lit("")) != ""
    return present & (described | ~V.is_object(F.col("v"), "metadata"))


def completeness(results: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Mean key count and share with all required fields, over valid records."""
    return (
        results.where("valid")
        .groupBy("source")
        .agg(
            F.round(F.avg(F.size("keys")), 2).alias("average_fields"),
            F.round(F.count_if(has_required(required)) * F.lit(100.0) / F.count(F.lit(1)), 2).alias(
                "required_fields_present"
            ),
        )
    )


def missing_fields(results: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Loaded records per source that lack each required field."""
    wanted = F.array(*[F.lit(k) for k in required or contract.REQUIRED_TOP])
    rows = results.where("load_error IS NULL").select(
        "source", F.explode_outer(F.array_except(wanted, "keys")).alias("field")
    )
    return rows.where("field IS NOT NULL").groupBy("source", "field").agg(F.count(F.lit(1)).alias("files"))


def source_summaries(results: DataFrame, required: list[str] | None = None) -> DataFrame:
    """What the catalogue says of each source, from one pass: counts, completeness, missing fields.

    Only counters are gathered: one row per source, with one entry per required field.
    """
    fields = required or contract.REQUIRED_TOP
    loaded, valid = F.col("load_error").isNull(), F.col("valid")
    return results.groupBy("source").agg(
        F.count_if(loaded).alias("total"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("invalid"),
        F.sum(F.size("errors")).alias("errors"),
        F.round(F.avg(F.when(valid, F.size("keys"))), 2).alias("average_fields"),
        F.struct(
            *[F.count_if(loaded & ~F.coalesce(F.array_contains("keys", F.lit(k)), F.lit(False))).alias(k) for k in fields]
        ).alias("missing"),
    )


def source_documents(results: DataFrame, required: list[str] | None = None) -> DataFrame:
    """The catalogue as one JSON document per source (``source``, ``value``); key ratios stay rows."""
    found = source_summaries(results, required)
    return found.select("source", F.to_json(F.struct(*[c for c in found.columns if c != "source"])).alias("value"))


def valid_sample(results: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` valid records by file name: a top-n, not a full sort."""
    return results.where("valid").orderBy("file").limit(n)


def processing_seconds(records: DataFrame) -> DataFrame:
    """Seconds from creation to update; unusable timestamps are skipped."""
    timed = records.where("load_error IS NULL").select("file", "source", _seconds().alias("seconds"))
    return timed.where("seconds IS NOT NULL")


def _seconds() -> Column:
    created, updated = V.as_text(F.col("v"), "created_at"), V.as_text(F.col("v"), "updated_at")
    micros = F.unix_micros(parse_iso(updated)) - F.unix_micros(parse_iso(created))
    return F.when(has_zone(created) == has_zone(updated), micros / F.lit(1e6))


def latest_per_source(files: DataFrame, *carry: str, key: str = "source") -> DataFrame:
    """The newest file per source (ties: last name), as a partial aggregate."""
    newest = F.max_by(F.struct("file", "mtime", *carry), F.struct("mtime", "file"))
    return files.groupBy(key).agg(newest.alias("r")).select(key, "r.*")


def first_errors(results: DataFrame, n: int = 2) -> DataFrame:
    return results.withColumn("errors", F.slice("errors", 1, n))


def latest_validity(results: DataFrame) -> DataFrame:
    """Validity of each source's newest file, with the overall percentage."""
    latest = latest_per_source(results, "valid", "errors")
    return first_errors(latest)


def valid_share(latest: DataFrame) -> DataFrame:
    return latest.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.col("valid")).alias("valid_files"),
        F.coalesce(
            F.round(F.try_divide(F.count_if(F.col("valid")) * F.lit(100.0), F.count(F.lit(1))), 1), F.lit(0.0)
        ).alias("percent"),
    )


def processing_summary(results: DataFrame) -> DataFrame:
    """(section, name, value) rows: totals, status and source counts, errors, times.

    All sections come from one pass with grouping sets.
    """
    loaded = F.col("load_error").isNull()
    field = lambda name: F.coalesce(V.as_text(F.col("v"), name), F.lit("unknown"))
    rows = results.select(
        field("status").alias("status"), field("source").alias("given"), loaded.alias("loaded"), "valid",
        F.when(loaded, _seconds()).alias("seconds"),
    )
    sets = rows.groupingSets([["status"], ["given"], []], "status", "given").agg(
        F.grouping_id().alias("g"),
        F.count_if("loaded").alias("loaded"),
        F.count(F.lit(1)).alias("files"),
        F.count_if(~F.col("valid")).alias("invalid"),
        F.count("seconds").alias("timed"),
        F.sum("seconds").alias("seconds"),
    )

    def row(section: str, name, value: str):
        named = name if not isinstance(name, str) else F.lit(name)
        return F.struct(F.lit(section).alias("section"), named.alias("name"), F.col(value).cast("double").alias("value"))

    shown = (
        F.when(F.col("g") == 1, F.array(row("status", F.col("status"), "loaded")))
        .when(F.col("g") == 2, F.array(row("source", F.col("given"), "loaded")))
        .otherwise(
            F.array(
                row("run", "total_files", "files"), row("run", "validation_errors", "invalid"),
                row("times", "count", "timed"), row("times", "seconds", "seconds"),
            )
        )
    )
    # Groups that only unloaded files fall into are not status or source counts.
    return sets.where("g = 3 OR loaded > 0").select(F.inline(shown))


def error_classes(checked: DataFrame) -> DataFrame:
    """Broken rules by source and keyword; load failures keep their class."""
    classed = F.when(F.col("load_error").isNotNull(), F.array("error_class")).otherwise(
        F.transform("violations", lambda x: x["keyword"])
    )
    rows = checked.select("source", F.explode_outer(classed).alias("error_class"))
    return rows.where("error_class IS NOT NULL").groupBy("source", "error_class").agg(F.count(F.lit(1)).alias("n"))
