"""Legacy records: source rename, flat-to-nested migration and clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.functions import variants as V
from voxledger.functions.text import has_zone, parse_iso

_CURRENT = "current"


def rename_source(records: DataFrame) -> DataFrame:
    """Give the old source name its new value; ``changed`` marks the rows."""
    old = F.coalesce(V.as_text(F.col("v"), "source") == contract.LEGACY_SOURCE, F.lit(False))
    return records.withColumns(
        {"changed": old, "source": F.when(old, F.lit("ebi")).otherwise(F.col("source"))}
    )


def is_current_format(keys: Column) -> Column:
    return F.array_contains(keys, F.lit("id")) & F.array_contains(keys, F.lit("metadata"))


def is_legacy_failure(best: Column) -> Column:
    """The reported error is a missing id, the mark of the old format."""
    return F.coalesce(
        (best["keyword"] == "required") & best["message"].contains("'id' is a required property"), F.lit(False)
    )


def _get(path: str, kind: str) -> Column:
    return F.try_variant_get("v", V.step(path), kind)


def _created_at() -> Column:
    stamp = V.as_text(F.col("v"), "timestamp")
    iso = "yyyy-MM-dd'T'HH:mm:ssXXX"
    modified = F.date_format("mtime", iso)
    parsed = parse_iso(stamp)
    zoned = F.when(has_zone(stamp), stamp).otherwise(F.date_format(parsed, "yyyy-MM-dd'T'HH:mm:ss"))
    return (
        F.when(stamp.isNull(), modified)
        .when(stamp.endswith("Z"), stamp)
        .when(parsed.isNotNull(), zoned)
        .otherwise(modified)
    )


def migrate(records: DataFrame, new_id: Column | None = None) -> DataFrame:
    """Turn flat records into nested ones.

    Adds ``outcome`` (``already_v2``, ``repaired``, ``converted`` or ``failed``), the typed ``record`` of
    the converted rows and the JSON text ``repaired`` of the repaired ones; both are NULL elsewhere.
    A record that has its nested metadata and only lacks an id keeps everything and gets one.
    """
    given = F.coalesce(new_id if new_id is not None else F.uuid(), F.uuid())
    nested = V.is_object(F.col("v"), "metadata") & ~F.array_contains("keys", F.lit("id"))
    # The id goes in front of the members that are there; a nested record has one at least.
    with_id = F.concat(F.lit('{"id":"'), given, F.lit('",'), F.substring(F.to_json("v"), 2, (1 << 31) - 1))
    source = F.coalesce(V.as_text(F.col("v"), "source"), F.lit("unknown"))
    dims = V.leaf(F.col("v"), "dimensions_nm")
    axis = lambda name: F.coalesce(F.try_variant_get(dims, f"$.{name}", "double"), F.lit(0.0))
    dims_list = F.when(V.is_object(dims), F.array(axis("x"), axis("y"), axis("z"))).otherwise(
        F.try_variant_get(dims, "$", "array<double>")
    )
    record = F.struct(
        given.alias("id"),
        source.alias("source"),
        F.coalesce(V.as_text(F.col("v"), "source_id"), F.lit("unknown")).alias("source_id"),
        F.coalesce(V.as_text(F.col("v"), "status"), F.lit("complete")).alias("status"),
        _created_at().alias("created_at"),
        F.struct(
            F.struct(
                F.coalesce(V.as_text(F.col("v"), "description"), F.concat(F.lit("Data from "), source)).alias("description"),
                _get("volume_shape", "array<bigint>").alias("volume_shape"),
                V.leaf(F.col("v"), "voxel_size_nm").alias("voxel_size_nm"),
                V.as_text(F.col("v"), "dtype").alias("data_type"),
            ).alias("core"),
            F.struct(
                _get("file_size_bytes", "bigint").alias("file_size_bytes"),
                V.as_text(F.col("v"), "sha256").alias("sha256"),
                _get("global_mean", "double").alias("global_mean"),
                _get("chunk_size", "array<bigint>").alias("chunk_size"),
                _get("processing_time_seconds", "double").alias("processing_time_seconds"),
                V.as_text(F.col("v"), "chunk_strategy").alias("chunk_strategy"),
                dims_list.alias("dimensions_nm"),
            ).alias("technical"),
            F.struct(
                V.as_text(F.col("v"), "download_url").alias("download_url"),
                V.as_text(F.col("v"), "internal_zarr_path").alias("internal_zarr_path"),
            ).alias("provenance"),
        ).alias("metadata"),
        F.when(
            V.leaf(F.col("v"), "local_paths").isNotNull(),
            F.struct(
                F.coalesce(V.as_text(F.col("v"), "local_paths.volume"), F.lit("")).alias("volume"),
                F.coalesce(V.as_text(F.col("v"), "local_paths.metadata"), F.col("file")).alias("metadata"),
            ),
        ).alias("files"),
        V.leaf(F.col("v"), "additional_metadata").alias("additional_metadata"),
    )
    outcome = (
        F.when(F.col("load_error").isNotNull(), "failed")
        .when(is_current_format(F.col("keys")), "already_v2")
        .when(nested, "repaired")
        .otherwise("converted")
    )
    return records.withColumn("outcome", outcome).withColumns(
        {
            "record": F.when(F.col("outcome") == "converted", record),
            "repaired": F.when(F.col("outcome") == "repaired", with_id),
        }
    )


def migrate_checked(records: DataFrame, new_id: Column | None = None) -> DataFrame:
    """``migrate`` followed by validation: a converted or repaired row that breaks the contract fails."""
    from voxledger.operators.validate import add_verdict, add_violations

    moved = migrate(records, new_id)
    text = F.to_json("record", {"ignoreNullFields": "true"})
    moved = moved.withColumns({"old_v": F.col("v"), "v": F.when(F.col("outcome") == "converted", F.parse_json(text)).when(F.col("outcome") == "repaired", F.parse_json("repaired"))})
    moved = moved.withColumn("load_error", F.when(F.col("v").isNull(), F.coalesce("load_error", F.lit("not converted"))))
    judged = add_verdict(add_violations(moved))
    failed = F.col("outcome").isin("converted", "repaired") & ~F.col("valid")
    return judged.withColumn("outcome", F.when(failed, "failed").otherwise(F.col("outcome")))


def cleanup(results: DataFrame) -> DataFrame:
    """Mark each file ``remove``, ``keep_invalid``, ``keep_valid`` or ``error``."""
    return results.withColumn(
        "outcome",
        F.when(F.col("load_error").isNotNull(), "error")
        .when(F.col("valid"), "keep_valid")
        .when(is_legacy_failure(F.col("best")), "remove")
        .otherwise("keep_invalid"),
    )


def outcome_counts(rows: DataFrame, key: str = "source") -> DataFrame:
    """Counts per source and outcome, plus the overall rows (source NULL)."""
    return rows.groupingSets([[key, "outcome"], ["outcome"]], key, "outcome").agg(F.count(F.lit(1)).alias("files"))
