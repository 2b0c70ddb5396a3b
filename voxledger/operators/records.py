"""Record building, updates, merging and field mapping."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger import contract
from voxledger.functions import variants as V
from voxledger.functions.stages import replace_fields, struct_of
from voxledger.functions.text import base_name


# ---- building ---------------------------------------------------------------
# A record under construction is a dict from dotted field to column; it becomes
# one struct at the end, so the plan holds each field once.
Fields = dict[str, Column]


def new_record(
    source: Column,
    source_id: Column,
    description: Column,
    record_id: Column | None = None,
    now: Column | None = None,
    run: dict[str, str] | None = None,
) -> Fields:
    """Fields of a new record: given or random id, pending, created and updated now."""
    clock = now if now is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    fields = {
        "id": F.coalesce(record_id, F.uuid()) if record_id is not None else F.uuid(),
        "source": source,
        "source_id": source_id,
        "status": F.lit("pending"),
        "created_at": clock,
        "updated_at": clock,
        "metadata.core.description": description,
    }
    for name, value in (run or {}).items():
        fields[f"ci_metadata.{name}"] = F.lit(value).cast("string")
    return fields


def run_provenance(environ: dict[str, str]) -> dict[str, str] | None:
    """Run columns from an environment, only when the flag is set."""
    if environ.get("EM_CI_METADATA") != "true":
        return None
    return {**{k: environ.get(v) for k, v in contract.RUN_FIELDS.items()}, "processing_environment": "github_actions"}


def _technical(values: dict[str, Column]) -> Fields:
    """Shape, voxel size and type belong to core; size, hash and the rest to technical."""
    core = {"volume_shape", "voxel_size_nm", "data_type"}
    return {f"metadata.{'core' if k in core else 'technical'}.{k}": v for k, v in values.items()}


def _files(paths: dict[str, Column]) -> Fields:
    return {f"files.{k}": v for k, v in paths.items()}


def to_record(fields: Fields) -> Column:
    return struct_of(fields)


# ---- updates of a record column ------------------------------------------------
def current(df: DataFrame, path: str) -> Column:
    """The old value of a dotted field, NULL where the struct has no such field."""
    kind = df.schema["record"].dataType
    for part in path.split("."):
        if not isinstance(kind, T.StructType) or part not in kind.names:
            return F.lit(None)
        kind = kind[part].dataType
    return F.col(f"record.{path}")


def set_paths(df: DataFrame, changes: Fields) -> DataFrame:
    """Set dotted fields of ``record``, creating parents."""
    return replace_fields(df, "record", changes)


def keep_old(df: DataFrame, changes: Fields) -> DataFrame:
    """Set dotted fields where the new value is given, else leave the old one."""
    return set_paths(df, {path: F.coalesce(value, current(df, path)) for path, value in changes.items()})


def add_technical(df: DataFrame, **values: Column) -> DataFrame:
    return keep_old(df, _technical(values))


def add_files(df: DataFrame, additional: Column | None = None, **paths: Column) -> DataFrame:
    """File paths; extra paths update the ``additional`` map key by key, last wins."""
    changes = {p: F.coalesce(v, current(df, p)) for p, v in _files(paths).items()}
    if additional is not None:
        old = F.coalesce(current(df, "files.additional").cast("map<string,string>"), F.create_map().cast("map<string,string>"))
        kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(additional), k))
        changes["files.additional"] = F.map_concat(kept, additional)
    return set_paths(df, changes)


def update_status(
    df: DataFrame,
    status: Column,
    now: Column,
    percentage: Column | None = None,
    step: Column | None = None,
    message: Column | None = None,
    traceback: Column | None = None,
) -> DataFrame:
    """One status change; the error part only moves on ``failed`` and is never cleared."""
    failed = status == "failed"
    count = current(df, "error.retry_count").cast("bigint")
    changes: Fields = {
        "status": status,
        "updated_at": now,
        "error.retry_count": F.when(failed, F.coalesce(count, F.lit(0).cast("bigint")) + 1).otherwise(count),
    }
    for path, value in {"progress.percentage": percentage, "progress.current_step": step}.items():
        if value is not None:
            changes[path] = F.coalesce(value, current(df, path))
    for path, value in {"error.message": message, "error.traceback": traceback}.items():
        if value is not None:
            changes[path] = F.coalesce(F.when(failed & (value != ""), value), current(df, path))
    return set_paths(df, changes)


# ---- records of the five sources ---------------------------------------------
def slice_record(df: DataFrame, entry: str, title: str, file: str, server: str, now: Column) -> DataFrame:
    """Record per downloaded slice file of an archive entry."""
    label = F.coalesce(F.col(title), F.concat(F.lit(contract.SLICE_TITLE), F.col(entry)))
    url = F.concat(
        F.lit(f"ftp://{server}{contract.ARCHIVE_ROOT}"), F.col(entry), F.lit("/data/"), base_name(F.col(file))
    )
    technical = {
        "volume_shape": F.col("shape"), "data_type": F.lit("uint8"),
        "file_size_bytes": F.col("bytes"), "sha256": F.col("sha256"),
    }
    paths = {"volume": F.col("volume_path"), "raw": F.col(file), "metadata": F.col("metadata_path")}
    return df.withColumn(
        "record",
        to_record(
            {
                **new_record(F.lit("ebi"), F.col(entry), label, F.col("record_id"), now),
                **_technical(technical), **_files(paths),
                "metadata.provenance.download_url": url, "status": F.lit("complete"),
            }
        ),
    )


def image_record(df: DataFrame, now: Column) -> DataFrame:
    """Record per image of an image server."""
    number = F.col("image_id").cast("string")
    label = F.coalesce(F.when(F.col("name") != "", F.col("name")), F.concat(F.lit(contract.IMAGE_TITLE), number))
    technical = {
        "volume_shape": F.col("shape"), "data_type": F.col("dtype"),
        "file_size_bytes": F.col("bytes"), "sha256": F.col("sha256"),
    }
    paths = {"volume": F.col("volume_path"), "metadata": F.col("metadata_path")}
    return df.withColumn(
        "record",
        to_record(
            {
                **new_record(F.lit("idr"), F.concat(F.lit("IDR-"), number), label, F.col("record_id"), now),
                **_technical(technical), **_files(paths),
                "metadata.provenance.download_url": F.col("url"), "status": F.lit("complete"),
            }
        ),
    )


def section_record(df: DataFrame, now: Column) -> DataFrame:
    """Record of the single tissue section; it carries no hash."""
    technical = {
        "volume_shape": F.col("shape"), "voxel_size_nm": F.col("voxel_size_nm"),
        "data_type": F.col("dtype"), "file_size_bytes": F.col("bytes"),
    }
    paths = {"volume": F.col("volume_path"), "raw": F.col("raw_path"), "metadata": F.col("metadata_path")}
    return df.withColumn(
        "record",
        to_record(
            {
                **new_record(F.lit("epfl"), F.col("source_id"), F.lit(contract.SECTION_TITLE), F.col("record_id"), now),
                **_technical(technical), **_files(paths),
                "metadata.provenance.download_url": F.col("url"), "status": F.lit("complete"),
            }
        ),
    )


def crop_record(df: DataFrame, now: Column) -> DataFrame:
    """Record of a crop, with its bounds, origin and size as extra metadata."""
    origin = F.array_join(F.transform("origin", lambda x: x.cast("string")), ", ")
    label = F.format_string(contract.CROP_TITLE, origin)
    technical = {"volume_shape": F.col("size"), "data_type": F.col("dtype"), "file_size_bytes": F.col("bytes")}
    paths = {"volume": F.col("volume_path"), "metadata": F.col("metadata_path")}
    return df.withColumn(
        "record",
        to_record(
            {
                **new_record(F.lit("flyem"), F.col("source_id"), label, F.col("record_id"), now),
                **_technical(technical), **_files(paths),
                "metadata.provenance.download_url": F.col("url"), "status": F.lit("complete"),
                "additional_metadata.dataset_bounds": F.array("start", "stop"),
                "additional_metadata.crop_origin": F.col("origin"),
                "additional_metadata.crop_size": F.col("size"),
            }
        ),
    )


def array_record(df: DataFrame, now: Column) -> DataFrame:
    """Stub record of one stored array; absent extents become zero."""
    d = F.col("dimensions")
    zero = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    technical = {
        "voxel_size_nm": F.col("voxel_size_nm"),
        "dimensions_nm": F.when(d.isNotNull(), F.array(zero(d["x"]), zero(d["y"]), zero(d["z"]))),
    }
    paths = {"volume": F.col("volume_path"), "metadata": F.col("metadata_path")}
    label = F.format_string(contract.ARRAY_TITLE, F.col("array_name"))
    return df.withColumn(
        "record",
        to_record(
            {
                **new_record(F.lit("openorganelle"), F.col("dataset_id"), label, F.col("record_id"), now),
                **_technical(technical), **_files(paths),
                "metadata.provenance.download_url": F.col("url"),
                "metadata.provenance.internal_zarr_path": F.concat_ws("/", F.col("internal_path"), F.col("array_name")),
                "metadata.core.imaging_start_date": F.lit(contract.IMAGING_START),
                "status": F.lit("saving-data"),
                "local_paths.volume": F.col("volume_path"), "local_paths.metadata": F.col("metadata_path"),
            }
        ),
    )


# ---- open documents -----------------------------------------------------------
def _merge(base, extra):
    """Objects merge key by key; anything else on the right replaces the left."""
    if isinstance(base, dict) and isinstance(extra, dict):
        return {**base, **{k: _merge(base[k], v) if k in base else v for k, v in extra.items()}}
    return extra


@F.pandas_udf(T.StringType())
def deep_merge(base: pd.Series, extra: pd.Series) -> pd.Series:
    """Deep merge of two JSON objects given as text; keys come out sorted.

    With one text NULL the other is the result. A text that is not JSON gives NULL, and
    ``merge_error`` names it: one bad record never fails the run.
    """
    return pd.Series([_merged(a, b)[0] for a, b in zip(base, extra)], dtype=object)


@F.pandas_udf(T.StringType())
def merge_error(base: pd.Series, extra: pd.Series) -> pd.Series:
    """Why two texts can't be merged; NULL if they can."""
    return pd.Series([_merged(a, b)[1] for a, b in zip(base, extra)], dtype=object)


def _merged(a: str | None, b: str | None) -> tuple[str | None, str | None]:
    if a is None or b is None:
        return (a if b is None else b), None
    values = []
    for side, text in (("base", a), ("extra", b)):
        try:
            values.append(json.loads(text))
        except ValueError:
            return None, f"{side} is not JSON"
    return json.dumps(_merge(*values), sort_keys=True, ensure_ascii=False), None


# ---- field mapping ------------------------------------------------------------
def map_fields(records: DataFrame, mapping: dict[str, dict[str, str]]) -> DataFrame:
    """Pick ``source_id`` and ``description`` from the fields a source names."""

    def pick(role: str) -> Column:
        out = F.lit(None).cast("string")
        for source, fields in mapping.items():
            if role in fields:
                out = F.when(F.col("source") == source, V.as_text(F.col("v"), fields[role])).otherwise(out)
        return out

    return records.withColumns(
        {"mapped_id": pick("source_id_field"), "mapped_description": pick("description_field")}
    )


# ---- latest state -------------------------------------------------------------
def latest_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row per key as a partial aggregate (stub then final, or dict update)."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(last.alias("r")).select(*keys, "r.*")


def status_state(events: DataFrame) -> DataFrame:
    """Fold status events per data set: what the record holds after the last one.

    ``ord`` orders the events of a data set.  Every part of the state is an
    aggregate, so a hot data set is combined map-side and late events cannot
    change the answer.
    """
    failed = F.col("status") == "failed"
    last = lambda value, given: F.max_by(F.when(given, value), F.when(given, F.col("ord")))
    return events.groupBy("dataset_id").agg(
        F.max_by("status", "ord").alias("status"),
        F.max_by("ts", "ord").alias("updated_at"),
        last(F.col("progress"), F.col("progress").isNotNull()).alias("progress"),
        last(F.col("step"), F.col("step").isNotNull()).alias("step"),
        last(F.col("error_message"), failed & (F.col("error_message") != "")).alias("error_message"),
        F.nullif(F.count_if(failed), F.lit(0)).alias("retry_count"),
    )
