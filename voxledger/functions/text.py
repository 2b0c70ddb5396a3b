"""Names, paths and number texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def timestamp_in_name(name: Column) -> Column:
    """First ``YYYYMMDD_HHMMSS`` of a name that mentions metadata, else NULL."""
    stamp = F.regexp_extract(name, r"([0-9]{8}_[0-9]{6})", 1)
    return F.when(name.contains("metadata") & (stamp != ""), stamp)


def safe_name(name: Column) -> Column:
    return F.replace(name, F.lit("/"), F.lit("_"))


def metadata_name(name: Column, stamp: Column) -> Column:
    return F.format_string("metadata_%s_%s.json", safe_name(name), stamp)


def crop_name(z: Column, y: Column, x: Column, stamp: Column) -> Column:
    return F.format_string("crop_z%d_y%d_x%d_%s", z.cast("bigint"), y.cast("bigint"), x.cast("bigint"), stamp)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """Base name without its last suffix; a leading dot is not a suffix."""
    name = base_name(path)
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]*$", "")


def swap_suffix(path: Column, old: str, new: str) -> Column:
    """Replace the suffix text wherever it occurs, as a plain text replace."""
    return F.replace(path, F.lit(old), F.lit(new))


def bucket_name(uri: Column) -> Column:
    """Third part of ``scheme://bucket/key``."""
    return F.element_at(F.split(uri, "/"), 3)


def object_key(uri: Column) -> Column:
    """Everything after the bucket."""
    parts = F.split(uri, "/")
    return F.array_join(F.slice(parts, F.lit(4), F.greatest(F.size(parts) - 3, F.lit(0))), "/")


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def duration_text(seconds: Column) -> Column:
    """``HH:MM:SS``."""
    s = seconds.cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(s / 3600).cast("bigint"),
        F.floor(s % 3600 / 60).cast("bigint"),
        (s % 60).cast("bigint"),
    )


def eta_text(seconds: Column) -> Column:
    """Hours or minutes with one decimal, else whole seconds."""
    return (
        F.when(seconds > 3600, F.concat(F.format_string("%.1f", seconds / 3600), F.lit("h")))
        .when(seconds > 60, F.concat(F.format_string("%.1f", seconds / 60), F.lit("m")))
        .otherwise(F.concat(F.format_string("%.0f", seconds), F.lit("s")))
    )


def parse_iso(value: Column) -> Column:
    """ISO-8601 text to TIMESTAMP; NULL where the text is not a timestamp."""
    return F.try_to_timestamp(F.replace(value, F.lit("Z"), F.lit("+00:00")))


def has_zone(value: Column) -> Column:
    return value.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$")
