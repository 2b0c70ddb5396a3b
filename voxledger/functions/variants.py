"""Helpers on VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def step(path: str) -> str:
    """``a.b.c`` as a VARIANT path."""
    return "$" + "".join(f".{part}" for part in path.split(".") if part)


def leaf(v: Column, path: str) -> Column:
    """Value at a dotted path: SQL NULL when absent, a VARIANT null for JSON null."""
    return F.try_variant_get(v, step(path), "variant")


def as_text(v: Column, path: str = "") -> Column:
    return F.try_variant_get(v, step(path), "string")


def is_object(v: Column, path: str = "") -> Column:
    """A cheap object test: only objects can be read as a struct."""
    return F.try_variant_get(v, step(path), "struct<_:variant>").isNotNull()


def object_keys(v: Column, path: str = "") -> Column:
    return F.map_keys(F.try_variant_get(v, step(path), "map<string,variant>"))


def elements(v: Column, path: str = "") -> Column:
    return F.try_variant_get(v, step(path), "array<variant>")


def is_number(type_name: Column) -> Column:
    return type_name.isin("BIGINT", "DOUBLE", "FLOAT") | type_name.startswith("DECIMAL")


def lookup(v: Column, path: str, type_name: str, default) -> Column:
    """Dotted lookup with a default, also used when a step is not indexable."""
    return F.coalesce(F.try_variant_get(v, step(path), type_name), F.lit(default).cast(type_name))
