"""Open documents (VARIANT) as paths and leaves, and merged, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxledger.functions import variants as V

#: Levels of objects and lists that the expressions below follow; deeper parts count as one leaf.
MOST_LEVELS = 8

LEAVES = "array<struct<path:string,leaf:string>>"


def leaves(v: Column, levels: int = MOST_LEVELS, path: Column | None = None) -> Column:
    """(path, leaf as JSON text) of every scalar, empty object and empty list below ``v``.

    Steps of a path are joined by dots; a list adds ``[]``, so the place in a list does not count. Parts
    below ``levels`` are one leaf with their text. NULL has no leaves.
    """
    path = F.lit("") if path is None else path
    one = F.array(F.struct(path.alias("path"), F.to_json(v).alias("leaf")))
    if levels == 0:
        return one
    step = lambda key: F.when(path == "", key).otherwise(F.concat(path, F.lit("."), key))
    fields = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    items = F.try_variant_get(v, "$", "array<variant>")
    return (
        F.when(v.isNull(), F.array().cast(LEAVES))
        .when(F.size(fields) > 0, F.flatten(F.transform(fields, lambda e: leaves(e["value"], levels - 1, step(e["key"])))))
        .when(F.size(items) > 0, F.flatten(F.transform(items, lambda x: leaves(x, levels - 1, F.concat(path, F.lit("[]"))))))
        .otherwise(one)
    )


def tokens(v: Column, levels: int = MOST_LEVELS) -> Column:
    """The sorted, distinct ``path=value`` tokens of a document."""
    return F.array_sort(F.array_distinct(F.transform(leaves(v, levels), lambda x: F.concat(x["path"], F.lit("="), x["leaf"]))))


def merged(base: Column, extra: Column, levels: int = MOST_LEVELS) -> Column:
    """Objects merged key by key; anything else on the right replaces the left.

    A JSON null is a value and replaces too; with one side NULL the other is the result. Objects below
    ``levels`` are not merged but NULL: see ``nested_both``.
    """
    if levels == 0:
        both = V.is_object(base) & V.is_object(extra)
        return F.when(both, F.lit(None).cast("variant")).otherwise(F.coalesce(extra, base))
    left, right = (F.try_variant_get(x, "$", "map<string,variant>") for x in (base, extra))
    entries = F.map_zip_with(
        left, right, lambda _, a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(merged(a, b, levels - 1))
    )
    both = V.is_object(base) & V.is_object(extra)
    return F.when(both, F.to_variant_object(entries)).otherwise(F.coalesce(extra, base))


def merge_texts(df: DataFrame, base: str, extra: str, levels: int = MOST_LEVELS) -> DataFrame:
    """``merged`` (JSON text, keys sorted) and ``merge_error`` of two text columns, without Python.

    With one text NULL the other is the result. A text that is not JSON, or a document with objects on both
    sides below ``levels``, gives NULL and its reason: one bad record never fails the run.
    """
    left, right = F.try_parse_json(base), F.try_parse_json(extra)
    parsed = df.withColumns({"_base": left, "_extra": right})
    broken = (
        F.when(F.col(base).isNotNull() & F.col("_base").isNull(), F.concat(F.lit("base"), F.lit(" is not JSON")))
        .when(F.col(extra).isNotNull() & F.col("_extra").isNull(), F.concat(F.lit("extra"), F.lit(" is not JSON")))
        .when(nested_both(F.col("_base"), F.col("_extra"), levels), F.lit(f"objects below {levels} levels"))
    )
    out = parsed.withColumn("merge_error", broken)
    value = F.when(F.col("merge_error").isNull(), F.to_json(merged(F.col("_base"), F.col("_extra"), levels)))
    return out.withColumn("merged", value).drop("_base", "_extra")


def nested_both(base: Column, extra: Column, levels: int) -> Column:
    """True if both documents have an object at one path, ``levels`` steps down."""
    both = V.is_object(base) & V.is_object(extra)
    if levels == 0:
        return F.coalesce(both, F.lit(False))
    left, right = (F.try_variant_get(x, "$", "map<string,variant>") for x in (base, extra))
    below = F.map_zip_with(left, right, lambda _, a, b: nested_both(a, b, levels - 1))
    return F.coalesce(both & F.exists(F.map_values(below), lambda x: x), F.lit(False))
