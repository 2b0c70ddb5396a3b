"""Staging of costly columns and struct updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters use without recomputing it.

    A plain projection lets the optimizer copy the expression into every
    filter pushed below it.  Filters on a generator's output stay above the
    generator, so a one-element generator holds the value.
    """
    keep = [c for c in df.columns if c != name]
    return df.select(*keep, F.explode_outer(F.array(value)).alias(name))


def replace_fields(df: DataFrame, column: str, changes: dict[str, Column]) -> DataFrame:
    """Set dotted fields of a struct column in one projection.

    Missing parents and fields are created.  The struct is rebuilt once from
    field references, so its plan stays linear in the number of fields.
    """

    def build(kind: T.DataType | None, path: str, prefix: str) -> Column:
        fields = {f.name: f.dataType for f in kind.fields} if isinstance(kind, T.StructType) else {}
        inside = [p[len(prefix) :] for p in changes if p.startswith(prefix)]
        for name in inside:
            fields.setdefault(name.split(".")[0], None)
        out = []
        for name, field_kind in fields.items():
            full = f"{prefix}{name}"
            if full in changes:
                value = changes[full]
            elif any(p.startswith(f"{full}.") for p in changes):
                value = build(field_kind, f"{path}.{name}", f"{full}.")
            else:
                value = F.col(f"{path}.{name}")
            out.append(value.alias(name))
        return F.struct(*out)

    return df.withColumn(column, build(df.schema[column].dataType, column, ""))


def struct_of(fields: dict[str, Column]) -> Column:
    """A nested struct from dotted names, in the order given."""
    heads: dict[str, dict[str, Column] | Column] = {}
    for path, value in fields.items():
        head, _, rest = path.partition(".")
        if rest:
            heads.setdefault(head, {})[rest] = value
        else:
            heads[head] = value
    return F.struct(*[(struct_of(v) if isinstance(v, dict) else v).alias(k) for k, v in heads.items()])
