"""Shared helpers: mapping texts in Arrow batches, word tables, checkpoints, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.session import configure
from voxledger.session import shared_checkpoint as checkpoint

__all__ = [
    "annotate",
    "blank_words",
    "checkpoint",
    "column",
    "connected_components",
    "documents",
    "fold",
    "free_name",
    "held_out",
    "quoted",
    "union_find",
    "words",
]

TextFunction = Callable[[list[bytes | None]], dict[str, list]]


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, ignoring case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quoted(name))


def annotate(
    df: DataFrame,
    text: str,
    make: Callable[[], TextFunction],
    fields: T.StructType,
    name: str,
    keep: list[str] | None = None,
) -> DataFrame:
    """Rows of ``df`` with a struct column ``name`` computed from each whole text.

    ``make`` runs once per task and returns a function from a batch of texts (UTF-8 bytes or None) to
    a list per field. ``keep`` names the input columns that come back; all by default. Batches are
    bounded in bytes and no row moves to another task.
    """
    keep = df.columns if keep is None else keep
    extra = [] if text in keep else [text]
    source = df.select(*[column(c) for c in [*keep, *extra]])
    out = T.StructType([*[source.schema[c] for c in keep], T.StructField(name, fields)])
    arrow = _arrow_struct(fields)
    place, kept = source.columns.index(text), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            got = compute(texts)
            made = pa.StructArray.from_arrays(
                [pa.array(got[f.name], f.type) for f in arrow], fields=list(arrow)
            )
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(kept)], made],
                names=[*batch.schema.names[:kept], name],
            )

    return source.mapInArrow(run, out)


def _arrow_struct(fields: T.StructType) -> list[pa.Field]:
    kinds = {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
    }

    def kind(t: T.DataType) -> pa.DataType:
        if isinstance(t, T.ArrayType):
            return pa.list_(kind(t.elementType))
        if isinstance(t, T.StructType):
            return pa.struct([pa.field(f.name, kind(f.dataType)) for f in t])
        return kinds[t.simpleString()]

    return [pa.field(f.name, kind(f.dataType)) for f in fields]


#: Bytes that stand inside a word (ASCII letters and digits, and every byte of a non-ASCII character)
#: keep their place, with A-Z in lower case; every other byte becomes a space.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32
    for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; none for null."""
    return text.translate(WORD_BYTES).split() if text else []


#: A-Z in lower case; nothing else changes.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def blank_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words ``[^\\x20\\x09-\\x0D]+``: the white space that ``bytes.split`` knows."""
    return text.translate(LOWER_BYTES).split() if text else []


def fold(column_: Column) -> Column:
    """``crc32(id as text) mod 5``: 0 is the held-out fold. A null id falls in no fold: null."""
    return F.crc32(column_.cast("string").cast("binary")) % 5


def held_out(column_: Column) -> Column:
    """True for the held-out fold; a row with a null id is never learned from, so it is held out."""
    return F.coalesce(fold(column_) == 0, F.lit(True))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Smallest node reachable from every node of ``edges`` (``u``, ``v`` of one ordered type).

    Alternates two star operations until nothing changes: every node hooks its larger neighbours,
    then its smaller ones, to the smallest node it knows. A node with very many neighbours is a
    plain aggregate followed by an equality join, which adaptive execution splits. Returns
    ``node``, ``root`` for every node of an edge. Empty edges give an empty result. Raises if
    ``rounds`` are not enough (each round at least halves the longest remaining path).
    """
    links = checkpoint(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = _mark(links)
    for _ in range(rounds):
        if mark[0] == 0:
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u")
            .where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m")), F.struct(F.col("v").alias("u"), F.col("m")))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        links = checkpoint(small)
        before, mark = mark, _mark(links)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _mark(links: DataFrame) -> tuple:
    """Number of links and an order-free digest of them."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.crc32(F.concat_ws("-", "u", "v").cast("binary")))).first())


def union_find(n: int, left, right):
    """Component label (the smallest member) of ``n`` nodes joined by the pairs ``left``-``right``."""
    import numpy as np

    label = np.arange(n)
    left, right = np.asarray(left), np.asarray(right)
    while len(left):
        a, b = label[left], label[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        live = low != high
        if not live.any():
            break
        left, right = left[live], right[live]
        np.minimum.at(label, high[live], low[live])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label

