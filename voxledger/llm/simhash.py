"""SimHash near-duplicates by vantage-point trees.

Fingerprints are 64 bits, compared by Hamming distance. A routing tree, fitted to a bounded sample,
cuts the space into shards: each of its nodes has a vantage point and a radius, with the nearer
fingerprints inside. By the triangle bound, only a fingerprint whose distance to the vantage point
differs from the radius by less than the search distance can have a neighbour on the other side; such
a fingerprint is also sent there, as a query. Each shard goes on with a tree of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.llm.common import (
    annotate,
    blank_words,
    checkpoint,
    column,
    connected_components,
    free_name,
    union_find,
)

SHINGLE = 3
DISTANCE = 2
SHARD_ROWS = 8_192  # fingerprints a shard should have
MOST_SHARDS = 16_384  # beyond it shards grow; their own trees cut them further
SAMPLE_PER_SHARD = 16
LEAF = 512  # fingerprints compared directly
SEED = 42

RESULT = T.StructType([T.StructField("fingerprint", T.LongType())])


def fingerprint(tokens: list[bytes], shingle: int = SHINGLE) -> int:
    """SimHash as a signed 64-bit integer: a bit is 1 if set in over half of the shingle hashes.

    Shingles are ``shingle`` consecutive words joined by spaces, repeats included; fewer words are one
    shingle; none give zero. Hashes are XXH64 with seed 42.
    """
    n = len(tokens)
    if not n:
        return 0
    if n <= shingle:
        parts = [b" ".join(tokens)]
    else:
        joined = b" ".join(tokens)
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, n) + 1) - 1
        starts = [0, *(ends[: n - shingle] + 1).tolist()]
        parts = [joined[a:b] for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(parts), 65_536):
        block = parts[at : at + 65_536]
        h = np.fromiter((digest(p, SEED) for p in block), np.uint64, len(block))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(parts), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(
    docs: DataFrame,
    *,
    text: str = "text",
    shingle: int = SHINGLE,
    keep: list[str] | None = None,
    result: str = "simhash",
) -> DataFrame:
    """Rows with a struct ``result`` that holds the ``fingerprint`` of each whole text; a map.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case. Null and empty texts have fingerprint 0.
    """

    def make():
        return lambda texts: {"fingerprint": [fingerprint(blank_words(t), shingle) for t in texts]}

    return annotate(docs, text, make, RESULT, free_name(docs, result), keep)


class Tree:
    """A vantage-point tree in arrays; node 0 is the root, a negative child is leaf ``-child - 1``."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.point: list[int] = []
        self.radius: list[int] = []
        self.child: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(np.unique(sample), leaves)

    def _grow(self, values: np.ndarray, leaves: int) -> int:
        if leaves > 1:
            cut = split(values)
            if cut is not None:
                point, radius, inside = cut
                node = len(self.point)
                self.point.append(point)
                self.radius.append(radius)
                self.child.append([0, 0])
                self.child[node] = [
                    self._grow(values[inside], leaves // 2),
                    self._grow(values[~inside], leaves - leaves // 2),
                ]
                return node
        self.leaves += 1
        return -self.leaves

    def route(self, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index, leaf, home): each value's own leaf, and the leaves where it is only a query.

        A pair within ``distance`` that a node parts has its inner member at most ``distance - 1``
        below the radius; that member is sent to the outer side as a query, so the pair meets once.
        A query is in no leaf's home set, and two queries are not compared.
        """
        out = []
        todo = [(self.root, np.arange(len(values)), np.ones(len(values), bool))]
        while todo:
            node, rows, home = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, np.full(len(rows), -node - 1), home))
                continue
            d = hamming(values[rows], np.uint64(self.point[node]))
            radius = self.radius[node]
            inner, outer = self.child[node]
            inside = d <= radius
            # A query may have home neighbours on either side; a home row only outside of its own.
            near_out = inside & (d > radius - distance)
            near_in = ~inside & ~home & (d <= radius + distance)
            todo.append((inner, np.concatenate([rows[inside], rows[near_in]]), np.concatenate([home[inside], np.zeros(int(near_in.sum()), bool)])))
            todo.append((outer, np.concatenate([rows[~inside], rows[near_out]]), np.concatenate([home[~inside], np.zeros(int(near_out.sum()), bool)])))
        if not out:
            empty = np.zeros(0, np.int64)
            return empty, empty, np.zeros(0, bool)
        return tuple(np.concatenate([o[k] for o in out]) for k in range(3))


def hamming(values: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ point).astype(np.int64)


def split(values: np.ndarray) -> tuple[int, int, np.ndarray] | None:
    """A vantage point and the radius that halves ``values`` best; None if they can't be parted.

    Of a few candidates, taken at even steps, the one whose median distance has the fewest values
    next to it wins: those are the ones that must be looked for on both sides.
    """
    best = None
    for at in range(0, len(values), max(1, len(values) // 5)):
        d = hamming(values, values[at])
        radius = int(np.sort(d)[(len(d) - 1) // 2])
        for r in (radius, radius - 1):
            inside = d <= r
            n = int(inside.sum())
            if 0 < n < len(values):
                cost = (max(n, len(values) - n) / len(values), float(np.mean(inside & (d > r - DISTANCE))))
                score = cost[0] + cost[1]
                if best is None or score < best[0]:
                    best = (score, int(values[at]), r, inside)
    return best[1:] if best else None


def close_pairs(home: np.ndarray, queries: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs within ``distance`` among ``home``, and between ``home`` and ``queries``.

    Indices count home first, then queries. A tree cuts large sets; leaves are compared in blocks.
    """
    values = np.concatenate([home, queries])
    todo = [(np.arange(len(home)), np.arange(len(home), len(values)))]
    while todo:
        a, q = todo.pop()
        if not len(a):
            continue
        cut = split(values[a]) if len(a) > LEAF else None
        if cut is None:
            for at in range(0, len(a), LEAF):
                block = a[at : at + LEAF]
                d = np.bitwise_count(values[block][:, None] ^ values[a[at:]][None, :])
                i, j = np.nonzero(d <= distance)
                later = j > i
                yield block[i[later]], a[at:][j[later]]
                for qt in range(0, len(q), LEAF * 4):
                    part = q[qt : qt + LEAF * 4]
                    i, j = np.nonzero(np.bitwise_count(values[block][:, None] ^ values[part][None, :]) <= distance)
                    yield block[i], part[j]
            continue
        point, radius, inside = cut
        near = hamming(values[a], np.uint64(point))
        far = hamming(values[q], np.uint64(point))
        inner, outer = a[inside], a[~inside]
        todo.append((inner, q[far <= radius + distance]))
        todo.append((outer, np.concatenate([a[inside & (near > radius - distance)], q[far > radius - distance]])))


def fingerprint_links(
    values: DataFrame,
    *,
    distance: int = DISTANCE,
    shard_rows: int = SHARD_ROWS,
    most_shards: int = MOST_SHARDS,
    sample_per_shard: int = SAMPLE_PER_SHARD,
) -> DataFrame:
    """Links (``u``, ``v``) that join all distinct ``fingerprint`` values within ``distance``.

    Every pair within ``distance`` is found; of the pairs found in one shard, a spanning forest comes
    back, so dense groups give one link per value. The routing tree is fitted to a sample of at most
    ``most_shards * sample_per_shard`` values, which only sets how even the shards are.
    """
    total = values.count()
    shards = max(1, min(most_shards, -(-total // shard_rows)))
    wanted = shards * sample_per_shard
    sample = (
        values.where(F.pmod(F.xxhash64("fingerprint"), F.lit(max(1, total // (2 * wanted)))) == 0)
        .orderBy(F.xxhash64("fingerprint", F.lit(1)), "fingerprint")
        .limit(wanted)
        .collect()
    )
    tree = Tree(np.array([r[0] for r in sample], np.int64).view(np.uint64), shards)
    schema = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("home", T.BooleanType()), T.StructField("fingerprint", T.LongType())])
    arrow = pa.schema([("shard", pa.int32()), ("home", pa.bool_()), ("fingerprint", pa.int64())])

    def route(batches):
        for batch in batches:
            v = batch.column(0).to_numpy(zero_copy_only=False)
            index, leaf, home = tree.route(v.view(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(leaf.astype(np.int32)), pa.array(home), pa.array(v[index])], schema=arrow)

    def join(table: pa.Table) -> pa.Table:
        v = table.column("fingerprint").to_numpy().view(np.uint64)
        own = table.column("home").to_numpy(zero_copy_only=False).astype(bool)
        home, queries = np.unique(v[own]), np.unique(v[~own])
        both = np.concatenate([home, queries])
        label = np.arange(len(both))
        held, size = [], 0
        for i, j in close_pairs(home, queries, distance):
            if len(i):
                held.append((i, j))
                size += len(i)
            if size > 1_000_000:  # fold what is held into the forest
                held = [(np.arange(len(both)), label), *held]
                label = union_find(len(both), *(np.concatenate([h[k] for h in held]) for k in (0, 1)))
                held, size = [], 0
        if held:
            held = [(np.arange(len(both)), label), *held]
            label = union_find(len(both), *(np.concatenate([h[k] for h in held]) for k in (0, 1)))
        child = np.flatnonzero(label != np.arange(len(both)))
        return pa.table({"u": both[child].view(np.int64), "v": both[label[child]].view(np.int64)})

    routed = values.select("fingerprint").mapInArrow(route, schema)
    return routed.groupBy("shard").applyInArrow(join, "u bigint, v bigint")


def simhash_components(prints: DataFrame, id_col: str, *, distance: int = DISTANCE) -> DataFrame:
    """Rows of ``prints`` (with ``id_col`` and ``fingerprint``) with ``component_id`` and ``root``.

    ``component_id`` is the smallest id reachable by links of at most ``distance`` differing bits; of
    a component whose ids are all null it is null. ``root`` is the component's smallest fingerprint.
    Equal fingerprints are one node, so copies make no pairs. ``prints`` should be a stored table: it is
    read twice.
    """
    values = checkpoint(prints.groupBy("fingerprint").agg(F.min(id_col).alias("low")))
    roots = connected_components(fingerprint_links(values.select("fingerprint"), distance=distance))
    rooted = values.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "low", F.coalesce("root", "fingerprint").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = checkpoint(rooted.join(lowest, "root").select("fingerprint", "component_id", "root"))
    return prints.join(of, "fingerprint")


def _stored_prints(docs: DataFrame, id_col: str, text: str, shingle: int, *more: Column) -> DataFrame:
    """``id``, ``fingerprint`` and ``more`` columns of every row, at a checkpoint."""
    source = docs.select(column(id_col).alias("id"), column(text).alias("text"), *more)
    keep = [c for c in source.columns if c != "text"]
    prints = with_fingerprint(source, shingle=shingle, keep=keep, result="p")
    return checkpoint(prints.select(*keep, F.col("p.fingerprint").alias("fingerprint")))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row per input row: ``id_col``, ``fingerprint`` (a long) and ``component_id``.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows are rows of
    their own in one component. An empty table gives an empty result. Texts are mapped once, and only
    ids and fingerprints move.
    """
    found = simhash_components(_stored_prints(docs, id_col, text, shingle), "id", distance=distance)
    return found.select(F.col("id").alias(id_col), "fingerprint", "component_id")


def text_digest(text: Column) -> Column:
    return F.coalesce(F.sha2(text.cast("binary"), 256), F.lit(""))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each component: see ``keep_lowest``."""
    prints = _stored_prints(docs, id_col, text, shingle, text_digest(column(text)).alias("digest"))
    return keep_lowest(docs, simhash_components(prints, "id", distance=distance), id_col=id_col, text=text)


def keep_lowest(docs: DataFrame, found: DataFrame, *, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each ``root`` of ``found`` (``id``, ``digest``, ``root`` of every row):
    that with the smallest id, null ids last.

    Of rows of a component that repeat this id, the one with the smallest text digest stays, and one of
    rows that repeat both; rows of one id whose texts are not alike are two components. Columns stay as they are. After the join rows already lie by id and digest, so the
    choice among repeats moves nothing.
    """
    name, mark, key, place = (free_name(docs, n) for n in ("kept_id", "kept_digest", "text_digest", "place"))
    best = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "digest")).alias("b"))
    kept = best.select(F.col("b.id").alias(name), F.col("b.digest").alias(mark))
    keyed = docs.withColumn(key, text_digest(column(text)))
    same = column(id_col).eqNullSafe(F.col(name)) & (column(key) == F.col(mark))
    rows = keyed.join(kept, same, "left_semi")
    first = Window.partitionBy(column(id_col), column(key)).orderBy(F.lit(1))
    numbered = rows.withColumn(place, F.row_number().over(first)).where(column(place) == 1)
    return numbered.select(*[column(c) for c in docs.columns])


def simhash_table(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in 16 hex digits, component_id."""
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
