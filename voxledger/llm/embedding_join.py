"""Embedding near-duplicates by an epsilon grid order join.

Vectors are scaled to length 1, so that a cosine of at least ``c`` is a distance of at most
``sqrt(2 - 2c)``, the epsilon. They are projected on their leading principal dimensions and sorted by
grid cells of one epsilon, first dimension first; the length of what the projection leaves out is one more
coordinate of every bound. The sorted sequence is cut into intervals; two
intervals are joined unless their boxes are provably further apart than epsilon, and a join cuts its
intervals in halves and skips provably distant halves again. Where two intervals lie provably within
epsilon, all their pairs are counted without being compared.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxledger.llm.common import checkpoint, column, connected_components, union_find

COSINE = 0.95
DIMENSIONS = 16  # leading principal dimensions of the grid
INTERVAL_ROWS = 2_048  # vectors that a sequence interval has at least, if there are as many
INTERVAL_BYTES = 8 << 20  # of its vectors, at most
FEW_INTERVALS = 16  # a table of fewer full intervals is cut in so many, for the sake of its tasks
MOST_INTERVALS = 16_384  # beyond it intervals grow
LEAF = 512  # vectors compared directly
ROUGH = 1e-4  # the same for projections in single precision
SLACK = 1e-9  # rounding allowance of every bound: bounds decide only beyond it


def unit_vectors(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``row``, ``id``, ``unit`` (doubles of length 1, or null) of every row.

    A vector that is null or empty, has length zero, or a null or non-finite component has no unit.
    """
    v = column(vector).cast("array<double>")
    # The largest component is taken out first, so that squares neither overflow nor vanish.
    bad = v.isNull() | (F.size(v) == 0) | F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    top = F.when(~bad, F.aggregate(v, F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x))))
    out = vectors.select(column(id_col).alias("id"), v.alias("v"), top.alias("top"))
    scaled = F.when(F.col("top") > 0, F.transform("v", lambda x: x / F.col("top")))
    out = out.select("id", scaled.alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    return out.select("id", "v", norm.alias("norm")).select(
        "id", F.when(F.col("v").isNotNull(), F.transform("v", lambda x: x / F.col("norm"))).alias("unit")
    )


def principal_dimensions(distinct: DataFrame, width: int, dimensions: int) -> np.ndarray:
    """The leading eigenvectors of the second moments of ``unit``, largest first (width x k).

    Every task sums the outer products of its vectors; the sums (width squared numbers, whatever
    the rows) are added on the driver.
    """

    def moments(batches):
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column(0), width)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["m"])

    rows = distinct.select("unit").mapInArrow(moments, "m array<double>")
    total = np.zeros((width, width))
    parts = (
        rows.select(F.posexplode("m").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
    )
    for i, x in parts:
        total[i // width, i % width] = x
    _, vectors = np.linalg.eigh((total + total.T) / 2)
    return np.ascontiguousarray(vectors[:, ::-1][:, :dimensions])


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """An Arrow list column as rows of ``width`` numbers."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def projections(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Projections on the axes, and the length of the rest of each vector.

    Two vectors are at least as far apart as these rows are: the rests differ by no less than their lengths.
    """
    p = x @ axes
    rest = np.sqrt(np.maximum(0, (x**2).sum(1) - (p**2).sum(1)))
    return np.hstack([p, rest[:, None]])


class Interval:
    """A run of vectors with what bounds its distances: a box of projections and a ball."""

    def __init__(self, x: np.ndarray, p: np.ndarray, rows: np.ndarray):
        self.x, self.p, self.rows = x, p, rows
        self.single = p.astype(np.float32)
        self.square = (self.single**2).sum(1)
        self.low, self.high = p.min(0), p.max(0)
        self.centre = x.mean(0)
        self.reach = float(np.sqrt(((x - self.centre) ** 2).sum(1).max()))
        self._halves: tuple[Interval, Interval] | None = None

    def halves(self) -> tuple[Interval, Interval]:
        if self._halves is None:
            m = len(self.rows) // 2
            self._halves = (
                Interval(self.x[:m], self.p[:m], self.rows[:m]),
                Interval(self.x[m:], self.p[m:], self.rows[m:]),
            )
        return self._halves


def box_gap(low_a, high_a, low_b, high_b) -> float:
    """Smallest distance of two boxes, a lower bound of any distance between their vectors."""
    return float(np.sqrt((np.maximum(0, np.maximum(low_a - high_b, low_b - high_a)) ** 2).sum()))


def join_intervals(a: Interval, b: Interval | None, cosine: float, links: np.ndarray, weight: np.ndarray, forest) -> None:
    """Add to ``links`` the weights of the partners of every row of ``a`` and ``b`` (None: within
    ``a``); ``forest`` collects pairs that join what is linked."""
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine))
    todo = [(a, b)]
    while todo:
        a, b = todo.pop()
        if b is not None:
            if box_gap(a.low, a.high, b.low, b.high) > epsilon + SLACK:
                continue
            apart = float(np.sqrt(((a.centre - b.centre) ** 2).sum()))
            if apart - a.reach - b.reach > epsilon + SLACK:
                continue
            if apart + a.reach + b.reach < epsilon - SLACK:
                links[a.rows] += weight[b.rows].sum()
                links[b.rows] += weight[a.rows].sum()
                forest(a.rows, np.full(len(a.rows), b.rows[0]))
                forest(b.rows, np.full(len(b.rows), a.rows[0]))
                continue
        elif 2 * a.reach < epsilon - SLACK:
            links[a.rows] += weight[a.rows].sum() - weight[a.rows]
            forest(a.rows, np.full(len(a.rows), a.rows[0]))
            continue
        if len(a.rows) <= LEAF and (b is None or len(b.rows) <= LEAF):
            i, j = compare(a, a if b is None else b, cosine, epsilon)
            if b is None:
                i, j = i[i < j], j[i < j]
                b = a
            if len(i):
                i, j = a.rows[i], b.rows[j]
                links += np.bincount(i, weight[j], len(links)).astype(np.int64)
                links += np.bincount(j, weight[i], len(links)).astype(np.int64)
                forest(i, j)
            continue
        if b is None:
            one, two = a.halves()
            todo += [(one, None), (two, None), (one, two)]
        elif len(a.rows) >= len(b.rows):
            todo += [(h, b) for h in a.halves()]
        else:
            todo += [(a, h) for h in b.halves()]


def compare(a: Interval, b: Interval, cosine: float, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs with a cosine of at least ``cosine``, in double precision.

    Pairs whose projections are provably further apart than epsilon are skipped; where many are left,
    the whole block is multiplied.
    """
    gap = a.square[:, None] + b.square[None, :] - 2 * (a.single @ b.single.T)
    i, j = np.nonzero(gap <= epsilon**2 + ROUGH)
    if len(i) * 8 > gap.size:
        return np.nonzero(a.x @ b.x.T >= cosine)
    near = np.einsum("ij,ij->i", a.x[i], b.x[j]) >= cosine
    return i[near], j[near]


class Forest:
    """Links folded into a spanning forest whenever many are held."""

    def __init__(self, n: int):
        self.label, self.held, self.size, self.n = np.arange(n), [], 0, n

    def __call__(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            self.held.append((i, j))
            self.size += len(i)
            if self.size > 1_000_000:
                self.fold()

    def fold(self) -> np.ndarray:
        if self.held:
            held = [(np.arange(self.n), self.label), *self.held]
            self.label = union_find(self.n, *(np.concatenate([h[k] for h in held]) for k in (0, 1)))
            self.held, self.size = [], 0
        return self.label


def grid_links(
    nodes: DataFrame,
    width: int,
    *,
    cosine: float = COSINE,
    dimensions: int = DIMENSIONS,
    interval_rows: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(links, partners) of distinct unit vectors of one width: ``nodes`` has ``node``, ``n``, ``unit``.

    ``links`` (``u``, ``v``) join what is linked, a spanning forest per joined pair of intervals;
    ``partners`` has ``node`` and ``weight``, the number of vectors (``n`` of each) linked to it.

    The plan of the join is a table of intervals with their boxes, at most ``MOST_INTERVALS`` rows of
    fixed size; an interval goes to each task whose partner may be near.
    """
    axes = principal_dimensions(nodes, width, min(dimensions, width))
    k = axes.shape[1]
    epsilon = math.sqrt(max(0.0, 2 - 2 * cosine))

    def project(batches):
        for batch in batches:
            x = matrix(batch.column(2), width)
            p = projections(x, axes)
            cells = np.floor(p[:, :k] / epsilon).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, as_lists(p), as_lists(cells)], names=["node", "n", "unit", "p", "cell"]
            )

    placed = checkpoint(
        nodes.select("node", "n", "unit").mapInArrow(
            project, "node bigint, n bigint, unit array<double>, p array<double>, cell array<bigint>"
        )
    )
    total = placed.count()
    full = min(max(1, INTERVAL_BYTES // (8 * width)), max(INTERVAL_ROWS, -(-total // FEW_INTERVALS)))
    rows = max(interval_rows or full, -(-total // MOST_INTERVALS))
    parts = max(1, -(-total // rows))
    # The grid order: cells dimension by dimension, then the first projection within a cell.
    order = [*[F.col("cell")[i] for i in range(k)], *[F.col("p")[i] for i in range(k)], F.col("node")]
    ordered = checkpoint(
        placed.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .select("node", "n", "unit", "p", F.monotonically_increasing_id().alias("at"))
    )
    # Rows per partition, then every row's place in the whole order, then its interval.
    sizes = dict(ordered.groupBy(F.shiftright("at", 33).alias("part")).count().collect())
    first, seen = {}, 0
    for part in sorted(sizes):
        first[part] = seen
        seen += sizes[part]
    begins = np.array([first.get(i, 0) for i in range(max(first, default=0) + 1)], np.int64)

    def number(batches):
        for batch in batches:
            at = batch.column(4).to_numpy(zero_copy_only=False)
            interval = (begins[at >> 33] + (at & ((1 << 33) - 1))) // rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(interval.astype(np.int32)), batch.column(3)],
                names=["node", "n", "unit", "interval", "p"],
            )

    numbered = ordered.mapInArrow(number, "node bigint, n bigint, unit array<double>, interval int, p array<double>")
    boxes = (
        numbered.groupBy("interval")
        .agg(*[F.min(F.col("p")[i]).alias(f"l{i}") for i in range(k + 1)], *[F.max(F.col("p")[i]).alias(f"h{i}") for i in range(k + 1)])
        .orderBy("interval")
        .collect()
    )
    ids = np.array([b["interval"] for b in boxes], np.int64)
    low, high = (np.array([[b[f"{side}{i}"] for i in range(k + 1)] for b in boxes]).reshape(-1, k + 1) for side in "lh")

    def partners_of(place: int) -> np.ndarray:
        gap = np.maximum(0, np.maximum(low[place] - high, low - high[place]))
        near = (gap**2).sum(1) <= (epsilon + SLACK) ** 2
        return np.flatnonzero(near)

    def deal(batches):
        """Each vector to the tasks (i, j), i <= j, of its interval and every near one."""
        known: dict[int, list[int]] = {}
        for batch in batches:
            interval = batch.column(3).to_numpy(zero_copy_only=False)
            for i in np.unique(interval):
                if int(i) not in known:
                    me = int(np.searchsorted(ids, i))
                    known[int(i)] = [int(ids[o]) for o in partners_of(me)]
                take = batch.filter(pa.array(interval == i))
                for o in known[int(i)]:
                    pair = pa.array([f"{min(i, o)}-{max(i, o)}"] * take.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [pair, take.column(3), take.column(0), take.column(1), take.column(2), take.column(4)],
                        names=["pair", "interval", "node", "n", "unit", "p"],
                    )

    schema = "pair string, interval int, node bigint, n bigint, unit array<double>, p array<double>"
    dealt = numbered.mapInArrow(deal, schema)

    def join(table: pa.Table) -> pa.Table:
        first = [int(x) for x in table.column("pair")[0].as_py().split("-")]
        interval = table.column("interval").to_numpy()
        table = table.combine_chunks()
        x = matrix(_one(table.column("unit")), width)
        p = matrix(_one(table.column("p")), k + 1)
        node = table.column("node").to_numpy()
        weight = table.column("n").to_numpy().astype(np.int64)
        links = np.zeros(len(node), np.int64)
        forest = Forest(len(node))
        sides = []
        for i in dict.fromkeys(first):
            rows = np.flatnonzero(interval == i)
            rows = rows[np.lexsort((node[rows], *p[rows].T[::-1], *np.floor(p[rows] / epsilon).T[::-1]))]
            sides.append(Interval(x[rows], p[rows], rows) if len(rows) else None)
        if len(sides) == 1:
            join_intervals(sides[0], None, cosine, links, weight, forest)
        elif all(s is not None for s in sides):
            join_intervals(sides[0], sides[1], cosine, links, weight, forest)
        label = forest.fold()
        some = np.flatnonzero(links > 0)
        return pa.table({"node": node[some], "weight": links[some], "to": node[label[some]]})

    found = checkpoint(dealt.groupBy("pair").applyInArrow(join, "node bigint, weight bigint, to bigint"))
    partners = found.groupBy("node").agg(F.sum("weight").alias("weight"))
    links = found.where(F.col("node") != F.col("to")).select(F.col("node").alias("u"), F.col("to").alias("v"))
    return links, partners


def narrow_links(nodes: DataFrame, *, cosine: float = COSINE, dimensions: int = DIMENSIONS) -> tuple[DataFrame, DataFrame]:
    """(links, partners) as of ``grid_links`` for widths of few vectors: each width is one interval of its own.

    The first components stand in for principal dimensions.
    """

    def join(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, weight = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "n"))
        x = matrix(_one(table.column("unit")), len(table.column("unit")[0]))
        order = np.lexsort((node, *x.T[:dimensions][::-1]))
        x, node, weight = x[order], node[order], weight[order]
        links, forest = np.zeros(len(node), np.int64), Forest(len(node))
        p = projections(x, np.eye(x.shape[1])[:, :dimensions])
        join_intervals(Interval(x, p, np.arange(len(node))), None, cosine, links, weight, forest)
        label, some = forest.fold(), np.flatnonzero(links > 0)
        return pa.table({"node": node[some], "weight": links[some], "to": node[label[some]]})

    grouped = nodes.select("node", "n", "unit", F.size("unit").alias("width")).groupBy("width")
    found = checkpoint(grouped.applyInArrow(join, "node bigint, weight bigint, to bigint"))
    links = found.where("node <> to").select(F.col("node").alias("u"), F.col("to").alias("v"))
    return links, found.groupBy("node").agg(F.sum("weight").alias("weight"))


def _one(chunked: pa.ChunkedArray) -> pa.Array:
    return chunked.chunk(0) if chunked.num_chunks == 1 else pa.concat_arrays(chunked.chunks)


def as_lists(x: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32) if x.shape[1] else np.zeros(len(x) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.ravel()))


def embedding_near_duplicates(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector: str = "embedding",
    cosine: float = COSINE,
    dimensions: int = DIMENSIONS,
    interval_rows: int | None = None,
) -> DataFrame:
    """One row per input row: ``id``, ``n_links`` and ``component_id``.

    ``n_links`` counts the other rows whose cosine is at least ``cosine`` (positive), in double
    precision; ``component_id`` is the smallest id reachable by links, itself included. Equal
    directions are one node with a number of rows, so copies make no pairs. Vectors of different
    widths are not linked: widths with many vectors have a grid each, all others share one plan, in which
    a width is one interval. A vector that is null, empty, zero, or has null or non-finite components
    links with nothing and is its own component. Repeated ids are rows of their own. A null id takes
    part in links; a component of null ids only has a null ``component_id``. An empty table gives an
    empty result.
    """
    units = checkpoint(unit_vectors(vectors, id_col, vector).withColumn("key", F.sha2(F.to_json(F.struct("unit")), 256)))
    nodes = checkpoint(
        units.where(F.col("unit").isNotNull())
        .groupBy("key")
        .agg(F.count("*").alias("n"), F.min("id").alias("low"), F.first("unit").alias("unit"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    counts = nodes.groupBy(F.size("unit").alias("width")).count()
    # Fewer widths than intervals: each holds more than one interval's least number of vectors.
    wide = [r["width"] for r in counts.where(F.col("count") > (interval_rows or INTERVAL_ROWS)).orderBy("width").collect()]
    links, partners = narrow_links(nodes.where(~F.size("unit").isin(wide)), cosine=cosine, dimensions=dimensions)
    for width in wide:
        own = nodes.where(F.size("unit") == width)
        a, b = grid_links(own, width, cosine=cosine, dimensions=dimensions, interval_rows=interval_rows)
        links, partners = links.unionByName(a), partners.unionByName(b)
    alone = units.select("id", "key", "unit")
    roots = connected_components(links)
    rooted = (
        nodes.select("key", "node", "n", "low")
        .join(roots.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        .join(partners.withColumnRenamed("node", "with"), F.col("node") == F.col("with"), "left")
        .select("key", "n", "low", F.coalesce("root", "node").alias("root"), F.coalesce("weight", F.lit(0)).alias("weight"))
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    of = rooted.join(lowest, "root").select(
        F.col("key").alias("node_key"), (F.col("weight") + F.col("n") - 1).alias("n_links"), "component_id"
    )
    linked = alone.where(F.col("unit").isNotNull()).join(checkpoint(of), F.col("key") == F.col("node_key"))
    return linked.select("id", "n_links", "component_id").unionByName(
        alone.where(F.col("unit").isNull()).select(
            "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
        )
    )


def embedding_table(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and whether the vector is the one kept of its component."""
    found = embedding_near_duplicates(vectors)
    return found.select(
        F.col("id").alias("vec_id"),
        F.col("n_links").cast("long").alias("n_links"),
        F.col("component_id").cast("long").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )

