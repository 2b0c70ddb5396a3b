"""Approximate nearest vectors by an inverted file.

Centroids are fitted to a bounded sample; every vector goes to the list of its nearest centroid. A query
looks at its nearest lists only, as many as a sample says are needed. Lists and the queries that want them are dealt out in parts by
measured counts, so neither a hot list nor many queries make a large group.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = 50_000  # vectors that centroids are fitted to, at most
LISTS = 4_096  # lists, at most
LIST_ROWS = 256  # vectors that a list should have
RECALL = 0.97  # of the nearest vectors in the sample, that the fitted number of probes finds
TRIALS = 512  # queries of the sample that the number of probes is fitted to
ROUNDS = 10
PART_ROWS = 8_192  # vectors or queries of one group


@dataclass(frozen=True)
class Centroids:
    """Unit vectors, one row per list, and how many lists a query should look at."""

    matrix: np.ndarray
    probes: int = 1

    def nearest(self, unit: np.ndarray, n: int) -> np.ndarray:
        """Numbers of the ``n`` nearest lists per row, the nearest first."""
        score = unit @ self.matrix.T
        if n == 1:
            return score.argmax(axis=1)[:, None]
        n = min(n, score.shape[1])
        some = np.argpartition(-score, n - 1, axis=1)[:, :n]
        order = np.argsort(-np.take_along_axis(score, some, 1), axis=1, kind="stable")
        return np.take_along_axis(some, order, 1)


def usable(vector: Column, width: int) -> Column:
    """True for a vector of ``width`` finite numbers that are not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce((F.size(vector) == width) & ~bad & some, F.lit(False))


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _matrix(column, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), "float64").reshape(-1, width)


def fit(
    index: DataFrame, vector: str, width: int, *, lists: int | None = None, sample: int = SAMPLE, k: int = 10, recall: float = RECALL, seed: int = 3
) -> Centroids:
    """Centroids from at most ``sample`` vectors, drawn by a hash of their numbers.

    ``lists`` defaults to one per ``LIST_ROWS`` vectors, ``LISTS`` at most. Refined in ``ROUNDS`` rounds on
    the driver; a centroid that loses all its vectors takes the one worst served. The number of probes is
    the least that finds a share ``recall`` of the ``k`` nearest vectors of ``TRIALS`` sampled ones.
    """
    good = index.where(usable(F.col(vector), width)).select(F.col(vector).cast("array<double>").alias("v"))
    total = good.count()
    lists = min(lists or LISTS, max(1, total // LIST_ROWS) if lists is None else lists, max(1, total))
    step = max(1, total // (2 * sample))
    rows = (
        good.where(F.pmod(F.xxhash64("v"), F.lit(step)) == 0).orderBy(F.xxhash64("v", F.lit(seed))).limit(sample).collect()
    )
    if not rows:
        return Centroids(np.zeros((1, width)))
    data = _unit(np.array([r["v"] for r in rows], "float64"))
    rng = np.random.default_rng(seed)
    matrix = data[rng.choice(len(data), min(lists, len(data)), replace=False)]
    for _ in range(ROUNDS):
        score = np.concatenate([data[a : a + 4096] @ matrix.T for a in range(0, len(data), 4096)])
        of, best = score.argmax(axis=1), score.max(axis=1)
        total_of = np.zeros_like(matrix)
        np.add.at(total_of, of, data)
        norm = np.linalg.norm(total_of, axis=1)
        empty = np.flatnonzero(norm == 0)
        total_of[empty] = data[np.argsort(best, kind="stable")[: len(empty)]]
        matrix = _unit(total_of)
    return Centroids(matrix, _probes(data, matrix, k, recall, rng))


def _probes(data: np.ndarray, matrix: np.ndarray, k: int, recall: float, rng: np.random.Generator) -> int:
    """How many nearest lists hold a share ``recall`` of the ``k`` nearest vectors, among sampled queries."""
    of = np.concatenate([(data[a : a + 4096] @ matrix.T).argmax(axis=1) for a in range(0, len(data), 4096)])
    turns = []
    for at in np.array_split(rng.choice(len(data), min(TRIALS, len(data)), replace=False), 16):
        near = np.argsort(-(data[at] @ data.T), axis=1, kind="stable")[:, :k]
        turn = np.argsort(np.argsort(-(data[at] @ matrix.T), axis=1, kind="stable"), axis=1)
        turns.append(np.take_along_axis(turn, of[near], 1).ravel())
    return int(np.quantile(np.concatenate(turns), recall, method="higher")) + 1


def in_lists(rows: DataFrame, id_col: str, vector: str, centroids: Centroids, width: int, probes: int = 1) -> DataFrame:
    """``id``, ``list`` and ``vector`` (unit, doubles) of every usable vector in its ``probes`` nearest lists; a map."""
    sent = rows.sparkSession.sparkContext.broadcast(centroids)  # at most LISTS vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column(1), width))
            near = sent.value.nearest(unit, probes)
            n = near.shape[1]
            again = np.repeat(unit, n, axis=0)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.asarray(batch.column(0)), n), pa.int64()),
                    pa.array(near.ravel(), pa.int32()),
                    pa.ListArray.from_arrays(np.arange(0, again.size + 1, width, dtype="int32"), pa.array(again.ravel())),
                ],
                names=["id", "list", "vector"],
            )

    good = rows.where(usable(F.col(vector), width)).select(F.col(id_col).cast("bigint"), F.col(vector).cast("array<double>"))
    return good.mapInArrow(run, "id bigint, list int, vector array<double>")


def _parts(listed: DataFrame) -> dict[int, int]:
    """Parts per list, by measured rows; a number per list at most."""
    counts = listed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / PART_ROWS).cast("int").alias("n")).where("n > 1").collect()
    return {r["list"]: r["n"] for r in counts}


def _part_count(parts: dict[int, int]) -> Column:
    if not parts:
        return F.lit(1)
    table = F.create_map(*[F.lit(x) for item in parts.items() for x in item])
    return F.coalesce(F.try_element_at(table, F.col("list")), F.lit(1))


def search(
    index: DataFrame, queries: DataFrame, k: int, centroids: Centroids, *, id_col: str = "vec_id", query_col: str = "query_id",
    vector: str = "embedding", probes: int | None = None,
) -> DataFrame:
    """``query_id``, ``vec_id``, ``score`` (cosine) and ``place`` of the ``k`` best vectors in each query's lists.

    Ties go to the smaller id. Vectors and queries that are NULL, of another width, zero, or hold NULL or
    non-finite numbers take no part; a query finds fewer than ``k`` if its lists hold fewer. Every group
    compares one part of a list with one part of its queries and keeps ``k`` rows per query, so the last
    ranking sees at most ``k`` rows per query and part.
    """
    width = centroids.matrix.shape[1]
    held = in_lists(index, id_col, vector, centroids, width)
    asked = in_lists(queries, query_col, vector, centroids, width, probes or centroids.probes)
    of_index, of_query = _part_count(_parts(held)), _part_count(_parts(asked))
    every = lambda n: F.explode(F.sequence(F.lit(0), n.cast("int") - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    left = held.select("*", own(of_index).alias("a"), every(of_query).alias("b"))
    right = asked.select("*", every(of_index).alias("a"), own(of_query).alias("b"))

    def compare(vectors: pa.Table, wanted: pa.Table) -> pa.Table:
        ids, names = vectors.column("id").to_numpy(), wanted.column("id").to_numpy()
        if not len(ids) or not len(names):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        m, q = (_matrix(t.column("vector").combine_chunks(), width) for t in (vectors, wanted))
        out = []
        for at in range(0, len(names), 512):
            score = q[at : at + 512] @ m.T
            order = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :k]
            out.append((np.repeat(names[at : at + 512], order.shape[1]), ids[order].ravel(), np.take_along_axis(score, order, 1).ravel()))
        return pa.table({name: np.concatenate([o[i] for o in out]) for i, name in enumerate(("query_id", "vec_id", "score"))})

    keys = ["list", "a", "b"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
