"""Exact nearest block embeddings by cosine, in one pass over the index.

The query side is an aggregate of bounded size (one vector per group); its size is checked. It travels
to the tasks; each multiplies its rows with it and keeps only its own best ``k`` per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

MOST_QUERY_NUMBERS = 4 << 20  # numbers in all query vectors together: 32 MiB


def _unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def _best_rows(index: DataFrame, ids: list, matrix: np.ndarray, k: int) -> DataFrame:
    """At most ``k`` rows per query and task."""
    shipped = index.sparkSession.sparkContext.broadcast((np.asarray(ids), _unit(matrix)))

    def best(batches):
        names, queries = shipped.value
        kept_score = np.empty((len(names), 0))
        kept_id = np.empty((len(names), 0), "int64")
        for batch in batches:
            vectors = batch.column("embedding")
            if not batch.num_rows:
                continue
            m = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), "float64").reshape(batch.num_rows, -1)
            score = np.hstack([kept_score, queries @ _unit(m).T])
            found = np.broadcast_to(np.asarray(batch.column("vec_id")), (len(names), batch.num_rows))
            number = np.hstack([kept_id, found])
            order = np.lexsort((number, -score), axis=1)[:, :k]
            kept_score = np.take_along_axis(score, order, 1)
            kept_id = np.take_along_axis(number, order, 1)
        n, width = kept_id.shape
        yield pa.RecordBatch.from_pydict(
            {
                "query_id": pa.array(np.repeat(names, width), pa.int64()),
                "vec_id": pa.array(kept_id.ravel(), pa.int64()),
                "score": pa.array(kept_score.ravel(), pa.float64()),
            }
        )

    return index.select("vec_id", "embedding").mapInArrow(best, "query_id bigint, vec_id bigint, score double")


def top_k(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` index vectors closest to each query vector, ties to the smaller id.

    ``queries`` must be a small aggregate: more than ``MOST_QUERY_NUMBERS`` numbers are an error, as is
    a query set that grows with the data. After the map step there are at most ``k`` rows per query and
    task, so the final ranking window is small. The width is that of the longest query vector; vectors
    and queries that are NULL, of another width, or hold NULLs take no part. For queries as a table of any
    size see ``ivf``.
    """
    width = queries.agg(F.max(F.size("embedding"))).first()[0] or 0
    whole = lambda df: df.where(F.coalesce((F.size("embedding") == width) & ~F.exists("embedding", lambda x: x.isNull()), F.lit(False)))
    index, queries = whole(index), whole(queries)
    numbers = queries.agg(F.sum(F.size("embedding"))).first()[0] or 0
    if numbers > MOST_QUERY_NUMBERS:
        raise ValueError(f"{numbers} numbers in the query vectors, {MOST_QUERY_NUMBERS} at most")
    rows = queries.select("query_id", "embedding").collect()
    if not rows:
        return index.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, score double, place int")
    found = _best_rows(index, [r["query_id"] for r in rows], np.asarray([r["embedding"] for r in rows], "float64"), k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def centroids(index: DataFrame, group: str) -> DataFrame:
    """Mean vector per group, averaged per dimension with partial aggregation."""
    dims = index.select(F.col(group).cast("bigint").alias("query_id"), F.posexplode("embedding").alias("d", "x"))
    mean = dims.groupBy("query_id", "d").agg(F.avg("x").alias("x"))
    return mean.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("p")).select(
        "query_id", F.col("p.x").alias("embedding")
    )
