"""Queries over array inventories: size classes, routes, chunk plans, grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.functions.arrays import cells, product, text_of
from voxledger.plans import chunking as P
from voxledger.sources import tables as T

QUERIES = {}
ORACLES: dict[str, str] = {}

_ARRAYS = """
p AS (
  SELECT p_partkey, p_brand, p_size, p_size * 12 AS s0, 64 + (p_partkey * 37) % 2500 AS s1, 64 + (p_partkey * 53) % 2600 AS s2,
         CASE p_partkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 4 WHEN 3 THEN 8 ELSE 4 END AS itemsize
  FROM part
),
arr AS (
  SELECT *, 'fib/s' || p_partkey AS array_name, least(s0, 64 + (p_partkey % 3) * 32) AS c0, least(s1, 128) AS c1, least(s2, 256) AS c2,
         CAST(s0 * s1 * s2 AS DOUBLE) * itemsize / 1048576 AS mb FROM p
)"""


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@register(
    f"""WITH {_ARRAYS} SELECT CASE WHEN mb < 50 THEN 'SMALL' WHEN mb < 200 THEN 'MEDIUM' ELSE 'LARGE' END AS size_class,
        count(*) AS arrays, round(sum(mb), 3) AS mb FROM arr GROUP BY 1"""
)
def size_class(spark: SparkSession, sf: str) -> DataFrame:
    arrays = T.part_arrays(spark, sf)
    return arrays.groupBy(P.size_class(F.col("mb")).alias("size_class")).agg(
        F.count(F.lit(1)).alias("arrays"), F.round(F.sum("mb"), 3).alias("mb")
    )


@register(
    f"""WITH {_ARRAYS} SELECT array_name,
          CASE WHEN mb > 2000 THEN 'downsample' WHEN mb >= 200 THEN 'stream' WHEN mb >= 50 THEN 'chunked' ELSE 'direct' END AS strategy,
          CASE WHEN mb > 2000 THEN 32 WHEN mb >= 200 THEN 64 WHEN mb >= 50 THEN 8 ELSE 32 END AS chunk_mb,
          CASE WHEN mb > 2000 THEN 'skipped' ELSE 'stream' END AS skip_mode
        FROM arr"""
)
def route(spark: SparkSession, sf: str) -> DataFrame:
    arrays = T.part_arrays(spark, sf)
    skip = F.when(F.col("mb") > 2000, P.route(F.col("mb"), 2000, "skip")[0]).otherwise(F.lit("stream"))
    return arrays.select("array_name", *P.route(F.col("mb"), 2000, "downsample"), skip.alias("skip_mode"))


@register(
    f"""WITH {_ARRAYS} SELECT round(sum(mb) FILTER (mb <= 2000), 3) AS normal_mb, round(sum(mb) FILTER (mb > 2000), 3) AS skipped_mb,
          round(sum(mb), 3) AS total_mb, count(*) FILTER (mb > 2000) AS skipped FROM arr"""
)
def size_totals(spark: SparkSession, sf: str) -> DataFrame:
    labelled = T.part_arrays(spark, sf).withColumn("label", P.split_label(F.col("mb"), 2000, "skip"))
    part = lambda name: F.round(F.sum(F.when(F.col("label") == name, F.col("mb"))), 3)
    return labelled.agg(
        part("normal").alias("normal_mb"), part("skipped").alias("skipped_mb"),
        F.round(F.sum("mb"), 3).alias("total_mb"), F.count_if(F.col("label") == "skipped").alias("skipped"),
    )


@register(f"WITH {_ARRAYS} SELECT array_name, mb > 2000 AS special, round(mb, 6) AS mb FROM arr ORDER BY special, mb, array_name")
def processing_order(spark: SparkSession, sf: str) -> DataFrame:
    labelled = T.part_arrays(spark, sf).withColumn("special", P.split_label(F.col("mb"), 2000, "stream") == "special")
    normal, special = labelled.where("NOT special"), labelled.where("special")
    ordered = normal.unionByName(special).orderBy("special", "mb", "array_name")
    return ordered.select("array_name", "special", F.round("mb", 6).alias("mb"))


def _cut_sql(axis: int) -> str:
    d, c = f"s{axis}", f"c{axis}"
    return f"""least({c}, CASE
        WHEN mb >= 200 THEN CASE WHEN {d} > 1024 THEN greatest(128, {d} // 4) WHEN {d} > 256 THEN greatest(64, {d} // 4) ELSE {d} END
        ELSE CASE WHEN {d} > 512 THEN greatest(64, {d} // 6) WHEN {d} > 128 THEN greatest(32, {d} // 4) ELSE {d} END END)"""


def _plan_sql(cut, small: str, edge: int, most: int, floor: int, parts: int) -> str:
    return f"""WITH {_ARRAYS}, cut AS (SELECT *, {cut(0)} AS t0, {cut(1)} AS t1, {cut(2)} AS t2 FROM arr),
      fit AS (SELECT *, (s0 + t0 - 1) // t0 * ((s1 + t1 - 1) // t1) * ((s2 + t2 - 1) // t2) AS n,
                     t0 = c0 AND t1 = c1 AND t2 = c2 AS same FROM cut)
      SELECT array_name, CASE WHEN mb <= 4 THEN s0 || ',' || s1 || ',' || s2
        WHEN {small} THEN least(c0, {edge}) || ',' || least(c1, {edge}) || ',' || least(c2, {edge})
        WHEN NOT same AND n > {most} THEN least(c0, greatest({floor}, s0 // {parts})) || ',' || least(c1, greatest({floor}, s1 // {parts})) || ',' || least(c2, greatest({floor}, s2 // {parts}))
        ELSE t0 || ',' || t1 || ',' || t2 END AS plan FROM fit"""


@register(_plan_sql(_cut_sql, "mb < 50", 64, 2000, 32, 6))
def chunk_plan_memory(spark: SparkSession, sf: str) -> DataFrame:
    plan = P.memory_chunks(F.col("shape"), F.col("chunks"), F.col("mb"))
    return T.part_arrays(spark, sf).select("array_name", text_of(plan).alias("plan"))


def _stream_sql(d: str) -> str:
    return f"least({d}, CASE WHEN {d} // base < 32 THEN greatest(16, {d} // 32) ELSE least({d}, base) END)"


@register(
    f"""WITH {_ARRAYS}, b AS (SELECT *, greatest(32, CAST(floor(pow(8388608 // itemsize, 1.0 / 3) + 1e-9) AS BIGINT)) AS base FROM arr),
        c AS (SELECT *, {_stream_sql('s0')} AS t0, {_stream_sql('s1')} AS t1, {_stream_sql('s2')} AS t2 FROM b)
        SELECT array_name, t0 || ',' || t1 || ',' || t2 AS plan,
               (s0 + t0 - 1) // t0 * ((s1 + t1 - 1) // t1) * ((s2 + t2 - 1) // t2) AS pieces FROM c"""
)
def chunk_plan_stream(spark: SparkSession, sf: str) -> DataFrame:
    plan = P.stream_chunks(F.col("shape"), F.col("itemsize"), 64, 8)
    planned = T.part_arrays(spark, sf).select("array_name", "shape", plan.alias("p"))
    return planned.select("array_name", text_of(F.col("p")).alias("plan"), cells(F.col("shape"), F.col("p")).alias("pieces"))


@register(
    f"""WITH {_ARRAYS} SELECT array_name, (s0 + c0 - 1) // c0 * ((s1 + c1 - 1) // c1) * ((s2 + c2 - 1) // c2) AS chunks,
               s0 * s1 * s2 AS voxels FROM arr"""
)
def chunk_count(spark: SparkSession, sf: str) -> DataFrame:
    shape, chunks = F.col("shape"), F.col("chunks")
    return T.part_arrays(spark, sf).select("array_name", cells(shape, chunks).alias("chunks"), product(shape).alias("voxels"))


@register(
    f"""WITH {_ARRAYS} SELECT array_name, (s0 + 127) // 128 * ((s1 + 127) // 128) * ((s2 + 127) // 128) AS blocks,
               s0 * s1 * s2 AS voxels, (s0 - 1) // 128 * 128 AS last_z, s2 - (s2 - 1) // 128 * 128 AS last_width FROM arr"""
)
def chunk_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The 128-edge block index of every array, summed back per array."""
    arrays = T.part_arrays(spark, sf).select("array_name", "shape", F.array(*[F.lit(128).cast("bigint")] * 3).alias("chunks"))
    grid = P.chunk_grid(arrays)
    return grid.groupBy("array_name").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.sum(F.col("size")[0] * F.col("size")[1] * F.col("size")[2]).alias("voxels"),
        F.max(F.col("origin")[0]).alias("last_z"),
        F.max_by(F.col("size")[2], F.col("origin")[2]).alias("last_width"),
    )


@register(
    f"""WITH {_ARRAYS}, g AS (SELECT array_name, 0 AS axis, s0 AS s, c0 AS c FROM arr UNION ALL SELECT array_name, 1, s1, c1 FROM arr UNION ALL SELECT array_name, 2, s2, c2 FROM arr)
        SELECT array_name, axis, start, least(c, s - start) AS size FROM (SELECT *, unnest(range(0, s, c)) AS start FROM g)"""
)
def axis_offsets(spark: SparkSession, sf: str) -> DataFrame:
    arrays = T.part_arrays(spark, sf)
    axes = arrays.select("array_name", "chunks", F.posexplode("shape").alias("axis", "dim"))
    cut = axes.select("array_name", "axis", F.explode(P.axis_offsets(F.col("dim"), F.element_at("chunks", F.col("axis") + 1))).alias("o"))
    return cut.select("array_name", "axis", "o.start", "o.size")


def _level_mb(n: int) -> str:
    f = 4**n
    return f"CAST(ceil(s0 / {f}.0) * ceil(s1 / {f}.0) * ceil(s2 / {f}.0) AS DOUBLE) * itemsize / 1048576 <= 8"


_LEVEL = "CASE " + " ".join(f"WHEN {_level_mb(n)} THEN {n}" for n in range(10)) + " ELSE 10 END"


@register(
    f"""WITH {_ARRAYS}, l AS (SELECT *, {_LEVEL} AS level FROM arr)
        SELECT array_name, level, CAST(pow(4, level) AS BIGINT) AS reduction,
               CAST(ceil(s0 / pow(4, level)) AS BIGINT) || ',' || CAST(ceil(s1 / pow(4, level)) AS BIGINT) || ',' || CAST(ceil(s2 / pow(4, level)) AS BIGINT) AS shape,
               round(2.96 * pow(4, level), 4) AS voxel_z FROM l"""
)
def pyramid_plan(spark: SparkSession, sf: str) -> DataFrame:
    arrays = T.part_arrays(spark, sf)
    planned = arrays.withColumn("n", P.pyramid_levels(F.col("shape"), F.col("itemsize"), 2))
    voxel = P.level_voxel_size(F.array(F.lit(4.0), F.lit(4.0), F.lit(2.96)), F.col("n"))
    return planned.select(
        "array_name", F.col("n").alias("level"), F.pow(F.lit(4.0), F.col("n")).cast("bigint").alias("reduction"),
        text_of(P.level_shape(F.col("shape"), F.col("n"))).alias("shape"), F.round(voxel[2], 4).alias("voxel_z"),
    )


