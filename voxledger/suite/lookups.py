"""Queries over stored blocks, vectors and raw files: curve lookups, search, shuffled batches, quantiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.functions.arrays import linear_index, product, text_of
from voxledger.functions.permutation import permuted, unpermuted
from voxledger.operators import blocks as B
from voxledger.operators import ivf as I
from voxledger.operators import quantiles as Q
from voxledger.operators import store as ST
from voxledger.session import shared_dir
from voxledger.sources import raw as R
from voxledger.sources import tables as T
from voxledger.suite.volumes import _REQ, _VOX, _crop_sums, _points

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# ---- the block store ---------------------------------------------------------------
def _stored(spark: SparkSession, sf: str) -> str:
    """The event volumes in a store whose cells are small, so that a box is in few files."""
    path = shared_dir(spark, "store")
    ST.write_blocks(T.event_blocks(spark, sf), path, cell_bytes=4 * 512)
    return path


@register(
    f"""WITH {_VOX}, {_REQ} SELECT r.c_custkey AS request_id, count(*) AS voxels, sum(v.v) AS total,
               min(v.z) || ',' || min(v.y) || ',' || min(v.x) AS origin
        FROM req r JOIN vox v ON v.ds = r.ds AND v.z BETWEEN r.z AND r.z + 5 AND v.y BETWEEN r.y AND r.y + 5 AND v.x BETWEEN r.x AND r.x + 5
        GROUP BY r.c_custkey"""
)
def store_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The boxes of ``block_lookup`` from a store: only files that its zone map names are read."""
    points = _points(spark, sf)
    six = F.array(*[F.lit(6).cast("bigint")] * 3)
    start = F.array(*[F.col(c).cast("bigint") for c in ("z", "y", "x")])
    requests = points.select("request_id", *B.KEY, start.alias("start"), six.alias("size"))
    crops = B.assemble_crops(ST.store_lookup(requests, _stored(spark, sf), axes=3))
    return _crop_sums(crops).select("request_id", "voxels", "total", text_of(F.col("at")).alias("origin"))


@register(
    f"""WITH {_VOX} SELECT ds AS dataset_id, (max(z) + 1) || ',10,25' AS shape, '8,8,8' AS chunks, 'uint8' AS dtype,
               (max(z) // 8 + 1) * 8 AS blocks, (max(z) + 1) * 250 AS nbytes FROM vox GROUP BY ds"""
)
def store_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of a store from its zone map alone."""
    found = ST.stored_inventory(ST.zones(spark, _stored(spark, sf)))
    return found.select("dataset_id", text_of(F.col("shape")).alias("shape"), text_of(F.col("chunks")).alias("chunks"), "dtype", "blocks", "nbytes")


# ---- vectors -----------------------------------------------------------------------
@register()
def emb_topk_ivf(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest vectors of every vector whose id is divisible by 20, by an inverted file.

    Approximate, so it has no SQL; its recall against the exact form is tested.
    """
    index = T.table(spark, sf, "embeddings").select("vec_id", "embedding")
    width = index.agg(F.max(F.size("embedding"))).first()[0] or 0
    centroids = I.fit(index, "embedding", width)
    queries = index.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    return I.search(index, queries, 10, centroids).select("query_id", "vec_id", "place", F.round("score", 6).alias("score"))


# ---- shuffled batches ----------------------------------------------------------------
_BATCH_KEYS = [f"{seed}:{epoch}" for seed, epoch in ((7, 0), (7, 1), (8, 0))]


def _turns_sql(x: str) -> str:
    """The rounds of the permutation over the cell ``x``, as a subquery from ``w``."""
    number = lambda n, part: f"('0x' || substr(md5(key || ':{n}:' || {part}), 1, 15))::BIGINT"
    return f"""(SELECT *, (q3 + {number(3, 'p3')} % b) % b AS q4, p3 AS p4 FROM
      (SELECT *, (p2 + {number(2, 'q2')} % a) % a AS p3, q2 AS q3 FROM
        (SELECT *, (q1 + {number(1, 'p1')} % b) % b AS q2, p1 AS p2 FROM
          (SELECT *, ({x} // b + {number(0, f'({x} % b)')} % a) % a AS p1, {x} % b AS q1 FROM w) t1) t2) t3)"""


@register(
    f"""WITH RECURSIVE {_VOX},
      blk AS (SELECT DISTINCT ds, (z // 8 * 2 + y // 8) * 4 + x // 8 AS pos FROM vox),
      n AS (SELECT ds, count(*) AS n FROM blk GROUP BY ds),
      g AS (SELECT ds, n, CAST(ceil(sqrt(n)) AS BIGINT) AS a FROM n),
      w AS (
        SELECT ds, pos, key, n, a, (n + a - 1) // a AS b, pos AS x, 0 AS k FROM blk JOIN g USING (ds), (VALUES {', '.join(f"('{k}')" for k in _BATCH_KEYS)}) s(key)
        UNION ALL
        SELECT ds, pos, key, n, a, b, p4 * b + q4 AS x, k + 1 AS k FROM {_turns_sql('x')} t WHERE k = 0 OR x >= n)
      SELECT ds AS dataset_id, key, x // 5 AS batch, x % 5 AS slot, pos AS position, true AS returns FROM w WHERE k > 0 AND x < n"""
)
def train_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of five blocks in a shuffled order per key (seed and epoch); ``returns`` says that the place leads back."""
    blocks = T.event_blocks(spark, sf)
    grid = B.inventory(blocks).select(*B.KEY, B.grid_of(F.col("shape"), F.col("chunks")).alias("_g"))
    numbered = blocks.drop("payload").join(grid, B.KEY).select(
        "dataset_id", product(F.col("_g")).alias("n"), linear_index(F.col("idx"), F.col("_g")).alias("position")
    )
    numbered = numbered.withColumn("key", F.explode(F.array(*[F.lit(k) for k in _BATCH_KEYS])))
    placed = numbered.withColumn("place", permuted(F.col("position"), F.col("n"), F.col("key")))
    batch, slot = B.floor_div(F.col("place"), F.lit(5)), F.col("place") % 5
    back = unpermuted(F.col("place"), F.col("n"), F.col("key")) == F.col("position")
    return placed.select("dataset_id", "key", batch.alias("batch"), slot.alias("slot"), "position", back.alias("returns"))


# ---- quantiles -----------------------------------------------------------------------
_SHARES = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


@register(
    f"""WITH {_VOX}, all_ AS (
          SELECT ds AS dataset_id, CAST(v AS DOUBLE) AS v FROM vox
          UNION ALL SELECT 'v' || vec_id, CAST(unnest(embedding) AS DOUBLE) FROM embeddings),
        c AS (SELECT dataset_id, v, row_number() OVER (PARTITION BY dataset_id ORDER BY v) AS r, count(*) OVER (PARTITION BY dataset_id) AS n FROM all_)
        SELECT dataset_id, q, round(min(v) FILTER (r >= greatest(1, ceil(q * n - 1e-9))), 6) AS value, 0.0::DOUBLE AS rank_error
        FROM c, (SELECT CAST(unnest({_SHARES}) AS DOUBLE) AS q) GROUP BY dataset_id, q"""
)
def vol_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of the event volumes and of every vector's volume: few different values each, so they are exact."""
    vec = T.embedding_blocks(spark, sf).withColumn("dataset_id", F.concat(F.lit("v"), "dataset_id"))
    found = Q.volume_quantiles(T.event_blocks(spark, sf).unionByName(vec), _SHARES)
    return found.select("dataset_id", "q", F.round("value", 6).alias("value"), "rank_error")


# ---- raw files -----------------------------------------------------------------------
_AXES = {"e0": "zyx", "e1": "xyz", "e2": "yzx", "e3": "zyx"}


@register(
    f"""WITH {_VOX}, d AS (SELECT max(z) + 1 AS depth FROM vox)
        SELECT ds AS dataset_id, z // 8 || ',' || y // 8 || ',' || x // 8 AS idx, count(*) AS voxels, sum(v) AS total, NULL AS error
        FROM vox WHERE ds <> 'e3' GROUP BY ALL
        UNION ALL SELECT 'e3', NULL, NULL, NULL, '3D block has size ' || (depth * 250) || ' (expected ' || ((depth + 1) * 250) || ')' FROM d
        UNION ALL SELECT 'gone', NULL, NULL, NULL, 'no such file'"""
)
def raw_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Raw files of the event volumes along three orders of axes, read back by ranges of a few planes.

    The last file is declared with one plane too many, and one declared file is not there.
    """
    folder = shared_dir(spark, "raw")
    blocks = T.event_blocks(spark, sf)
    blocks = blocks.persist()
    written = None
    for axes in sorted(set(_AXES.values())):
        mine = blocks.where(F.col("dataset_id").isin(*[d for d, a in _AXES.items() if a == axes]))
        part = R.write_raw_files(mine, folder, axes)
        written = part if written is None else written.unionByName(part)
    blocks.unpersist()
    longer = F.when(F.col("dataset_id") == "e3", F.transform("shape", lambda n, i: F.when(i == 0, n + 1).otherwise(n))).otherwise(F.col("shape"))
    declared = written.drop("bytes").withColumn("shape", longer)
    gone = written.where("dataset_id = 'e0'").drop("bytes").withColumns({"dataset_id": F.lit("gone"), "path": F.lit(f"{folder}/none.raw")})
    sizes = R.file_sizes(spark, folder).select(F.element_at(F.split("path", "/"), -1).alias("name"), "bytes")
    files = declared.unionByName(gone).withColumn("name", F.element_at(F.split("path", "/"), -1)).join(sizes, "name", "left").drop("name")
    read = R.raw_file_blocks(files, [8, 8, 8], slab_bytes=2_000)
    sums = B._map(
        read, lambda r: [{"dataset_id": r["dataset_id"], "idx": r["idx"], "voxels": B._array(r).size, "total": int(B._array(r).sum())}],
        "dataset_id string, idx array<bigint>, voxels bigint, total bigint",
    )
    good = sums.select("dataset_id", text_of(F.col("idx")).alias("idx"), "voxels", "total", F.lit(None).cast("string").alias("error"))
    none = lambda kind: F.lit(None).cast(kind)
    bad = R.checked(files).where("error IS NOT NULL").select(
        "dataset_id", none("string").alias("idx"), none("bigint").alias("voxels"), none("bigint").alias("total"), "error"
    )
    return good.unionByName(bad)
