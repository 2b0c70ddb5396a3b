"""Queries over block tables: statistics, digests, strides, crops, search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.functions.arrays import linear_index, product, text_of
from voxledger.operators import blocks as B
from voxledger.operators import similarity as N
from voxledger.plans import chunking as P
from voxledger.sources import tables as T

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# Voxels of the event volumes: event_id % 4 is the volume, event_id // 4 the
# C-order position in planes of 10 x 25.
_VOX = """
vox AS (
  SELECT event_id, 'e' || event_id % 4 AS ds, event_id // 4 // 250 AS z, event_id // 4 % 250 // 25 AS y, event_id // 4 % 25 AS x,
         CAST(json_extract_string(props, '$.k') AS BIGINT) % 256 AS v FROM events
)"""
_TEXT = "t AS (SELECT doc_id, encode(text) AS b, octet_length(encode(text)) AS n FROM documents)"


# ---- building and inventory ------------------------------------------------------
@register(
    f"""WITH {_VOX} SELECT ds AS dataset_id, z // 8 || ',' || y // 8 || ',' || x // 8 AS idx, count(*) AS voxels, sum(v) AS total
        FROM vox GROUP BY ALL"""
)
def raw_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks packed from voxel rows, decoded again and summed per block."""
    blocks = B.decode_raw(T.event_blocks(spark, sf)).where("error IS NULL")
    stats = B.voxels(blocks)
    idx = F.transform("coords", lambda c: F.floor(c / 8).cast("bigint"))
    return stats.groupBy("dataset_id", text_of(idx).alias("idx")).agg(
        F.count(F.lit(1)).alias("voxels"), F.sum("value").cast("bigint").alias("total")
    )


@register(
    f"""WITH {_VOX}, {_TEXT}
        SELECT ds AS dataset_id, (max(z) + 1) || ',10,25' AS shape, 'uint8' AS dtype,
               (max(z) // 8 + 1) * 8 AS blocks, (max(z) + 1) * 250 AS nbytes FROM vox GROUP BY ds
        UNION ALL SELECT CAST(doc_id AS VARCHAR), CAST(n AS VARCHAR), 'uint8', greatest(1, (n + 1023) // 1024), n FROM t
        UNION ALL SELECT 'v' || vec_id, '4,4,4', 'float32', 1, 256 FROM embeddings"""
)
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    vec = T.embedding_blocks(spark, sf).withColumn("dataset_id", F.concat(F.lit("v"), "dataset_id"))
    every = T.event_blocks(spark, sf).unionByName(T.text_blocks(spark, sf)).unionByName(vec)
    found = B.inventory(every)
    return found.select("dataset_id", text_of(F.col("shape")).alias("shape"), "dtype", "blocks", "nbytes")


@register(f"WITH {_VOX} SELECT event_id, z || ',' || y || ',' || x AS coords, event_id // 4 AS position FROM vox")
def linear_index_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    back = linear_index(F.col("coords"), F.array(F.lit(1), F.lit(T.PLANE[0]), F.lit(T.PLANE[1])))
    return T.event_voxels(spark, sf).select("event_id", text_of(F.col("coords")).alias("coords"), back.alias("position"))


# ---- statistics --------------------------------------------------------------------
@register(
    """SELECT CAST(vec_id AS VARCHAR) AS dataset_id, 64 AS voxels,
              round(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) / 64, 6) AS mean,
              round(CAST(list_min(embedding) AS DOUBLE), 6) AS low, round(CAST(list_max(embedding) AS DOUBLE), 6) AS high, 256 AS nbytes
       FROM embeddings"""
)
def vol_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = B.volume_stats(T.embedding_blocks(spark, sf))
    return stats.select("dataset_id", "voxels", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high")], "nbytes")


@register(f"WITH {_VOX} SELECT ds AS dataset_id, CASE WHEN v < 40 THEN -1 WHEN v > 200 THEN 10 ELSE least(9, (v - 40) // 16) END AS bin, count(*) AS n FROM vox GROUP BY ALL")
def vol_hist(spark: SparkSession, sf: str) -> DataFrame:
    """Ten bins from 40 to 200, and what lies below and above them."""
    return B.histogram(T.event_blocks(spark, sf), 40, 200, 10).select("dataset_id", "bin", "n")


@register(f"WITH {_TEXT} SELECT CAST(doc_id AS VARCHAR) AS dataset_id, n AS nbytes, sha256(b) AS sha256 FROM t")
def vol_bytes(spark: SparkSession, sf: str) -> DataFrame:
    d = T.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("dataset_id"), "text")
    return B.value_sha256(d, "dataset_id", F.encode("text", "UTF-8"))


@register(
    f"""WITH {_TEXT}, h AS (SELECT doc_id, n, hex(b) AS hx FROM t),
        p AS (SELECT doc_id, hx, unnest(range(0, greatest(n, 1), 1024)) AS o FROM h)
        SELECT CAST(doc_id AS VARCHAR) AS dataset_id, o // 1024 AS idx, sha256(unhex(substr(hx, 2 * o + 1, 2048))) AS sha256 FROM p"""
)
def block_sha(spark: SparkSession, sf: str) -> DataFrame:
    digests = B.block_digests(T.text_blocks(spark, sf))
    return digests.select("dataset_id", F.col("idx")[0].alias("idx"), "sha256")


@register(
    f"""WITH {_TEXT}, h AS (SELECT doc_id, n, hex(b) AS hx FROM t),
        p AS (SELECT doc_id, hx, unnest(range(0, greatest(n, 1), 1024)) AS o FROM h),
        b AS (SELECT doc_id, o // 1024 AS o, sha256(unhex(substr(hx, 2 * o + 1, 2048))) AS s FROM p),
        g AS (SELECT doc_id, o // 8 AS o, sha256(string_agg(s, '' ORDER BY o)) AS s FROM b GROUP BY doc_id, o // 8),
        g2 AS (SELECT doc_id, o // 8 AS o, CASE WHEN max(n) = 1 THEN min(s) ELSE sha256(string_agg(s, '' ORDER BY o)) END AS s
               FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM g) GROUP BY doc_id, o // 8),
        g3 AS (SELECT doc_id, CASE WHEN max(n) = 1 THEN min(s) ELSE sha256(string_agg(s, '' ORDER BY o)) END AS s
               FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM g2) GROUP BY doc_id)
        SELECT CAST(doc_id AS VARCHAR) AS dataset_id, s AS tree_sha256 FROM g3"""
)
def tree_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Hash tree with eight children per node; three rounds reach 512 blocks."""
    return B.tree_digest(T.text_blocks(spark, sf), fan_in=8).select("dataset_id", "tree_sha256")


# ---- stride, pyramid, rechunk --------------------------------------------------------
@register(
    f"""WITH {_VOX} SELECT ds AS dataset_id, z // 3 AS z, count(*) AS voxels, sum(v) AS total FROM vox
        WHERE z % 3 = 0 AND y % 3 = 0 AND x % 3 = 0 GROUP BY ALL"""
)
def stride(spark: SparkSession, sf: str) -> DataFrame:
    small = B.voxels(B.stride(T.event_blocks(spark, sf), 3))
    return small.groupBy("dataset_id", F.col("coords")[0].alias("z")).agg(
        F.count(F.lit(1)).alias("voxels"), F.sum("value").cast("bigint").alias("total")
    )


@register(
    f"""WITH {_VOX}, l(level, f) AS (VALUES (1, 2), (2, 4), (3, 8))
        SELECT ds AS dataset_id, level, f AS downsample_factor, count(*) AS voxels, round(avg(v), 6) AS mean, (max(z) // f + 1) || ',' || (max(y) // f + 1) || ',' || (max(x) // f + 1) AS shape
        FROM vox, l WHERE z % f = 0 AND y % f = 0 AND x % f = 0 GROUP BY ds, level, f"""
)
def pyramid(spark: SparkSession, sf: str) -> DataFrame:
    levels = B.pyramid(T.event_blocks(spark, sf), 3, factor=2)
    stats = B.volume_stats(levels).join(B.inventory(levels).select(*B.KEY, "shape"), B.KEY)
    factor = F.pow(F.lit(2.0), F.col("level")).cast("bigint")
    return stats.select(
        "dataset_id", "level", factor.alias("downsample_factor"), "voxels", F.round("mean", 6).alias("mean"), text_of(F.col("shape")).alias("shape")
    )


@register(
    f"""WITH {_VOX} SELECT ds AS dataset_id, 'level_' || 2 AS name, 2 AS final_level, 4 AS total_reduction_factor, round(avg(v), 6) AS global_mean
        FROM vox WHERE z % 4 = 0 AND y % 4 = 0 AND x % 4 = 0 GROUP BY ds"""
)
def pyramid_record(spark: SparkSession, sf: str) -> DataFrame:
    levels = B.pyramid(T.event_blocks(spark, sf), 2, factor=2, keep_all=False)
    stats = B.volume_stats(levels).join(B.inventory(levels).select(*B.KEY, "shape"), B.KEY)
    voxel = P.level_voxel_size(F.array(F.lit(4.0), F.lit(4.0), F.lit(2.96)), F.col("level"), 2)
    described = stats.select(
        *B.KEY, "shape", voxel.alias("voxel_size_nm"), F.pow(F.lit(2.0), F.col("level")).cast("bigint").alias("downsample_factor"),
        F.col("mean").alias("global_mean"),
    )
    record = P.pyramid_record(described).select("*", F.explode("pyramid_levels").alias("name", "entry"))
    return record.select("dataset_id", "name", "final_level", "total_reduction_factor", F.round("entry.global_mean", 6).alias("global_mean"))


@register(
    f"""WITH {_VOX} SELECT ds AS dataset_id, z // 5 || ',' || y // 7 || ',' || x // 6 AS idx, sum(v) AS total,
               (z // 5 * 5) || ',' || (y // 7 * 7) || ',' || (x // 6 * 6) AS origin FROM vox GROUP BY ALL"""
)
def rechunk(spark: SparkSession, sf: str) -> DataFrame:
    moved = B.rechunk(T.event_blocks(spark, sf), [5, 7, 6])
    stats = B._map(
        moved, lambda r: [{"dataset_id": r["dataset_id"], "idx": r["idx"], "origin": r["origin"], "total": int(B._array(r).sum())}],
        "dataset_id string, idx array<bigint>, origin array<bigint>, total bigint",
    )
    return stats.select("dataset_id", text_of(F.col("idx")).alias("idx"), "total", text_of(F.col("origin")).alias("origin"))


# ---- crops -----------------------------------------------------------------------------
_REQ = """
req AS (
  SELECT c_custkey, 'e' || c_custkey % 4 AS ds, (c_custkey * 7) % (SELECT max(event_id) // 4 // 250 + 1 FROM events) AS z,
         (c_custkey * 5) % 10 AS y, (c_custkey * 3) % 25 AS x
  FROM customer
)"""


def _points(spark: SparkSession, sf: str) -> DataFrame:
    depth, c = T.event_depth(spark, sf), F.col("c_custkey")
    return T.spread(T.table(spark, sf, "customer").select("c_custkey")).select(
        c.alias("request_id"), F.concat(F.lit("e"), (c % 4).cast("string")).alias("dataset_id"), F.lit("s0").alias("array_name"),
        F.lit(0).alias("level"), ((c * 7) % depth).alias("z"), ((c * 5) % 10).alias("y"), ((c * 3) % 25).alias("x"),
    )


@register(
    f"""WITH {_VOX}, {_REQ} SELECT r.c_custkey AS request_id, count(*) AS voxels, sum(v.v) AS total,
               min(v.z) || ',' || min(v.y) || ',' || min(v.x) AS origin
        FROM req r JOIN vox v ON v.ds = r.ds AND v.z BETWEEN r.z AND r.z + 5 AND v.y BETWEEN r.y AND r.y + 5 AND v.x BETWEEN r.x AND r.x + 5
        GROUP BY r.c_custkey"""
)
def block_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A 6-voxel box per customer, cut from the event volume and assembled."""
    blocks = T.event_blocks(spark, sf)
    pieces = B.block_lookup(_points(spark, sf), blocks, B.inventory(blocks), 6)
    return _crop_sums(B.assemble_crops(pieces)).select("request_id", "voxels", "total", text_of(F.col("at")).alias("origin"))


def _crop_sums(crops: DataFrame) -> DataFrame:
    return B._map(
        crops,
        lambda r: [{"request_id": r["request_id"], "part": r["part"], "voxels": B._array(r).size, "total": int(B._array(r).sum()), "at": r["origin"]}],
        "request_id bigint, part array<bigint>, voxels bigint, total bigint, at array<bigint>",
    )


@register(
    f"""WITH {_VOX}, {_REQ} SELECT r.c_custkey AS request_id, (v.z - r.z) // 4 || ',' || (v.y - r.y) // 4 || ',' || (v.x - r.x) // 4 AS part,
               count(*) AS voxels, sum(v.v) AS total, min(v.z) || ',' || min(v.y) || ',' || min(v.x) AS origin
        FROM req r JOIN vox v ON v.ds = r.ds AND v.z BETWEEN r.z AND r.z + 5 AND v.y BETWEEN r.y AND r.y + 5 AND v.x BETWEEN r.x AND r.x + 5
        GROUP BY ALL"""
)
def crop_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The same boxes as blocks of a crop-local grid with edges of 4 voxels."""
    blocks = T.event_blocks(spark, sf)
    pieces = B.block_lookup(_points(spark, sf), blocks, B.inventory(blocks), 6)
    sums = _crop_sums(B.assemble_crops(pieces, edge=4))
    return sums.select("request_id", text_of(F.col("part")).alias("part"), "voxels", "total", text_of(F.col("at")).alias("origin"))


@register(
    f"""WITH {_VOX}, {_REQ}, s AS (SELECT ds, z // 3 AS z, y // 3 AS y, x // 3 AS x, v FROM vox WHERE z % 3 = 0 AND y % 3 = 0 AND x % 3 = 0),
        q AS (SELECT c_custkey, ds, z % (SELECT max(z) + 1 FROM s) AS z, y % 4 AS y, x % 9 AS x FROM req)
        SELECT q.c_custkey AS request_id, count(*) AS voxels, sum(s.v) AS total,
               min(s.z) || ',' || min(s.y) || ',' || min(s.x) AS origin
        FROM q JOIN s ON s.ds = q.ds AND s.z BETWEEN q.z AND q.z + 5 AND s.y BETWEEN q.y AND q.y + 5 AND s.x BETWEEN q.x AND q.x + 5
        GROUP BY q.c_custkey"""
)
def stride_crop(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes of 6 voxels from the volumes strided by 3."""
    small = B.stride(T.event_blocks(spark, sf), 3)
    deep = -(-T.event_depth(spark, sf) // 3)
    points = _points(spark, sf).withColumns({"z": F.col("z") % deep, "y": F.col("y") % 4, "x": F.col("x") % 9})
    crops = B.assemble_crops(B.block_lookup(points, small, B.inventory(small), 6))
    return _crop_sums(crops).select("request_id", "voxels", "total", text_of(F.col("at")).alias("origin"))


@register(
    f"""WITH {_VOX}, b AS (SELECT DISTINCT ds, z // 3 // 8 AS a, x // 3 // 8 AS c FROM vox WHERE z % 3 = 0 AND y % 3 = 0 AND x % 3 = 0)
        SELECT ds AS dataset_id, (a * 2 + c) // 5 AS batch, count(*) AS blocks, min(a * 2 + c) AS first FROM b GROUP BY ALL"""
)
def stride_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of five blocks of the volumes strided by 3: 4 x 9 planes make 1 x 2 blocks."""
    small = B.stride(T.event_blocks(spark, sf), 3)
    numbered = B.batch_number(B.inventory(small), small, 5)
    return numbered.groupBy("dataset_id", "batch").agg(F.count(F.lit(1)).alias("blocks"), F.min("position").alias("first"))


@register(
    f"""WITH {_TEXT}, r AS (SELECT doc_id, n, b, hex(b) AS hx, doc_id % 3 = 0 OR n % 2 = 0 AS ok FROM t),
        c AS (SELECT doc_id, n, hx, ok, CASE WHEN doc_id % 3 = 0 THEN n ELSE n // 2 END AS rows, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 2 END AS width FROM r)
        SELECT CAST(doc_id AS VARCHAR) AS dataset_id, o // 100 AS block, NULL AS error, sha256(unhex(substr(hx, 2 * o * width + 1, 200 * width))) AS sha256
        FROM (SELECT *, unnest(range(0, greatest(rows, 1), 100)) AS o FROM c WHERE ok)
        UNION ALL SELECT CAST(doc_id AS VARCHAR), NULL, '3D block has size ' || n || ' (expected ' || (n // 2 * 2) || ')', NULL FROM c WHERE NOT ok"""
)
def raw_volumes(spark: SparkSession, sf: str) -> DataFrame:
    """Raw bytes of every text as one or two columns of uint8, cut into blocks; sizes that do not fit are errors."""
    d = T.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("dataset_id"), "doc_id", F.encode("text", "UTF-8").alias("payload"))
    n, one = F.octet_length("payload").cast("bigint"), F.lit(1).cast("bigint")
    shape = F.when(F.col("doc_id") % 3 == 0, F.array(n, one)).otherwise(F.array(F.floor(n / 2).cast("bigint"), one + 1))
    decoded = B.decode_raw(
        d.select("dataset_id", F.lit("raw").alias("array_name"), F.lit(0).alias("level"), shape.alias("shape"), F.lit("uint8").alias("dtype"), "payload")
    )
    digests = B.block_digests(B.raw_blocks(decoded, [100, 2]))
    good = digests.select("dataset_id", F.col("idx")[0].alias("block"), F.lit(None).cast("string").alias("error"), "sha256")
    bad = decoded.where("error IS NOT NULL").select("dataset_id", F.lit(None).cast("bigint").alias("block"), "error", F.lit(None).cast("string").alias("sha256"))
    return good.unionByName(bad)


@register(
    f"""WITH {_VOX}, {_REQ} SELECT r.c_custkey AS request_id, v.z // 8 || ',' || v.y // 8 || ',' || v.x // 8 AS idx, count(*) AS voxels
        FROM req r JOIN vox v ON v.ds = r.ds AND v.z BETWEEN r.z AND r.z + 1 AND v.y BETWEEN r.y AND r.y + 8 AND v.x BETWEEN r.x AND r.x + 9 GROUP BY ALL"""
)
def crop_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The blocks each 2 x 9 x 10 crop touches, with the voxels it takes."""
    blocks = T.event_blocks(spark, sf)
    size = F.array(*[F.lit(n).cast("bigint") for n in (2, 9, 10)])
    requests = _points(spark, sf).select("request_id", *B.KEY, F.array("z", "y", "x").alias("start"), size.alias("size"))
    pieces = B.crop_pieces(requests, blocks, B.inventory(blocks))
    return pieces.select("request_id", text_of(F.col("idx")).alias("idx"), product(F.col("shape")).alias("voxels"))


@register(
    """SELECT event_id,
         CASE event_id % 5 WHEN 0 THEN '1,2,3' WHEN 1 THEN '0,0,' || user_id WHEN 2 THEN '5,6,7' WHEN 3 THEN '0,0,0' END AS start,
         CASE event_id % 5 WHEN 0 THEN (user_id + 10) || ',20,30' WHEN 1 THEN '9,9,' || (user_id + 9) WHEN 2 THEN '50,60,' || (user_id + 70)
              WHEN 3 THEN '29,19,' || (user_id + 9) END AS stop
       FROM events"""
)
def bounds_resolve(spark: SparkSession, sf: str) -> DataFrame:
    bounds = B.resolve_bounds(F.col("info"))
    return _infos(spark, sf).select("event_id", *bounds).select(
        "event_id", text_of(F.col("start")).alias("start"), text_of(F.col("stop")).alias("stop")
    )


def _infos(spark: SparkSession, sf: str) -> DataFrame:
    e = T.table(spark, sf, "events").select("event_id", "user_id")
    u, kind = F.col("user_id"), F.col("event_id") % 5
    doc = (
        F.when(kind == 0, F.format_string('{"bounds": [[1, 2, 3], [%d, 20, 30]], "Size": [1, 1, 1]}', u + 10))
        .when(kind == 1, F.format_string('{"Extended": {"MinZyx": [0, 0, %d], "MaxZyx": [9, 9, %d]}}', u, u + 9))
        .when(kind == 2, F.format_string('{"Extents": {"MinPoint": [5, 6, 7], "MaxPoint": [50, 60, %d]}}', u + 70))
        .when(kind == 3, F.format_string('{"Size": [%d, 20, 30]}', u + 10))
        .otherwise(F.lit('{"Base": {}}'))
    )
    return e.withColumn("info", F.parse_json(doc))


_BOX = """
box AS (
  SELECT event_id, event_id % 10 AS z0, event_id % 7 AS y0, 0 AS x0, event_id % 10 + user_id AS z1, event_id % 7 + 40 AS y1, 99 AS x1 FROM events
)"""


def _draw(axis: str, i: int, size: int) -> str:
    room = f"({axis}1 - {axis}0 + 1 - {size} + 1)"
    return f"{axis}0 + ('0x' || substr(md5(event_id || ':{i}:7'), 1, 15))::BIGINT % {room}"


@register(f"WITH {_BOX} SELECT event_id, z1 - z0 + 1 >= 20 AS fits FROM box")
def crop_fit(spark: SparkSession, sf: str) -> DataFrame:
    return _boxes(spark, sf).select("event_id", B.crop_fits(F.col("start"), F.col("stop"), F.col("size")).alias("fits"))


@register(
    f"""WITH {_BOX} SELECT event_id, CASE WHEN z1 - z0 + 1 >= 20 THEN
          ({_draw('z', 0, 20)}) || ',' || ({_draw('y', 1, 30)}) || ',' || ({_draw('x', 2, 40)}) END AS origin FROM box"""
)
def crop_origin(spark: SparkSession, sf: str) -> DataFrame:
    origin = B.random_origin(F.col("event_id"), F.col("start"), F.col("stop"), F.col("size"), 7)
    return _boxes(spark, sf).select("event_id", text_of(origin).alias("origin"))


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    e, i = T.table(spark, sf, "events"), F.col("event_id")
    longs = lambda *c: F.array(*c).cast("array<bigint>")
    return e.select(
        "event_id", longs(i % 10, i % 7, F.lit(0)).alias("start"), longs(i % 10 + F.col("user_id"), i % 7 + 40, F.lit(99)).alias("stop"),
        longs(F.lit(20), F.lit(30), F.lit(40)).alias("size"),
    )


# ---- lookups on blocks ---------------------------------------------------------------------
@register(
    f"""WITH {_TEXT} SELECT d.source, count(*) AS datasets, sum(greatest(1, (n + 1023) // 1024)) AS blocks, sum(n) AS nbytes
        FROM t JOIN documents d USING (doc_id) GROUP BY d.source"""
)
def block_dataset_join(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks joined to their data sets, counted per source.

    Blocks are summed per data set before the join, so payloads never move.
    """
    sized = T.text_blocks(spark, sf).groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("blocks"), F.sum(F.octet_length("payload")).alias("nbytes")
    )
    datasets = T.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("dataset_id"), "source")
    return sized.join(datasets, "dataset_id").groupBy("source").agg(
        F.count(F.lit(1)).alias("datasets"), F.sum("blocks").alias("blocks"), F.sum("nbytes").alias("nbytes")
    )


@register(
    f"""WITH {_VOX}, b AS (SELECT DISTINCT ds, z // 8 AS a, y // 8 AS b, x // 8 AS c FROM vox)
        SELECT ds AS dataset_id, (a * 8 + b * 4 + c) // 5 AS batch, count(*) AS blocks, min(a * 8 + b * 4 + c) AS first FROM b GROUP BY ALL"""
)
def batch_blocks(spark: SparkSession, sf: str) -> DataFrame:
    blocks = T.event_blocks(spark, sf)
    numbered = B.batch_number(B.inventory(blocks), blocks, 5)
    return numbered.groupBy("dataset_id", "batch").agg(F.count(F.lit(1)).alias("blocks"), F.min("position").alias("first"))


@register(
    """WITH dims AS (SELECT label, unnest(embedding) AS x, unnest(range(1, 65)) AS d FROM embeddings),
         c AS (SELECT label, list(x ORDER BY d) AS q FROM (SELECT label, d, avg(CAST(x AS DOUBLE)) AS x FROM dims GROUP BY ALL) GROUP BY label),
         s AS (SELECT c.label, e.vec_id, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), c.q) AS score FROM c, embeddings e),
         r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS place FROM s)
       SELECT label AS query_id, vec_id, place, round(score, 6) AS score FROM r WHERE place <= 5"""
)
def emb_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five block embeddings closest to each label's mean embedding."""
    index = T.table(spark, sf, "embeddings")
    found = N.top_k(index, N.centroids(index, "label"), 5)
    return found.select("query_id", "vec_id", "place", F.round("score", 6).alias("score"))


@register("SELECT user_id AS block, count(*) AS access_count, max(ts) AS last_accessed FROM events GROUP BY user_id")
def access_counts(spark: SparkSession, sf: str) -> DataFrame:
    e = T.table(spark, sf, "events")
    return e.groupBy(F.col("user_id").alias("block")).agg(
        F.count(F.lit(1)).alias("access_count"), F.max("ts").alias("last_accessed")
    )


# ---- byte ranges -----------------------------------------------------------------------------
@register(
    f"""WITH {_TEXT}, p AS (SELECT doc_id, n, unnest(range(0, greatest(n, 1), 700)) AS o FROM t)
        SELECT doc_id, o // 700 AS chunk_id, o AS start_byte, least(o + 699, n - 1) AS end_byte FROM p"""
)
def byte_ranges(spark: SparkSession, sf: str) -> DataFrame:
    d = T.table(spark, sf, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("total"))
    return B.byte_ranges(d, 700).select("doc_id", "chunk_id", "start_byte", "end_byte")


@register(
    f"""WITH {_TEXT}, s AS (SELECT doc_id, n, hex(b) AS hx, unnest(range(0, greatest(n, 1), 2800)) AS o FROM t)
        SELECT doc_id, o // 2800 AS seq, least(2800, n - o) AS nbytes, greatest(1, (least(2800, n - o) + 699) // 700) AS chunks,
               sha256(unhex(substr(hx, 2 * o + 1, 5600))) AS sha256 FROM s"""
)
def reassemble(spark: SparkSession, sf: str) -> DataFrame:
    d = T.table(spark, sf, "documents").select("doc_id", F.encode("text", "UTF-8").alias("payload"))
    sized = d.withColumn("total", F.octet_length("payload").cast("bigint"))
    ranges = B.byte_ranges(sized, 700)
    part = F.substring("payload", (F.col("start_byte") + 1).cast("int"), (F.col("end_byte") - F.col("start_byte") + 1).cast("int"))
    chunks = ranges.select("doc_id", "chunk_id", part.alias("payload"))
    whole = B.reassemble(chunks, "doc_id", 700, segment_bytes=2800)
    return whole.select("doc_id", "seq", "nbytes", "chunks", F.sha2("payload", 256).alias("sha256"))
