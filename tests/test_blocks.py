"""Block operators against whole numpy arrays."""

import hashlib
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxledger.operators import blocks as B
from voxledger.operators import ingest as I
from voxledger.operators import quantiles as Q
from voxledger.operators import store as ST
from voxledger.plans import chunking as P
from voxledger.sources import raw as R

CHUNK = (4, 5, 6)


def blocks_of(spark, arrays, chunk=CHUNK, parts=3):
    rows = []
    for name, a in arrays.items():
        for z in range(0, a.shape[0], chunk[0]):
            for y in range(0, a.shape[1], chunk[1]):
                for x in range(0, a.shape[2], chunk[2]):
                    b = a[z : z + chunk[0], y : y + chunk[1], x : x + chunk[2]]
                    at = [z, y, x]
                    idx = [o // c for o, c in zip(at, chunk)]
                    rows.append((name, "s0", 0, list(chunk), idx, at, list(b.shape), str(a.dtype), bytearray(np.ascontiguousarray(b).tobytes())))
    return spark.createDataFrame(rows, B.BLOCKS).repartition(parts)


def whole(df):
    """Arrays by (dataset, level), put together on the driver for comparison."""
    out = {}
    for r in df.collect():
        out.setdefault((r["dataset_id"], r["level"]), []).append(r)
    built = {}
    for key, rows in out.items():
        end = np.max([np.add(r["origin"], r["shape"]) for r in rows], axis=0)
        a = np.zeros(end, rows[0]["dtype"])
        for r in rows:
            where = tuple(slice(o, o + n) for o, n in zip(r["origin"], r["shape"]))
            a[where] = np.frombuffer(bytes(r["payload"]), a.dtype).reshape(r["shape"])
        built[key] = a
    return built


@pytest.fixture(scope="module")
def arrays():
    rng = np.random.default_rng(7)
    return {
        "a": rng.integers(0, 255, (9, 11, 13)).astype("uint8"),
        "b": rng.normal(size=(8, 5, 6)).astype("float32"),
        "c": rng.integers(-500, 500, (3, 17, 2)).astype("int16"),
    }


@pytest.fixture(scope="module")
def blocks(spark, arrays):
    return blocks_of(spark, arrays).cache()


def test_inventory(blocks, arrays):
    rows = {r["dataset_id"]: r for r in B.inventory(blocks).collect()}
    for name, a in arrays.items():
        assert rows[name]["shape"] == list(a.shape)
        assert rows[name]["chunks"] == list(CHUNK)
        assert (rows[name]["dtype"], rows[name]["nbytes"]) == (str(a.dtype), a.nbytes)
    assert B.inventory_or_derive(blocks).count() == 3
    with pytest.raises(ValueError):
        B.inventory_or_derive(blocks.where("false"))


@pytest.mark.parametrize("parts", [1, 7])
def test_stats_do_not_depend_on_partitions(spark, arrays, parts):
    rows = {r["dataset_id"]: r for r in B.volume_stats(blocks_of(spark, arrays, parts=parts)).collect()}
    for name, a in arrays.items():
        assert rows[name]["voxels"] == a.size and rows[name]["nbytes"] == a.nbytes
        assert rows[name]["mean"] == pytest.approx(a.mean(dtype="float64"))
        assert (rows[name]["low"], rows[name]["high"]) == (a.min(), a.max())


def test_histogram(blocks, arrays):
    rows = B.histogram(blocks.where("dataset_id = 'a'"), 0, 255, 8).collect()
    want, _ = np.histogram(arrays["a"], 8, (0, 255))
    assert {r["bin"]: r["n"] for r in rows} == {i: n for i, n in enumerate(want) if n}


@pytest.mark.parametrize("chunk", [[3, 4, 5], [1, 100, 2], [50, 50, 50]])
def test_rechunk_keeps_voxels_and_goes_back(blocks, arrays, chunk):
    moved = B.rechunk(blocks, chunk)
    for name, a in whole(moved).items():
        assert np.array_equal(a, arrays[name[0]])
    for r in moved.collect():
        dims = arrays[r["dataset_id"]].shape
        assert r["origin"] == [i * c for i, c in zip(r["idx"], chunk)]
        assert r["shape"] == [min(c, d - o) for c, d, o in zip(chunk, dims, r["origin"])]
    back = {(r["dataset_id"], tuple(r["idx"])): bytes(r["payload"]) for r in B.rechunk(moved, list(CHUNK)).collect()}
    assert back == {(r["dataset_id"], tuple(r["idx"])): bytes(r["payload"]) for r in blocks.collect()}


def test_stride_composes(blocks, arrays):
    once, twice = whole(B.stride(blocks, 6)), whole(B.stride(B.stride(blocks, 2), 3))
    for name, a in arrays.items():
        assert np.array_equal(once[name, 0], a[::6, ::6, ::6])
        assert np.array_equal(twice[name, 0], a[::6, ::6, ::6])


def test_pyramid_levels(blocks, arrays):
    levels = whole(B.pyramid(blocks, 2, factor=2))
    for name, a in arrays.items():
        assert np.array_equal(levels[name, 1], a[::2, ::2, ::2])
        assert np.array_equal(levels[name, 2], a[::4, ::4, ::4])
    last = B.pyramid(blocks, F.when(F.col("dataset_id") == "a", 2).otherwise(0), factor=2, keep_all=False)
    assert set(whole(last)) == {("a", 2)}


def test_crops_match_slices(spark, blocks, arrays):
    boxes = [(1, "a", [0, 0, 0], [9, 11, 13]), (2, "a", [3, 4, 5], [2, 3, 4]), (3, "b", [7, 4, 5], [9, 9, 9]), (4, "a", [-2, 0, 0], [4, 2, 2]), (5, "c", [3, 0, 0], [1, 1, 1])]
    requests = spark.createDataFrame(
        [(i, d, "s0", 0, s, n) for i, d, s, n in boxes],
        "request_id bigint, dataset_id string, array_name string, level int, start array<bigint>, size array<bigint>",
    )
    pieces = B.crop_pieces(requests, blocks, B.inventory(blocks))
    crops = {r["request_id"]: r for r in B.assemble_crops(pieces).collect()}
    for i, name, start, size in boxes[:4]:
        a = arrays[name][tuple(slice(max(s, 0), s + n) for s, n in zip(start, size))]
        assert crops[i]["shape"] == list(a.shape) and bytes(crops[i]["payload"]) == np.ascontiguousarray(a).tobytes()
    assert 5 not in crops  # the box lies outside the array
    parts = B.assemble_crops(pieces, edge=3)
    assert parts.columns == B.assemble_crops(pieces).columns
    got = np.zeros((2, 3, 4), "uint8")
    for r in parts.where("request_id = 2").collect():
        assert r["origin"] == [s + 3 * p for s, p in zip([3, 4, 5], r["part"])]
        where = tuple(slice(o - s, o - s + n) for o, s, n in zip(r["origin"], [3, 4, 5], r["shape"]))
        got[where] = np.frombuffer(bytes(r["payload"]), "uint8").reshape(r["shape"])
    assert np.array_equal(got, arrays["a"][3:5, 4:7, 5:9])


@pytest.mark.parametrize("factor", [2, 3, 5])
def test_crops_of_strided_arrays_match_slices(spark, blocks, arrays, factor):
    small = B.stride(blocks, factor)
    requests = spark.createDataFrame(
        [(1, "a", "s0", 0, [0, 0, 0], [9, 11, 13]), (2, "a", "s0", 0, [1, 1, 1], [2, 3, 4]), (3, "b", "s0", 0, [0, 0, 0], [9, 9, 9])],
        "request_id bigint, dataset_id string, array_name string, level int, start array<bigint>, size array<bigint>",
    )
    crops = {r["request_id"]: r for r in B.assemble_crops(B.crop_pieces(requests, small, B.inventory(small))).collect()}
    for i, name, start, size in [(1, "a", 0, (9, 11, 13)), (2, "a", 1, (2, 3, 4)), (3, "b", 0, (9, 9, 9))]:
        want = arrays[name][::factor, ::factor, ::factor][tuple(slice(start, start + n) for n in size)]
        assert crops[i]["shape"] == list(want.shape) and bytes(crops[i]["payload"]) == np.ascontiguousarray(want).tobytes()
    for r in small.collect():
        assert r["origin"] == [i * c for i, c in zip(r["idx"], r["chunk"])]
    positions = B.batch_number(B.inventory(small), small, 4).groupBy("dataset_id").agg(F.count_distinct("position").alias("d"), F.count("*").alias("n"))
    assert positions.where("d != n").count() == 0


def test_any_number_of_axes_and_empty_arrays(spark):
    rng = np.random.default_rng(2)
    volumes = {"two": rng.integers(0, 9, (7, 5)).astype("uint8"), "four": rng.integers(0, 9, (3, 4, 2, 5)).astype("uint8"), "none": np.zeros((0, 3), "uint8")}
    rows = [(n, "s", 0, list(a.shape), "uint8", bytearray(a.tobytes()), None) for n, a in volumes.items()]
    decoded = spark.createDataFrame(rows, f"{B.KEY_DDL}, shape array<bigint>, dtype string, payload binary, error string")
    blocks = B.raw_blocks(decoded.where("dataset_id != 'four'"), [3, 2]).unionByName(B.raw_blocks(decoded.where("dataset_id = 'four'"), [2, 2, 2, 2]))
    found = {r["dataset_id"]: r for r in B.inventory(blocks).collect()}
    assert {n: found[n]["shape"] for n in volumes} == {n: list(a.shape) for n, a in volumes.items()}
    assert found["none"]["blocks"] == 2 and found["none"]["nbytes"] == 0
    assert {r["dataset_id"] for r in B.tree_digest(blocks, 4).collect()} == set(volumes)
    grid = {r["dataset_id"]: r["count"] for r in P.chunk_grid(B.inventory(blocks).where("dataset_id != 'none'")).groupBy("dataset_id").count().collect()}
    assert grid == {"two": 9, "four": 12}
    requests = spark.createDataFrame([(1, "two", "s", 0, [1, 1], [5, 3]), (2, "four", "s", 0, [0, 1, 0, 2], [3, 2, 2, 9])],
        "request_id bigint, dataset_id string, array_name string, level int, start array<bigint>, size array<bigint>")
    crops = {r["request_id"]: bytes(r["payload"]) for r in B.assemble_crops(B.crop_pieces(requests, blocks, B.inventory(blocks))).collect()}
    assert crops == {1: volumes["two"][1:6, 1:4].tobytes(), 2: volumes["four"][0:3, 1:3, :, 2:].tobytes()}

def test_value_hash_has_no_size_limit(spark):
    values = spark.createDataFrame([(1, bytearray(b"x" * (9 << 20))), (2, bytearray(b"")), (3, None)], "k long, b binary")
    rows = {r["k"]: (r["nbytes"], r["sha256"]) for r in B.value_sha256(values, "k", F.col("b")).collect()}
    assert rows[1] == (9 << 20, hashlib.sha256(b"x" * (9 << 20)).hexdigest())
    assert rows[2] == rows[3] == (0, hashlib.sha256(b"").hexdigest())


def test_tree_digest_depends_on_content_only(spark, blocks, arrays):
    one = {r["dataset_id"]: r["tree_sha256"] for r in B.tree_digest(blocks, 4).collect()}
    alone = B.tree_digest(blocks_of(spark, {"c": arrays["c"]}, parts=1), 4).first()
    assert alone["tree_sha256"] == one["c"]
    other = dict(arrays, a=arrays["a"] + 1)
    changed = {r["dataset_id"]: r["tree_sha256"] for r in B.tree_digest(blocks_of(spark, other), 4).collect()}
    assert changed["a"] != one["a"] and changed["b"] == one["b"]


def test_stored_blocks_read_back(spark, blocks, arrays, tmp_path):
    ST.write_blocks(blocks, str(tmp_path / "t"))
    back = ST.read_blocks(spark, str(tmp_path / "t"))
    assert all(np.array_equal(a, arrays[n]) for (n, _), a in whole(back).items())
    other = blocks_of(spark, {"z": arrays["a"], "b": arrays["b"] + 1})
    ST.write_blocks(other, str(tmp_path / "t"))
    back = whole(ST.read_blocks(spark, str(tmp_path / "t")))
    assert np.array_equal(back["a", 0], arrays["a"]) and np.array_equal(back["c", 0], arrays["c"])
    assert np.array_equal(back["z", 0], arrays["a"]) and np.array_equal(back["b", 0], arrays["b"] + 1)
    one = ST.read_blocks(spark, str(tmp_path / "t"), "a")
    assert set(whole(one)) == {("a", 0)}
    files = {r["file"] for r in ST.zones(spark, str(tmp_path / "t")).where("dataset_id = 'a'").collect()}
    assert len(one.inputFiles()) == len(files)


def test_raw_decode_reports_wrong_sizes(spark):
    df = spark.sql("SELECT array(1L, 2L, 3L) AS shape, 'uint8' AS dtype, X'010203040506' AS payload UNION ALL SELECT array(2L, 2L, 2L), 'int16', X'0102'")
    good, bad = sorted(B.decode_raw(df).collect(), key=lambda r: r["error"] or "")
    assert good["error"] is None and bytes(good["payload"]) == bytes(range(1, 7))
    assert bad["error"] == "3D block has size 2 (expected 16)" and bad["payload"] is None


def test_random_origins_stay_inside_and_cover_the_room(spark):
    df = spark.range(3000).selectExpr("id", "array(0L, 5L, 7L) AS start", "array(3L, 9L, 7L) AS stop", "array(2L, 2L, 1L) AS size")
    at = df.select(B.random_origin(F.col("id"), F.col("start"), F.col("stop"), F.col("size"), 1).alias("o"))
    seen = {tuple(r["o"]) for r in at.collect()}
    assert seen == {(z, y, 7) for z in range(3) for y in range(5, 9)}
    assert at.exceptAll(at.repartition(5)).count() == 0


def test_published_array_sizes_and_plans(spark):
    shapes = [(564, 2520, 2596), (282, 1260, 1298), (141, 630, 649), (70, 315, 324)]
    df = spark.createDataFrame([(list(s),) for s in shapes], "shape array<bigint>").withColumn("chunks", F.lit([64, 64, 64]).cast("array<bigint>"))
    mb = P.size_mb(F.col("shape"), F.lit(2))
    rows = df.select(
        F.round(mb, 1).alias("mb"), P.size_class(mb).alias("kind"), P.stream_chunks(F.col("shape"), F.lit(2), 64, 8).alias("stream"),
        P.pyramid_levels(F.col("shape"), F.lit(2), 32).alias("levels"), P.memory_chunks(F.col("shape"), F.col("chunks"), mb).alias("plan"),
    ).collect()
    assert [r["mb"] for r in rows] == [7037.4, 879.7, 110.0, 13.6]
    assert [r["kind"] for r in rows] == ["LARGE", "LARGE", "MEDIUM", "SMALL"]
    assert rows[0]["stream"] == [17, 78, 81]
    assert [r["levels"] for r in rows] == [1, 1, 0, 0]
    assert rows[2]["plan"] == [35, 64, 64] and rows[3]["plan"] == [64, 64, 64]


def test_grid_covers_each_array_once(spark):
    df = spark.createDataFrame([("x", [9, 11, 13], [4, 5, 6]), ("y", [1, 1, 1], [4, 5, 6])], "array_name string, shape array<bigint>, chunks array<bigint>")
    grid = P.chunk_grid(df).collect()
    seen = np.zeros((9, 11, 13), int)
    for r in grid:
        if r["array_name"] == "x":
            seen[tuple(slice(o, o + n) for o, n in zip(r["origin"], r["size"]))] += 1
    assert (seen == 1).all() and len(grid) == 3 * 3 * 3 + 1


def test_store_job_keeps_or_reduces_by_size(spark, blocks, arrays, tmp_path):
    plan = {r["dataset_id"]: r for r in I.store_arrays(blocks, str(tmp_path / "all"), 2000).collect()}
    stored = whole(ST.read_blocks(spark, str(tmp_path / "all")))
    for name, a in arrays.items():
        assert np.array_equal(stored[name, 0], a)
        assert plan[name]["strategy"] == "direct" and plan[name]["mean"] == pytest.approx(a.mean(dtype="float64"))
    limit = arrays["a"].nbytes / 1048576 - 1e-6
    for mode in ("skip", "downsample"):
        labelled = {r["dataset_id"]: r for r in I.store_arrays(blocks, str(tmp_path / mode), limit, mode).collect()}
        assert labelled["a"]["strategy"] != "direct" and labelled["a"]["mean"] == pytest.approx(arrays["a"].mean(dtype="float64"))
        kept = whole(ST.read_blocks(spark, str(tmp_path / mode)))
        assert all(np.array_equal(kept[n, 0], arrays[n]) for n in arrays)
    both = blocks.unionByName(blocks.withColumn("level", F.lit(1)))
    rows = I.store_arrays(both, str(tmp_path / "levels"), 2000).collect()
    assert sorted((r["dataset_id"], r["level"]) for r in rows) == [(n, k) for n in "abc" for k in (0, 1)]


def test_rechunk_per_array(blocks, arrays):
    per_row = F.when(F.col("dataset_id") == "a", F.lit([2, 2, 2])).otherwise(F.lit([9, 9, 9]))
    moved = B.rechunk(blocks, per_row)
    assert all(np.array_equal(v, arrays[n]) for (n, _), v in whole(moved).items())
    assert moved.where("dataset_id = 'a'").count() == 5 * 6 * 7


def test_two_stores_give_two_results(spark, blocks, tmp_path):
    path = str(tmp_path / "s")
    one = I.store_arrays(blocks.where("dataset_id = 'a'"), path, 2000).collect()
    two = I.store_arrays(blocks.where("dataset_id = 'b'"), path, 2000).collect()
    assert {r["dataset_id"] for r in one} == {"a"} and {r["dataset_id"] for r in two} == {"b"}
    assert {n for n, _ in whole(ST.read_blocks(spark, path))} == {"a", "b"}


def test_curve_is_a_bijection_and_cells_are_stretches(spark):
    df = spark.range(8 * 8 * 8).select(F.array(F.floor(F.col("id") / 64), F.floor(F.col("id") / 8) % 8, F.col("id") % 8).cast("array<bigint>").alias("idx"))
    rows = df.select("idx", ST.curve_position(F.col("idx")).alias("c"), ST.cell_of(ST.curve_position(F.col("idx")), F.lit(1), F.lit(3)).alias("cell")).collect()
    assert {r["c"] for r in rows} == set(range(512))
    for r in rows:
        z, y, x = r["idx"]
        assert r["c"] == sum((n >> b & 1) << (3 * b + k) for k, n in enumerate((x, y, z)) for b in range(3))
        assert r["cell"] == r["c"] >> 3
    far = spark.sql("SELECT array(5000000000L, 3L, 1L) AS idx UNION ALL SELECT array(9000000000L, 3L, 1L)")
    assert far.select(ST.curve_position(F.col("idx"))).distinct().count() == 1


def test_lookups_read_few_files(spark, tmp_path):
    """Boxes from a store equal slices, and files without a touched cell stay closed."""
    rng = np.random.default_rng(1)
    a = {"v": rng.integers(0, 255, (40, 44, 48)).astype("uint8"), "w": rng.integers(0, 255, (9, 9, 9)).astype("uint8")}
    path = str(tmp_path / "s")
    spark.conf.set("spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor", "0.01")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        ST.write_blocks(blocks_of(spark, a, (4, 4, 4), 6), path, cell_bytes=8 * 64)
    finally:
        spark.conf.unset("spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    zones = ST.zones(spark, path)
    assert zones.select("file").distinct().count() > 5
    boxes = [(1, "v", [0, 0, 0], [5, 6, 7]), (2, "v", [36, 40, 44], [9, 9, 9]), (3, "w", [-3, 2, 2], [5, 1, 1]), (4, "v", [99, 0, 0], [1, 1, 1])]
    requests = spark.createDataFrame([(i, n, "s0", 0, s, z) for i, n, s, z in boxes], "request_id bigint, dataset_id string, array_name string, level int, start array<bigint>, size array<bigint>")
    crops = {r["request_id"]: r for r in B.assemble_crops(ST.store_lookup(requests, path)).collect()}
    assert set(crops) == {1, 2, 3}
    for i, n, s, z in boxes[:3]:
        want = a[n][tuple(slice(max(0, p), p + q) for p, q in zip(s, z))]
        assert bytes(crops[i]["payload"]) == want.tobytes()
    one = ST.matching_files(requests.where("request_id = 1"), zones)
    assert 0 < one.count() < zones.select("file").distinct().count()
    inventory = {r["dataset_id"]: r for r in ST.stored_inventory(zones).collect()}
    assert inventory["v"]["shape"] == [40, 44, 48] and inventory["v"]["blocks"] == 10 * 11 * 12 and inventory["w"]["nbytes"] == 729
    with pytest.raises(ValueError, match="no block store"):
        ST.read_blocks(spark, str(tmp_path / "none"))


def test_replacing_a_data_set_keeps_those_in_the_same_file(spark, tmp_path):
    a = {n: np.full((4, 4, 4), i, "uint8") for i, n in enumerate("abc")}
    path = str(tmp_path / "s")
    ST.write_blocks(blocks_of(spark, a, (4, 4, 4), 1), path, spread=False)
    ST.write_blocks(blocks_of(spark, {"b": a["b"] + 7}, (4, 4, 4), 1), path)
    got = whole(ST.read_blocks(spark, path))
    assert {n: int(v[0, 0, 0]) for (n, _), v in got.items()} == {"a": 0, "b": 8, "c": 2}
    assert ST.read_blocks(spark, path).count() == 3


def test_hot_blocks_are_cut_in_lists(spark, blocks, arrays):
    n = 2_500
    requests = spark.range(n).selectExpr(
        "id AS request_id", "'a' AS dataset_id", "'s0' AS array_name", "0 AS level", "array(0L, 0L, id % 3) AS start", "array(2L, 2L, 2L) AS size"
    )
    pieces = B.crop_pieces(requests, blocks, B.inventory(blocks), list_boxes=100, axes=3)
    assert pieces.count() == n
    sums = {r["request_id"]: int(np.frombuffer(bytes(r["payload"]), "uint8").sum()) for r in pieces.collect()}
    assert all(sums[i] == int(arrays["a"][:2, :2, i % 3 : i % 3 + 2].sum()) for i in range(n))


def test_raw_files_by_ranges(spark, blocks, arrays, tmp_path):
    """Three orders of axes, a slab per plane; a file is larger than a slab; wrong files are named."""
    for axes in ("zyx", "xyz", "yxz"):
        folder = str(tmp_path / axes)
        written = R.write_raw_files(blocks, folder, axes)
        sizes = {r["dataset_id"]: r["bytes"] for r in written.collect()}
        assert sizes == {n: a.nbytes for n, a in arrays.items()}
        a = next(r["path"] for r in written.collect() if r["dataset_id"] == "a")
        order = tuple("zyx".index(c) for c in axes)
        assert open(a, "rb").read() == np.ascontiguousarray(arrays["a"].transpose(order)).tobytes()
        assert R.slabs(R.checked(written), 150).where("dataset_id = 'a'").count() > 3
        back = whole(R.raw_file_blocks(written, [4, 5, 6], slab_bytes=150))
        assert all(np.array_equal(back[n, 0], arrays[n]) for n in arrays)
    wrong = written.withColumn("bytes", F.when(F.col("dataset_id") == "a", 3).when(F.col("dataset_id") == "b", None).otherwise(F.col("bytes")))
    errors = {r["dataset_id"]: r["error"] for r in R.checked(wrong.withColumn("axes", F.when(F.col("dataset_id") == "c", F.lit("zzx")).otherwise(F.col("axes")))).collect()}
    assert errors == {"a": "3D block has size 3 (expected 1287)", "b": "no such file", "c": "axes zzx do not fit the shape"}
    assert {n for n, _ in whole(R.raw_file_blocks(wrong, [4, 5, 6]))} == {"c"}


def test_quantiles_stay_within_their_error(spark):
    rng = np.random.default_rng(4)
    a = {"big": rng.normal(size=(40, 40, 40)).astype("float64"), "few": rng.integers(0, 9, (7, 8, 9)).astype("uint8")}
    df = blocks_of(spark, a, (8, 8, 8), 5)
    shares = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0]
    rows = Q.volume_quantiles(df, shares, size=64, fan_in=4).collect()
    assert len(rows) == 2 * len(shares)
    for r in rows:
        flat = np.sort(a[r["dataset_id"]].ravel())
        low, high = np.searchsorted(flat, r["value"], "left") / flat.size, np.searchsorted(flat, r["value"], "right") / flat.size
        assert low - r["rank_error"] - 1e-9 <= r["q"] <= high + r["rank_error"] + 1e-9
        assert r["rank_error"] < 0.1 and (r["dataset_id"] == "big" or r["rank_error"] == 0)
    again = Q.volume_quantiles(df.repartition(11), shares, size=64, fan_in=4).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    assert Q.merge_summaries(Q.block_summaries(df, 64), 4, 64, 4).where("size(values) > 64").count() == 0
    nan = blocks_of(spark, {"n": np.full((2, 2, 2), np.nan)}, (2, 2, 2), 1)
    assert [r["value"] for r in Q.volume_quantiles(nan, [0.5]).collect()] == [None]


def test_few_rows_of_a_batch_are_objects_at_a_time():
    """Lists of boxes and payloads: a batch of 8 MB never lies in Python whole, and all of its rows come."""
    boxes = [{"request_id": i, "lo": [i, 0, 0], "hi": [i, 6, 6]} for i in range(250)]
    kind = pa.list_(pa.struct([("request_id", pa.int64()), ("lo", pa.list_(pa.int64())), ("hi", pa.list_(pa.int64()))]))
    one = pa.array([boxes], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.concat_arrays([one] * 400)], ["n", "boxes"])
    assert batch.nbytes > 6 << 20
    tracemalloc.start()
    seen = [(row["n"], len(row["boxes"]), row["boxes"][249]["lo"][0]) for row in B._rows(iter([batch, batch.slice(0, 0)]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == [(n, 250, 249) for n in range(400)]
    assert peak < 16 << 20
    wide = pa.RecordBatch.from_arrays([pa.array([bytes(1 << 20)] * 3, pa.binary())], ["payload"])
    assert [len(row["payload"]) for row in B._rows(iter([wide]))] == [1 << 20] * 3
