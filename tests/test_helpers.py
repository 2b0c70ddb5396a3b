"""Names, globs, lookups, merges, ordered totals, streaming and packaging."""

import fnmatch
import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.test_validate import GOOD
from voxledger.functions import text as TX
from voxledger.functions.globs import glob_to_regex
from voxledger.operators import records as R
from voxledger.operators import runs as U
from voxledger.operators import similarity as N
from voxledger.operators.ordered import previous, running, span_of
from voxledger.streaming import jobs as X


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(0).alias("_z"))
    return row.select(column).first()[0]


@pytest.mark.parametrize("pattern", ["*metadata*.json", "a?c", "[ab]x", "[!ab]x", "*.tmp", "a.b", "[]", "a[1", "[a-c]*", "x+y(z)", "[^a]x", "[]a]x"])
def test_globs_match_like_the_shell(spark, pattern):
    names = ["metadata.json", "x_metadata_1.json", "abc", "ac", "ax", "bx", "cx", "f.tmp", "a.b", "aXb", "[]", "a[1", "x+y(z)", "^x", "]x", "Metadata.json", "a\nmetadata.json"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r["n"] for r in df.where(F.col("n").rlike(glob_to_regex(pattern))).collect()}
    assert got == {n for n in names if fnmatch.fnmatchcase(n, pattern)}


def test_names(spark):
    assert one(spark, TX.timestamp_in_name(F.col("n")), n="metadata_x_20250611_221633.json") == "20250611_221633"
    assert one(spark, TX.timestamp_in_name(F.col("n")), n="volume_20250611_221633.json") is None
    assert one(spark, TX.timestamp_in_name(F.col("n")), n="metadata.json") is None
    assert one(spark, TX.stem(F.col("n")), n="/a.b/slice_01.tar.gz") == "slice_01.tar"
    assert one(spark, TX.stem(F.col("n")), n="/a/.hidden") == ".hidden"
    assert one(spark, TX.metadata_name(F.col("n"), F.lit("t")), n="fibsem/s0") == "metadata_fibsem_s0_t.json"
    assert one(spark, TX.swap_suffix(F.col("n"), ".npy", "_metadata.json"), n="/v/a.npy") == "/v/a_metadata.json"
    assert one(spark, TX.object_key(F.col("n")), n="s3://bucket/a/b.zarr") == "a/b.zarr"
    assert one(spark, TX.bucket_name(F.col("n")), n="s3://bucket/a/b.zarr") == "bucket"
    assert one(spark, TX.object_key(F.col("n")), n="s3://bucket") == ""
    assert one(spark, TX.duration_text(F.col("s")), s=1211) == "00:20:11"
    assert [one(spark, TX.eta_text(F.col("s")), s=float(s)) for s in (7201, 90, 60, 5)] == ["2.0h", "1.5m", "60s", "5s"]


def test_deep_merge(spark):
    base = {"a": {"x": 1, "y": [1, 2]}, "b": {"c": {"d": 1}}, "k": 1}
    extra = {"a": {"y": [3]}, "b": {"c": {"e": None}}, "k": {"now": "object"}, "n": 1}
    got = one(spark, R.deep_merge(F.col("l"), F.col("r")), l=json.dumps(base), r=json.dumps(extra))
    assert json.loads(got) == {"a": {"x": 1, "y": [3]}, "b": {"c": {"d": 1, "e": None}}, "k": {"now": "object"}, "n": 1}


def test_status_updates_count_failures_and_keep_errors(spark):
    now = F.lit("t1")
    df = spark.range(1).withColumn("record", R.to_record(R.new_record(F.lit("ebi"), F.lit("1"), F.lit("d"), F.lit("id"), F.lit("t0"), {"commit_sha": "c"})))
    df = R.update_status(df, F.lit("failed"), now, message=F.lit("first"))
    df = R.update_status(df, F.lit("failed"), now, message=F.lit(""), traceback=F.lit("tb"))
    df = R.update_status(df, F.lit("complete"), now, percentage=F.lit(100.0), step=F.lit("done"))
    r = df.first()["record"].asDict(recursive=True)
    assert (r["status"], r["created_at"], r["updated_at"]) == ("complete", "t0", "t1")
    assert r["error"] == {"retry_count": 2, "message": "first", "traceback": "tb"}
    assert r["progress"] == {"percentage": 100.0, "current_step": "done"}
    assert r["ci_metadata"] == {"commit_sha": "c"}
    assert R.run_provenance({}) is None
    assert R.run_provenance({"EM_CI_METADATA": "true", "RUNNER_OS": "Linux"})["runner_os"] == "Linux"
    random_id = spark.range(2).select(R.to_record(R.new_record(F.lit("a"), F.lit("b"), F.lit("c"))).alias("r"))
    assert random_id.select("r.id").distinct().count() == 2


def test_running_totals_with_a_hot_key(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), F.col("id").alias("o"), (F.col("id") % 11).alias("v")
    )
    rows = sorted(df.collect(), key=lambda r: r["o"])
    for inclusive in (False, True):
        seen, want = {}, {}
        for r in rows:
            before = seen.get(r["k"], 0)
            seen[r["k"]] = before + r["v"]
            want[r["o"]] = seen[r["k"]] if inclusive else before
        for span in (1, 37, 5000):
            got = running(df, ["k"], "o", {"s": F.col("v")}, inclusive, span)
            assert {r["o"]: r["s"] for r in got.collect()} == want
    last, before = {}, {}
    for r in rows:
        before[r["o"]] = last.get(r["k"])
        last[r["k"]] = r["v"]
    assert {r["o"]: r["p"] for r in previous(df, ["k"], "o", {"p": "v"}).collect()} == before


def test_log_precedence(spark):
    logs = {
        "a": ["exited with code 0", "ERROR x"], "b": ["exited with code 2", "exited with code 137"], "c": ["SUCCESS: file Saved"],
        "d": ["ModuleNotFoundError: config_manager"], "e": ["Traceback"], "f": ["hello"],
    }
    rows = [(1 if s != "e" else 2, n, s, f"{s}-ingest {line}") for s, lines in logs.items() for n, line in enumerate(lines)]
    got = U.log_outcome(spark.createDataFrame(rows, "log_id bigint, line_no bigint, service string, line string"))
    assert {r["service"]: r["outcome"] for r in got.collect()} == {
        "a": "success", "b": "failed:137", "c": "success_words", "d": "config_error", "e": "error_words", "f": "config_error",
    }


def test_service_lists_name_and_count_every_service(spark):
    rows = [(1, "b", "success"), (1, "a", "failed:2"), (1, "c", "success_words"), (1, "d", "in_progress"), (2, "a", "success"), (3, "z", "config_error")]
    rows += [(4, f"svc{i}", "success" if i % 2 else "error_words") for i in range(3_000)]
    got = {r["log_id"]: tuple(r)[1:] for r in U.service_lists(spark.createDataFrame(rows, "log_id bigint, service string, outcome string").repartition(5)).collect()}
    odd, even = (",".join(sorted(f"svc{i}" for i in range(k, 3_000, 2))) for k in (1, 0))
    assert got == {1: ("a,d", "b,c", 2, 2), 2: ("", "a", 0, 1), 3: ("z", "", 1, 0), 4: (even, odd, 1_500, 1_500)}


def test_top_k_equals_brute_force(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    m = rng.normal(size=(60, 8))
    m[10:40] = m[5]  # copies tie and are ranked by id
    index = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id bigint, embedding array<double>").repartition(5)
    queries = index.where("vec_id < 7").withColumnRenamed("vec_id", "query_id")
    got = {(r["query_id"], r["place"]): r["vec_id"] for r in N.top_k(index, queries, 4).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(7):
        score = np.round(unit @ unit[q], 12)
        if q != 5:
            want = sorted(range(60), key=lambda i: (-score[i], i))[:4]
            assert [got[q, p] for p in range(1, 5)] == want
    assert {got[5, p] for p in range(1, 5)} <= {5, *range(10, 40)}
    monkeypatch.setattr(N, "MOST_QUERY_NUMBERS", 55)
    with pytest.raises(ValueError, match="56 numbers"):
        N.top_k(index, queries, 4)


def test_top_k_leaves_out_vectors_that_do_not_fit(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (1, [0.9, 0.1, 0.0]), (2, None), (3, [1.0]), (4, [1.0, None, 0.0]), (5, [0.0, 0.0, 1.0])]
    index = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = N.top_k(index, index.where("vec_id IN (0, 2, 3)").withColumnRenamed("vec_id", "query_id"), 3).collect()
    assert sorted((r["query_id"], r["place"], r["vec_id"]) for r in got) == [(0, 1, 0), (0, 2, 1), (0, 3, 5)]


def test_watched_folder(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "metadata_1.json").write_text(json.dumps(GOOD))
    (inbox / "metadata_2.json").write_text("{bad")
    seen = []

    def sink(batch, number):
        seen.extend((r["file"].rsplit("/", 1)[1], r["valid"]) for r in batch.collect())

    for extra in (None, "metadata_3.json"):
        if extra:
            (inbox / extra).write_text("{}")
        X.watch_folder(spark, str(inbox), sink, [str(tmp_path)], str(tmp_path / "state")).awaitTermination()
    assert sorted(seen) == [("metadata_1.json", True), ("metadata_2.json", False), ("metadata_3.json", False)]


def test_late_events_are_dropped_and_counted(spark, tmp_path):
    source = str(tmp_path / "src")
    for n, stamps in enumerate((["2024-01-01 10:00:00", "2024-01-01 10:00:00"], ["2024-01-03 00:00:00"], ["2024-01-01 09:00:00"])):
        rows = [(n * 10 if i == 0 or n else 0, s) for i, s in enumerate(stamps)]
        spark.createDataFrame(rows, "event_id bigint, t string").selectExpr("event_id", "timestamp(t) AS ts").coalesce(1).write.mode("append").parquet(source)
    stream = X.arriving_table(spark, source, "event_id bigint, ts timestamp", files_per_batch=1)
    query = (
        X.without_repeats(stream, ["event_id"]).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 10]
    assert X.late_rows(query) == 1


def test_entry_and_workers_from_another_folder(tmp_path):
    """Python workers find the package although it is not on their path."""
    root = Path(__file__).resolve().parents[1]
    code = (
        "import importlib.util as u\n"
        f"s = u.spec_from_file_location('e', {str(root / '__spark_entry__.py')!r}); m = u.module_from_spec(s); s.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert m.entry(spark).count() > 0\n"
        "assert m.queries()['vol_stats'](spark, '/root/testdata/sf0.001').count() > 0\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]


def test_sparse_order_values_make_even_spans(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("k"), (F.col("id") * 137_000_000).alias("o"))
    sizes = [r["count"] for r in df.groupBy(span_of(df, "o", 500)).count().collect()]
    assert len(sizes) > 30 and max(sizes) < 1_500 and sum(sizes) == 20_000
    got = running(df, ["k"], "o", {"n": F.lit(1).cast("bigint")}, True, 500)
    assert got.where("n != o / 137000000 + 1").count() == 0


def test_merging_keeps_going_after_a_bad_record(spark):
    rows = [('{"a": {"b": 1}}', '{"a": {"c": 2}}'), (None, '{"x": 1}'), ('{"x": 1}', None), ("{broken", "{}"), ("{}", "nope")]
    df = spark.createDataFrame(rows, "base string, extra string")
    got = df.select(R.deep_merge("base", "extra").alias("m"), R.merge_error("base", "extra").alias("e")).collect()
    assert [r["m"] for r in got] == ['{"a": {"b": 1, "c": 2}}', '{"x": 1}', '{"x": 1}', None, None]
    assert [r["e"] for r in got] == [None, None, None, "base is not JSON", "extra is not JSON"]
