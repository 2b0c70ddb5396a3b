"""Quality, archives, mixing and the pipeline."""

import base64
import hashlib
import io
import zipfile
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import awkward, awkward_rows, empty, rows
from tests.oracle import compare
from voxledger.llm import mixing, quality, simhash, warc_zip
from voxledger.llm.suite import ORACLES, QUERIES
from voxledger.session import shared_dir


def test_quality_on_held_out_labels(spark, sf_dir):
    scored = QUERIES["op7_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held = scored.join(labels, "doc_id").where("held_out").toPandas()
    assert (held["predicted"] == held["quality"]).mean() > 0.9
    assert scored.where("score < 0 or score > 1 or predicted != int(score >= 0.3)").count() == 0


def test_rules_in_spark_equal_rules_in_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, len(quality.STATISTICS)))
    y = ((x[:, 1] > 0.5) & (x[:, 3] <= 0.7)).astype(float)
    ensemble = quality.train(x, y)
    assert 0 < len(ensemble.rules) < 80
    margin = ensemble.bias + sum(r.weight * r.holds(x) for r in ensemble.rules)
    df = spark.createDataFrame([[i, *map(float, v)] for i, v in enumerate(x)], ["i", *quality.STATISTICS])
    got = [r[0] for r in df.orderBy("i").select(ensemble.score()).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-margin)))
    assert (((np.array(got) > 0.5) == y).mean()) > 0.97
    again = quality.train(x, y)
    assert again == ensemble


def test_statistics_equal_plain_counting(spark, sf_dir):
    import re

    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()]
    texts += ["", None, " \n\t ", "A1! É\n\nA1! É", "日本 日本", "#$%\x0b.,;", "one\nTWO\none"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    got = {r["id"]: r for r in df.select("id", *quality.statistics(F.col("text"))).collect()}
    for i, text in enumerate(texts):
        t = text or ""
        words, lines = [w for w in re.split("[ \t\n\x0b\f\r]+", t.lower()) if w], [x for x in t.split("\n") if x]
        count = lambda among: sum(c in among for c in t)
        share = lambda a, b: a / b if b else 0.0
        full = len(t) - count(" \t\n\x0b\f\r")
        marks, digits, stops = count(quality.MARKS), count("0123456789"), count(".,;:?'\"()-")
        want = [
            len(t), len(words), share(full, len(words)), share(len(words), len(lines)), share(full - marks - digits - stops, len(t)),
            share(count("ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÀÇÊÑÍÓÁÚ"), len(t)), share(marks, len(t)), share(digits, len(t)),
            share(len(set(words)), len(words)), share(len(set(lines)), len(lines)), share(stops, len(words)),
        ]
        assert [got[i][s] for s in quality.STATISTICS] == pytest.approx(want), t[:40]


def test_quality_of_awkward_and_unlabelled_tables(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100, 140)] + [(None, 1, 0), (4, None, 0), (4, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.quality_table(awkward(spark), labels)
    assert got.count() == len(awkward_rows())
    assert rows(got) == rows(quality.quality_table(awkward(spark, clashing=True), labels))
    none = quality.quality_table(awkward(spark), labels.limit(0))
    assert none.select("score").distinct().collect() == [(0.5,)]
    assert quality.quality_table(empty(spark), labels).count() == 0


def brute_pages(pages, least=0):
    largest = {}
    for page, _, html in pages:
        body = (html or "").encode()
        if page is not None:
            largest[body] = max(largest.get(body, page), page)
    out = []
    for page, _, html in pages:
        body = (html or "").encode()
        again = len(body) >= least and body in largest and page != largest[body]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "revisit" if again else "response", largest[body] if again else None))
    return sorted(out, key=repr)


PAGES = [
    (1, "http://a/1", "<p>é</p>"),
    (2, "http://a/2\r\nX: y", "<p>é</p>"),
    (3, None, None),
    (4, "http://a/4", ""),
    (5, "http://a/5", "x\r\n\r\nWARC/1.1\r\n" * 50),
    (7, "http://a/7", "<p>é</p>"),
    (7, "http://a/7", "<p>é</p>"),
    (None, "http://a/n", "only"),
    (None, None, "<p>é</p>"),
    (9, "http://a/9", "long " * 200_000),
]
PAGE = "page_id long, url string, html string"


def test_archives_round_trip(spark):
    got = rows(warc_zip.archive_table(spark, spark.createDataFrame(PAGES, PAGE)).drop("intact"))
    assert got == brute_pages(PAGES)
    clashing = spark.createDataFrame(PAGES, PAGE).withColumns({c: F.lit("x") for c in ("id", "key", "payload", "of", "largest")})
    assert rows(warc_zip.archive_table(spark, clashing).drop("intact")) == got
    assert warc_zip.archive_table(spark, empty(spark, PAGE)).count() == 0


def test_archive_query_equals_brute_force(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op6_warc"](spark, sf_dir)
    assert rows(got.drop("intact")) == brute_pages(pages)
    assert got.where("not intact").count() == 0


def test_packages_of_many_members_and_a_least_size(spark):
    pages = [(i, f"http://a/{i}", f"text {i % 7} " * 40) for i in range(60)] + [(100 + i, "u", "s") for i in range(3)]
    df = spark.createDataFrame(pages, PAGE).coalesce(1)
    packages = warc_zip.write_packages(df, shared_dir(spark, "warc-test"), least_bytes=2, member_bytes=200, package_bytes=1_000)
    assert packages.count() > 2
    records = warc_zip.read_packages(packages)
    assert records.where("type = 'response' and not intact").count() == 0
    assert records.where("id >= 100 and type = 'revisit'").count() == 0
    body = {int(r["id"]): r["payload"] for r in records.where("payload is not null").collect()}
    assert all(bytes(body[i]).decode() == h for i, _, h in pages if i in body)
    assert {r["refers_to"] for r in records.where("type = 'revisit'").collect()} == {str(i) for i in range(53, 60)}


def zip_bytes(members, wide=False, method=zipfile.ZIP_STORED, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for name, content in members:
            with z.open(name, "w", force_zip64=wide) as f:
                f.write(content)
        z.comment = comment
    return out.getvalue()


@pytest.mark.parametrize("comment", [b"", b"a note PK"])
def test_central_directory_against_the_standard_library(comment):
    raw = zip_bytes([("a", b"x" * 100), ("b/ü", b"yz")], wide=True, comment=comment)
    file = io.BytesIO(raw)
    members = warc_zip.central_directory(file, len(raw))
    assert [(m.name, m.size) for m in members] == [("a", 100), ("b/ü", 2)]
    assert warc_zip.read_range(file, warc_zip.content_start(file, members[1]), 2) == b"yz"


def test_zip64_end_records(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    raw = zip_bytes([(f"m{i}", bytes([i]) * 60) for i in range(5)], wide=True)
    assert warc_zip.LOCATE64 in raw
    file = io.BytesIO(raw)
    members = warc_zip.central_directory(file, len(raw))
    assert [m.name for m in members] == [f"m{i}" for i in range(5)]
    assert warc_zip.read_range(file, warc_zip.content_start(file, members[4]), 60) == b"\4" * 60


def test_members_without_an_index_are_walked():
    import gzip

    parts = [gzip.compress(warc_zip.record_bytes(str(i), "u", b"z" * i * 999, "D", None)) for i in range(6)]
    raw = zip_bytes([("archive/x.warc.gz", b"".join(parts))])
    file = io.BytesIO(raw)
    places = list(warc_zip.record_places(file, len(raw)))
    got = [warc_zip.parse_record(zlib.decompress(warc_zip.read_range(file, o, n), 31))["id"] for o, n in places]
    assert got == [str(i) for i in range(6)]
    packed = zip_bytes([("archive/x.warc.gz", b"".join(parts))], method=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="compressed"):
        list(warc_zip.record_places(io.BytesIO(packed), len(packed)))
    with pytest.raises(ValueError, match="no end record"):
        warc_zip.central_directory(io.BytesIO(b"x" * 100), 100)


def test_mixing_equals_sql(spark, sf_dir):
    error, n, _ = compare("op9_mixing", QUERIES["op9_mixing"], ORACLES["op9_mixing"], spark, sf_dir)
    assert error is None and n > 0


def test_mixing_of_awkward_rows_equals_sql(spark):
    docs = awkward(spark)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    want = sorted((tuple(None if v != v else v for v in r) for r in con.execute(mixing.MIX_SQL).fetchall()), key=repr)
    near = lambda t: tuple(round(x, 9) if isinstance(x, float) else x for x in t)
    got = mixing.mix_table(docs).select("doc_id", "size", "source_size", "target", "taken", "first_position")
    assert [near(r) for r in rows(got)] == [near(r) for r in want]


def test_mixing_bounds_and_buckets(spark):
    docs = awkward(spark, clashing=True)
    whole = mixing.mix_sources(docs, bucket_rows=1_000_000)
    assert rows(whole) == rows(mixing.mix_sources(docs, bucket_rows=2))
    sums = whole.groupBy("source", "target").agg(F.sum(F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["taken"])).alias("taken"))
    assert sums.where("taken != floor(target)").count() == 0
    assert whole.where(F.exists("passes", lambda p: (p["position"] < 0) | (p["position"] > 1) | (p["taken"] > F.col("size")))).count() == 0
    assert mixing.mix_table(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert rows(mixing.mix_table(blank).select("doc_id", "target", "taken")) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_positions_invert_the_demand(spark):
    first, target = 1.5, 1000.0
    df = spark.createDataFrame([(float(w),) for w in range(0, 1001, 50)], "w double")
    for w, t in df.select("w", mixing.position(F.col("w"), F.lit(target), F.lit(first))).collect():
        assert abs(target * (first * t + (1 - first) * t * t) - w) < 1e-6


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    columns, kept = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = shared_dir(spark, "stage")
        out = stage(spark, kept[-1], sf_dir)
        assert out.columns == columns
        out.write.parquet(path)
        kept.append(spark.read.parquet(path))
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in kept]
    assert ids[1] == ids[0]
    low = {(r["doc_id"]) for r in simhash.near_duplicates(kept[1]).where("doc_id = component_id").collect()}
    assert ids[2] == low and kept[2].count() == len(low)
    assert ids[3] < ids[2] and ids[4] == ids[3]
    from voxledger.llm.decontaminate import contamination_table

    assert contamination_table(kept[3], bench).where("contaminated").count() == 0
    from voxledger.llm.secrets import secret_table

    assert secret_table(kept[4]).where("spans != ''").count() == 0
    assert kept[4].where("n_chars != char_length(text)").count() == kept[3].where("n_chars != char_length(text)").count()
    mixed = corpus_pipeline.mixing_stage(spark, kept[4], sf_dir)
    assert rows(mixed) == rows(mixing.curriculum(kept[4]).select(F.col("id").alias("doc_id"), "source", "epoch", "taken", "position"))
    assert {r["doc_id"] for r in mixed.collect()} <= ids[4]


@pytest.mark.parametrize("clashing", [False, True])
def test_pipeline_stages_take_awkward_and_empty_tables(spark, sf_dir, clashing):
    docs = awkward(spark, clashing)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf_dir).collect(), docs.schema)
    assert docs.where("text is null or text = ''").count() == 0
    assert corpus_pipeline.mixing_stage(spark, docs, sf_dir).count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), sf_dir).count() == 0
