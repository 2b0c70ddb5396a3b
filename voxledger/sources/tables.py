"""Test tables as engine inputs: record files, volumes, inventories, logs.

Each function declares a derived input over a whole given table, so its size
follows the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.contract import DATA_TYPES, SOURCES, LEGACY_SOURCE
from voxledger.session import configure

ROOTS = ["/data"]
DRAFT_PATTERNS = ["*.tmp", "*.log", "*.backup", "*_draft.json"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input has fewer splits than cores.

    Large inputs have many splits and are left where they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


# ---- record files ------------------------------------------------------------
def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON record file per document, with faults chosen by ``doc_id % 29``."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return as_record_files(docs.join(labels, "doc_id", "left"))


def as_record_files(docs: DataFrame) -> DataFrame:
    """Format (doc_id, text, n_chars, quality) rows as record files."""
    d = F.col("doc_id")
    kind = (d % 29).cast("int")
    src = pick([*SOURCES, LEGACY_SOURCE], d)
    folder = F.concat(F.lit("/data/"), src)
    folder = (
        F.when(d % 23 == 5, F.concat(folder, F.lit("/consolidate")))
        .when(d % 10 == 7, F.concat(folder, F.lit("/nested")))
        .otherwise(folder)
    )
    stem = F.format_string("metadata_%d_20240101_%06d", d, d % 240000)
    fname = (
        F.when(d % 17 == 3, F.format_string("note_%d.json", d))
        .when(d % 19 == 4, F.concat(stem, F.lit("_draft.json")))
        .otherwise(F.concat(stem, F.lit(".json")))
    )
    created = F.timestamp_seconds(F.lit(1704067200) + d % 86400)
    updated = F.timestamp_seconds(F.lit(1704067200) + d % 86400 + F.col("n_chars"))
    return (
        docs.withColumns({"kind": kind, "src": src, "dir": folder, "fname": fname})
        .withColumns(
            {
                "file": F.concat_ws("/", "dir", "fname"),
                "mtime": F.timestamp_seconds(F.lit(1704067200) + (d * 7919) % 100000),
                "created": F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                "updated": F.date_format(updated, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
                "sha": F.sha2(F.col("text"), 256),
                "bytes": F.octet_length("text"),
            }
        )
        .withColumn("value", _record_text())
        .select("file", "dir", "fname", "mtime", "value")
    )


def _pair(name: str, value: Column) -> Column:
    return F.concat(F.lit(f'"{name}": '), value)


def _quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), value, F.lit('"'))


def _object(*pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*pairs)), ", "), F.lit("}"))


def _record_text() -> Column:
    d, kind = F.col("doc_id"), F.col("kind")
    number = d.cast("string")
    whole_text = F.to_json(F.struct(F.col("text").alias("t")))
    text_json = F.substring(whole_text, F.lit(6), F.length(whole_text) - 6)
    description = F.when(kind == 5, F.lit('""')).otherwise(text_json)
    shape = (
        F.when(kind == 6, F.format_string("[%d]", d + 1))
        .when(kind == 7, F.lit("[2, 2, 2, 2, 2]"))
        .when(kind == 8, F.lit("[4, 0, 8]"))
        .when(kind == 9, F.lit("[2.0, 8, 8]"))
        .when(kind == 10, F.lit("[2.5, 8, 8]"))
        .otherwise(F.format_string("[%d, 8, 8]", d % 64 + 1))
    )
    voxel = (
        F.when(kind == 11, F.lit('{"x": 4.0, "y": 4.0, "z": 2.96}'))
        .when(kind == 12, F.lit('"4x4x4"'))
        .when(kind == 13, F.lit('{"x": -1, "y": 4.0}'))
        .otherwise(F.lit("[4.0, 4.0, 4.0]"))
    )
    sha = F.when(kind.isin(14, 27), F.upper("sha")).otherwise(F.col("sha"))
    data_type = F.when(kind == 27, F.lit("float16")).otherwise(pick(DATA_TYPES, d))
    core = _object(
        F.when(kind != 18, _pair("description", description)),
        _pair("volume_shape", shape),
        _pair("voxel_size_nm", voxel),
        _pair("data_type", _quoted(data_type)),
    )
    technical = _object(
        _pair("file_size_bytes", F.col("bytes").cast("string")),
        _pair("sha256", _quoted(sha)),
        _pair("compression", _quoted(F.lit("none"))),
    )
    quality = (
        F.when(kind == 24, F.lit('{"completeness_score": 1.5, "validation_errors": [1]}'))
        .when(F.col("quality").isNotNull(), F.format_string('{"completeness_score": %d}', F.col("quality")))
    )
    metadata = F.when(kind == 19, F.lit('"flat"')).otherwise(
        _object(
            F.when(kind != 17, _pair("core", core)),
            _pair("technical", technical),
            _pair("quality", quality),
        )
    )
    source = (
        F.when(kind == 21, F.lit('""')).when(kind == 26, F.lit('["ebi"]')).otherwise(_quoted(F.col("src")))
    )
    status = F.when(kind.isin(4, 27), F.lit("done")).otherwise(
        pick(["pending", "processing", "saving-data", "complete", "failed"], d)
    )
    current = _object(
        F.when(kind == 3, _pair("id", F.lit("null"))).when(kind != 2, _pair("id", _quoted(F.concat(F.lit("rec-"), number)))),
        F.when(kind != 20, _pair("source", source)),
        _pair("source_id", _quoted(F.concat(F.lit("set-"), F.substring("sha", 1, 8)))),
        _pair("status", _quoted(status)),
        F.when(kind != 25, _pair("created_at", _quoted(F.col("created")))),
        _pair("updated_at", _quoted(F.col("updated"))),
        F.when(kind == 15, F.lit('"progress": {"percentage": 120}'))
        .when(kind == 16, F.lit('"progress": {"percentage": true}')),
        F.when(kind == 23, F.lit('"error": {"retry_count": -1}')),
        _pair("metadata", metadata),
        F.when(kind == 28, F.lit('"local_paths": {"volume": "v.npy"}, "additional_metadata": {"title": "t"}')),
    )
    legacy = _object(
        _pair("source", _quoted(F.col("src"))),
        _pair("source_id", _quoted(F.concat(F.lit("set-"), F.substring("sha", 1, 8)))),
        _pair("description", text_json),
        F.when(d % 2 == 0, _pair("timestamp", _quoted(F.col("created")))),
        F.when(d % 3 == 0, _pair("status", _quoted(F.lit("failed")))),
        _pair("volume_shape", F.format_string("[%d, 8, 8]", d % 64 + 1)),
        _pair("dtype", _quoted(pick(DATA_TYPES, d))),
        _pair("file_size_bytes", F.col("bytes").cast("string")),
        _pair("sha256", _quoted(F.col("sha"))),
        F.lit('"voxel_size_nm": {"x": 4.0, "y": 4.0, "z": 2.96}'),
        F.lit('"dimensions_nm": {"x": 10384, "z": 1669.44}'),
        F.format_string('"local_paths": {"volume": "/vol/%d.npy"}', d),
    )
    return (
        F.when(kind == 0, F.concat(F.lit('{"id": "rec-'), number, F.lit('", "source": ')))
        .when(kind == 1, F.format_string("[%d]", d))
        .when(kind == 22, legacy)
        .otherwise(current)
    )


def candidate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from voxledger.sources.files import scan

    return scan(record_files(spark, sf_dir), exclude=DRAFT_PATTERNS)


def checked_records(spark: SparkSession, sf_dir: str, strict_formats: bool = False) -> DataFrame:
    from voxledger.operators.validate import validate

    return validate(candidate_files(spark, sf_dir), ROOTS, strict_formats)


# ---- JSON documents ------------------------------------------------------------
def json_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, grp, v): one nested document per event."""
    e = table(spark, sf_dir, "events")
    doc = F.concat(
        F.lit('{"event": '), F.col("props"), F.lit(', "user": {"id": '), F.col("user_id").cast("string"),
        F.lit(', "kind": "'), F.col("event_type"), F.lit('"}}'),
    )
    return e.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("grp"), doc.alias("doc"), F.parse_json(doc).alias("v"), "value"
    )


# ---- volumes ---------------------------------------------------------------------
PLANE = (10, 25)  # y, x extent of the event volumes
VOLUMES = 4


def event_voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One uint8 voxel per event, dealt to four volumes in C order of ``event_id``."""
    from voxledger.functions.arrays import floor_div, unravel

    e = table(spark, sf_dir, "events").select("event_id", "props")
    value = F.get_json_object("props", "$.k").cast("int") % 256
    position = floor_div(F.col("event_id"), F.lit(VOLUMES))
    coords = unravel(position, [F.lit(0), F.lit(PLANE[0]), F.lit(PLANE[1])])
    return e.select(
        F.concat(F.lit("e"), (F.col("event_id") % VOLUMES).cast("string")).alias("dataset_id"),
        F.lit("s0").alias("array_name"), F.lit(0).alias("level"), F.array(*coords).alias("coords"), value.alias("value"),
        "event_id",
    )


def event_depth(spark: SparkSession, sf_dir: str) -> int:
    """Planes per event volume."""
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    return last // VOLUMES // (PLANE[0] * PLANE[1]) + 1


def event_blocks(spark: SparkSession, sf_dir: str, chunk: tuple[int, int, int] = (8, 8, 8)) -> DataFrame:
    """The event volumes as blocks; their first axis grows with the table."""
    from voxledger.operators.blocks import blocks_from_voxels

    shape = [F.lit(n).cast("bigint") for n in (event_depth(spark, sf_dir), *PLANE)]
    return blocks_from_voxels(event_voxels(spark, sf_dir), shape, list(chunk), "uint8")


def embedding_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One 4x4x4 float32 volume per embedding."""
    from voxledger.operators.blocks import pack_values

    e = table(spark, sf_dir, "embeddings")
    three = lambda n: F.array(*[F.lit(n).cast("bigint")] * 3)
    return e.select(
        F.col("vec_id").cast("string").alias("dataset_id"), F.lit("v").alias("array_name"), F.lit(0).alias("level"),
        three(4).alias("chunk"), three(0).alias("idx"), three(0).alias("origin"), three(4).alias("shape"), F.lit("float32").alias("dtype"),
        pack_values("embedding", F.lit("float32")).alias("payload"),
    )


def text_blocks(spark: SparkSession, sf_dir: str, block_bytes: int = 1024) -> DataFrame:
    """The UTF-8 bytes of each whole text as a one-axis uint8 volume."""
    from voxledger.operators.blocks import byte_blocks

    d = table(spark, sf_dir, "documents")
    return byte_blocks(d, F.col("doc_id"), F.encode("text", "UTF-8"), block_bytes)


def part_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An array inventory: one three-axis array per part."""
    from voxledger.plans.chunking import item_size, size_mb

    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    k = F.col("p_partkey")
    shape = F.array(
        (F.col("p_size") * 12).cast("bigint"), 64 + (k * 37) % 2500, 64 + (k * 53) % 2600
    ).cast("array<bigint>")
    chunks = F.array(F.least(F.col("shape")[0], 64 + (k % 3) * 32), F.least(F.col("shape")[1], F.lit(128)), F.least(F.col("shape")[2], F.lit(256)))
    out = p.select(
        F.col("p_brand").alias("dataset_id"), F.concat(F.lit("fib/s"), k.cast("string")).alias("array_name"),
        (k % 9).cast("int").alias("level"), shape.alias("shape"),
        pick(["uint8", "int16", "float32", "float64", "complex64"], k).alias("dtype"), "p_partkey",
    )
    out = out.withColumns({"chunks": chunks.cast("array<bigint>"), "itemsize": item_size(F.col("dtype"))})
    return out.withColumn("mb", size_mb(F.col("shape"), F.col("itemsize")))


# ---- events as status, jobs and logs ------------------------------------------------
STATUS_OF = {
    "signup": "pending", "view": "processing", "click": "saving-data", "purchase": "complete", "error": "failed",
}


def status_of(event_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for kind, status in STATUS_OF.items():
        out = F.when(event_type == kind, status).otherwise(out)
    return out


def as_status_events(events: DataFrame) -> DataFrame:
    """(dataset_id, ord, ts, status, progress, step, error_message) rows."""
    k = F.get_json_object("props", "$.k").cast("int")
    status = status_of(F.col("event_type"))
    return events.select(
        F.col("user_id").alias("dataset_id"), F.col("event_id").alias("ord"), F.col("ts").cast("timestamp").alias("ts"),
        status.alias("status"),
        F.when(status == "processing", k.cast("double")).alias("progress"),
        F.when(status == "saving-data", F.concat(F.lit("step "), k.cast("string"))).alias("step"),
        F.when(status == "failed", F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("code "), k.cast("string")))).alias("error_message"),
    )


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_status_events(table(spark, sf_dir, "events"))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as processed arrays: run, seconds, size and status."""
    li = table(spark, sf_dir, "lineitem")
    status = F.when(F.col("l_returnflag") == "R", "failed").when(F.col("l_linenumber") == 7, "skipped").otherwise("complete")
    return li.select(
        F.col("l_suppkey").alias("run"), "l_orderkey", "l_linenumber", status.alias("status"),
        F.col("l_quantity").alias("seconds"), (F.col("l_extendedprice") / F.lit(100.0)).alias("mb"),
        (F.col("l_quantity") > 45).alias("special"),
        pick(SOURCES, F.col("l_suppkey")).alias("loader"),
    )


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event; four events make a service, 400 a log."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    message = (
        F.when((kind == "purchase") & (k < 40), F.lit("exited with code 0"))
        .when((kind == "error") & (k < 30), F.format_string("exited with code %d", 1 + k % 9))
        .when((kind == "error") & (k < 50), F.lit("Connection refused by host"))
        .when((kind == "error") & (k < 70), F.lit("Permission denied on output folder"))
        .when((kind == "error") & (k < 85), F.lit("Failed to read slice"))
        .when((kind == "signup") & (k < 40), F.lit("SUCCESS: Saved volume"))
        .when((kind == "click") & (k < 2), F.lit("ModuleNotFoundError: No module named 'config_manager'"))
        .otherwise(F.lit("progress update"))
    )
    level = F.when(kind == "error", "ERROR").otherwise("INFO")
    level = F.when(message.startswith("exited"), "INFO").otherwise(level)
    service = F.concat(F.lit("svc"), F.floor(F.col("event_id") / 4).cast("string"))
    line = F.concat_ws(
        " - ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.concat(service, F.lit("-ingest")), level, message
    )
    return e.select(
        F.floor(F.col("event_id") / 400).cast("bigint").alias("log_id"),
        F.col("event_id").alias("line_no"), service.alias("service"), line.alias("line"),
    )
