"""Queries over record files: scan, validation, catalogue, migration, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.functions import text as TX
from voxledger.functions import variants as V
from voxledger.functions.globs import glob_anti, glob_semi
from voxledger.operators import catalog as C
from voxledger.operators import duplicates as D
from voxledger.operators import joins as J
from voxledger.operators import migrate as M
from voxledger.operators import quality as Q
from voxledger.operators import records as R
from voxledger.operators.validate import parse_records, violation_rows
from voxledger.sources import files as S
from voxledger.sources import tables as T
from voxledger.suite.record_sql import with_files, with_keys, with_results, with_viol

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# ---- scan and parse ------------------------------------------------------------
@register(with_files("SELECT file, source, parsed, NOT load_failed AS loaded FROM recs"))
def record_scan_parse(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_records(T.candidate_files(spark, sf), T.ROOTS)
    return records.select("file", "source", "parsed", F.col("load_error").isNull().alias("loaded"))


@register(
    with_files(
        """SELECT dir, count(*) AS copies FROM (
             SELECT dir, file FROM cand WHERE starts_with(dir, '/data/ebi')
             UNION ALL SELECT dir, file FROM cand WHERE ends_with(dir, '/nested')) GROUP BY dir"""
    )
)
def scan_union(spark: SparkSession, sf: str) -> DataFrame:
    found = T.candidate_files(spark, sf)
    both = S.scan_union([found.where(F.col("dir").startswith("/data/ebi")), found.where(F.col("dir").endswith("/nested"))])
    return both.groupBy("dir").agg(F.count(F.lit(1)).alias("copies"))


@register(
    """SELECT url, regexp_matches(url, '^https://.*$') AS secure FROM pages
       WHERE (regexp_matches(url, '/en/[^/]*') OR regexp_matches(url, '^https://.*[0-9]$'))
         AND NOT regexp_matches(url, '#top$')"""
)
def glob_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = T.table(spark, sf, "pages").select("url")
    kept = glob_anti(glob_semi(pages, "url", ["*/en/*", "https://*[0-9]"]), "url", ["*#top"])
    return kept.withColumn("secure", F.col("url").rlike("^https://"))


@register(
    """SELECT page_id, split_part(url, '/', 3) AS bucket,
              regexp_replace(url, '^[^/]*//[^/]*/?', '') AS object_key,
              'metadata_' || replace(regexp_replace(url, '^[^/]*//[^/]*/?', ''), '/', '_') || '_20240101_000000.json' AS name,
              '20240101_000000' AS stamp,
              'crop_z' || page_id || '_y' || (page_id % 7) || '_x' || (page_id % 5) || '_20240101_000000' AS crop,
              split_part(url, '/', 3) || '/data/' || page_id AS joined
       FROM pages"""
)
def naming(spark: SparkSession, sf: str) -> DataFrame:
    pages = T.table(spark, sf, "pages").select("page_id", "url")
    stamp, page = F.lit("20240101_000000"), F.col("page_id")
    name = TX.metadata_name(TX.object_key(F.col("url")), stamp)
    return pages.select(
        "page_id",
        TX.bucket_name(F.col("url")).alias("bucket"),
        TX.object_key(F.col("url")).alias("object_key"),
        name.alias("name"),
        TX.timestamp_in_name(name).alias("stamp"),
        TX.crop_name(page, page % 7, page % 5, stamp).alias("crop"),
        TX.join_path(TX.bucket_name(F.col("url")), F.lit("data"), page.cast("string")).alias("joined"),
    )


@register(
    """SELECT event_id, event_id AS image_id, 'img ' || user_id AS name FROM events WHERE event_type <> 'error'
       UNION ALL SELECT event_id, event_id + 1000000, 'Image ' || (event_id + 1000000) FROM events WHERE event_type <> 'error'"""
)
def api_listing(spark: SparkSession, sf: str) -> DataFrame:
    e = T.table(spark, sf, "events")
    item = F.format_string(
        '{"data": [{"@id": %d, "Name": "img %d"}, {"@id": %d}]}', F.col("event_id"), F.col("user_id"), F.col("event_id") + 1000000
    )
    listing = e.select(
        "event_id", item.alias("body"), F.when(F.col("event_type") != "error", F.length("props")).alias("length")
    )
    return S.image_listing(S.only_files(listing).select("event_id", "body"))


@register(
    with_files(
        """SELECT file, CASE WHEN doc_id % 4 = 0 THEN 'mrc' WHEN doc_id % 4 = 1 THEN 'dm3' WHEN doc_id % 4 = 2 THEN 'ser' END AS format,
                  CASE WHEN doc_id % 4 = 3 THEN 'Unsupported file type: /raw/' || doc_id || '.xml.gz' END AS error,
                  CASE WHEN doc_id % 5 = 0 OR bytes = 0 THEN 'missing' WHEN doc_id % 5 = 1 AND bytes > 1 THEN 'partial'
                       WHEN doc_id % 5 = 1 THEN 'missing' ELSE 'complete' END AS state
           FROM cand"""
    )
)
def formats_and_state(spark: SparkSession, sf: str) -> DataFrame:
    found = T.candidate_files(spark, sf)
    number = F.regexp_extract("fname", "metadata_([0-9]+)_", 1).cast("bigint")
    docs = T.table(spark, sf, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("expected"))
    files = found.select("file", number.alias("doc_id"))
    suffix = T.pick([".mrc", ".dm3", ".ser", ".xml.gz"], F.col("doc_id"))
    raw = F.concat(F.lit("/raw/"), F.col("doc_id").cast("string"), suffix)
    planned = S.dispatch_formats(files.withColumn("raw", raw), "raw").join(docs, "doc_id")
    listing = docs.where("doc_id % 5 <> 0").select(
        "doc_id", F.when(F.col("doc_id") % 5 == 1, F.floor(F.col("expected") / 2)).otherwise(F.col("expected")).alias("length")
    )
    return S.completion_state(planned, listing, "doc_id").select("file", "format", "error", "state")


# ---- validation ----------------------------------------------------------------
@register(with_viol("SELECT file, depth, path, keyword, message FROM viol"))
def violations_all(spark: SparkSession, sf: str) -> DataFrame:
    return violation_rows(T.checked_records(spark, sf), "file").select("file", "depth", "path", "keyword", "message")


@register(with_results("SELECT file, source, valid, error_class, coalesce(error, '') AS errors FROM results"))
def verdict_first_error(spark: SparkSession, sf: str) -> DataFrame:
    shown = C.first_errors(T.checked_records(spark, sf))
    return shown.select("file", "source", "valid", "error_class", F.array_join("errors", "; ").alias("errors"))


@register(
    with_files(
        """SELECT source, 'id' AS path, count(*) AS n FROM recs WHERE kind NOT IN (0, 1, 2, 3, 22, 26) GROUP BY source"""
    )
)
def strict_formats(spark: SparkSession, sf: str) -> DataFrame:
    rows = violation_rows(T.checked_records(spark, sf, strict_formats=True), "source").where("keyword = 'format'")
    return rows.groupBy("source", "path").agg(F.count(F.lit(1)).alias("n"))


@register(
    with_results(
        """SELECT count(*) AS total_files, count(*) FILTER (parsed) AS processed_files,
                  count(*) FILTER (NOT load_failed AND NOT valid) AS validation_errors,
                  count(*) FILTER (load_failed) AS parsing_errors, count(*) FILTER (valid) AS valid_files,
                  count(*) FILTER (NOT valid) AS invalid_files,
                  round(count(*) FILTER (valid) * 100.0 / count(*), 2) AS validation_rate,
                  count(DISTINCT CASE WHEN NOT load_failed THEN source END) AS sources
           FROM results"""
    )
)
def summary_counters(spark: SparkSession, sf: str) -> DataFrame:
    return C.run_counters(T.checked_records(spark, sf))


@register(
    with_files(
        """SELECT status, count(*) AS files FROM (
             SELECT CASE WHEN kind = 22 THEN CASE WHEN doc_id % 3 = 0 THEN 'failed' ELSE 'unknown' END
                         WHEN kind IN (4, 27) THEN 'done'
                         ELSE CASE doc_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'saving-data'
                              WHEN 3 THEN 'complete' ELSE 'failed' END END AS status
             FROM recs WHERE NOT load_failed) GROUP BY status"""
    )
)
def by_status(spark: SparkSession, sf: str) -> DataFrame:
    return C.counts_by(parse_records(T.candidate_files(spark, sf), T.ROOTS), "status")


@register(
    with_files(
        """SELECT CASE WHEN kind = 20 THEN 'unknown' WHEN kind = 21 THEN '' ELSE src END AS source, count(*) AS files
           FROM recs WHERE NOT load_failed GROUP BY 1"""
    )
)
def by_source(spark: SparkSession, sf: str) -> DataFrame:
    return C.counts_by(parse_records(T.candidate_files(spark, sf), T.ROOTS), "source")


@register(with_files("SELECT source, count(*) AS total FROM recs WHERE NOT load_failed GROUP BY source"))
def files_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return C.files_by_source(parse_records(T.candidate_files(spark, sf), T.ROOTS))


@register(
    with_results(
        """SELECT source, count(*) FILTER (valid) AS valid, count(*) FILTER (NOT valid) AS invalid, count(error) AS errors
           FROM results GROUP BY GROUPING SETS ((source), ())"""
    )
)
def errors_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return C.errors_by_source(T.checked_records(spark, sf))


@register(with_results("SELECT source, file, error FROM results WHERE error IS NOT NULL"))
def error_details(spark: SparkSession, sf: str) -> DataFrame:
    return C.error_details(T.checked_records(spark, sf))


@register(with_files("SELECT DISTINCT source FROM recs WHERE NOT load_failed"))
def sources_found(spark: SparkSession, sf: str) -> DataFrame:
    return C.sources_found(parse_records(T.candidate_files(spark, sf), T.ROOTS))


@register(with_keys("SELECT DISTINCT key FROM keys"))
def distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return C.distinct_keys(parse_records(T.candidate_files(spark, sf), T.ROOTS))


@register(
    with_keys(
        """SELECT k.key, k.source, k.n, round(k.n / t.total, 4) AS ratio
           FROM (SELECT key, source, count(*) AS n FROM keys GROUP BY ALL) k
           JOIN (SELECT source, count(*) AS total FROM recs WHERE NOT load_failed GROUP BY source) t USING (source)"""
    )
)
def key_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return C.key_ratios(parse_records(T.candidate_files(spark, sf), T.ROOTS))


@register(
    """SELECT event_type AS source, key, count(*) AS n FROM events, (VALUES ('event'), ('user')) k(key) GROUP BY ALL"""
)
def document_key_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = T.json_docs(spark, sf)
    shaped = docs.select(
        F.col("grp").alias("source"), F.lit(None).cast("string").alias("load_error"), V.object_keys(F.col("v")).alias("keys")
    )
    return C.key_counts(shaped)


@register(
    with_keys(
        """SELECT source, round(avg(n), 2) AS average_fields,
                  round(count(*) FILTER (described) * 100.0 / count(*), 2) AS required_fields_present
           FROM (SELECT r.source, r.doc_id, count(*) AS n, true AS described
                 FROM results r JOIN keys k ON k.doc_id = r.doc_id WHERE r.valid GROUP BY ALL) GROUP BY source"""
    )
)
def completeness(spark: SparkSession, sf: str) -> DataFrame:
    return C.completeness(T.checked_records(spark, sf))


@register(
    with_keys(
        """SELECT r.source, f.field, count(*) AS files
           FROM recs r CROSS JOIN (VALUES ('id'), ('source'), ('source_id'), ('status'), ('created_at'), ('metadata')) f(field)
           LEFT JOIN keys k ON k.doc_id = r.doc_id AND k.key = f.field
           WHERE NOT r.load_failed AND k.key IS NULL GROUP BY ALL"""
    )
)
def missing_fields(spark: SparkSession, sf: str) -> DataFrame:
    return C.missing_fields(parse_records(T.candidate_files(spark, sf), T.ROOTS))


@register(
    with_keys(
        """, has AS (SELECT r.doc_id, count(k.key) AS n, bool_or(k.key = 'id') AS id, bool_or(k.key = 'status') AS status, bool_or(k.key = 'metadata') AS metadata
                   FROM recs r LEFT JOIN keys k ON k.doc_id = r.doc_id GROUP BY r.doc_id)
           SELECT r.source, count(*) FILTER (NOT r.load_failed) AS total, count(*) FILTER (r.valid) AS valid, count(*) FILTER (NOT r.valid) AS invalid,
                  count(r.error) AS errors, round(avg(h.n) FILTER (r.valid), 2) AS average_fields,
                  count(*) FILTER (NOT r.load_failed AND NOT coalesce(h.id, false)) AS missing_id,
                  count(*) FILTER (NOT r.load_failed AND NOT coalesce(h.status, false)) AS missing_status,
                  count(*) FILTER (NOT r.load_failed AND NOT coalesce(h.metadata, false)) AS missing_metadata
           FROM results r JOIN has h ON h.doc_id = r.doc_id GROUP BY r.source"""
    )
)
def catalog_readback(spark: SparkSession, sf: str) -> DataFrame:
    """The catalogue document of every source, parsed back from its JSON text."""
    documents = C.source_documents(T.checked_records(spark, sf))
    doc = F.parse_json("value")
    number = lambda path: F.try_variant_get(doc, path, "bigint")
    return documents.select(
        "source",
        *[number(f"$.{n}").alias(n) for n in ("total", "valid", "invalid", "errors")],
        F.try_variant_get(doc, "$.average_fields", "double").alias("average_fields"),
        *[number(f"$.missing.{n}").alias(f"missing_{n}") for n in ("id", "status", "metadata")],
    )


@register(with_results("SELECT file, source FROM results WHERE valid ORDER BY file LIMIT 5"))
def catalog_sample(spark: SparkSession, sf: str) -> DataFrame:
    return C.valid_sample(T.checked_records(spark, sf)).select("file", "source")


@register(
    with_files(
        """SELECT file, source, CAST(n_chars AS DOUBLE) AS seconds FROM recs WHERE NOT load_failed AND kind NOT IN (22, 25)"""
    )
)
def processing_times(spark: SparkSession, sf: str) -> DataFrame:
    return C.processing_seconds(parse_records(T.candidate_files(spark, sf), T.ROOTS))


@register(
    with_results(
        """, st AS (SELECT *, CASE WHEN kind = 22 THEN CASE WHEN doc_id % 3 = 0 THEN 'failed' ELSE 'unknown' END
                         WHEN kind IN (4, 27) THEN 'done'
                         ELSE CASE doc_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'saving-data'
                              WHEN 3 THEN 'complete' ELSE 'failed' END END AS status,
                    CASE WHEN kind = 20 THEN 'unknown' WHEN kind = 21 THEN '' ELSE src END AS given FROM results)
           SELECT 'run' AS section, 'total_files' AS name, CAST(count(*) AS DOUBLE) AS value FROM st
           UNION ALL SELECT 'run', 'validation_errors', count(*) FILTER (NOT valid) FROM st
           UNION ALL SELECT 'status', status, count(*) FROM st WHERE NOT load_failed GROUP BY status
           UNION ALL SELECT 'source', given, count(*) FROM st WHERE NOT load_failed GROUP BY given
           UNION ALL SELECT 'times', 'count', count(*) FROM st WHERE NOT load_failed AND kind NOT IN (22, 25)
           UNION ALL SELECT 'times', 'seconds', sum(n_chars) FROM st WHERE NOT load_failed AND kind NOT IN (22, 25)"""
    )
)
def processing_summary(spark: SparkSession, sf: str) -> DataFrame:
    return C.processing_summary(T.checked_records(spark, sf))


@register(
    with_results(
        """SELECT src AS folder, arg_max(file, (mtime, file)) AS file, max(mtime) AS mtime,
                  arg_max(valid, (mtime, file)) AS valid FROM results GROUP BY src"""
    )
)
def latest_per_source(spark: SparkSession, sf: str) -> DataFrame:
    checked = T.checked_records(spark, sf).withColumn("folder", F.element_at(F.split("file", "/"), 3))
    return C.latest_per_source(checked, "valid", key="folder")


@register(
    with_results(
        """SELECT count(*) AS total_files, count(*) FILTER (valid) AS valid_files,
                  round(count(*) FILTER (valid) * 100.0 / count(*), 1) AS percent
           FROM (SELECT src, arg_max(valid, (mtime, file)) AS valid FROM results GROUP BY src)"""
    )
)
def latest_validity(spark: SparkSession, sf: str) -> DataFrame:
    checked = T.checked_records(spark, sf).withColumn("folder", F.element_at(F.split("file", "/"), 3))
    return C.valid_share(C.latest_per_source(checked, "valid", key="folder"))


@register(
    with_viol(
        """SELECT source, CASE kind WHEN 0 THEN 'parse' ELSE 'processing' END AS error_class, count(*) AS n
           FROM recs WHERE load_failed GROUP BY ALL
           UNION ALL SELECT source, keyword, count(*) FROM viol GROUP BY ALL"""
    )
)
def error_classes(spark: SparkSession, sf: str) -> DataFrame:
    return C.error_classes(T.checked_records(spark, sf))


# ---- migration -------------------------------------------------------------------
@register(
    with_files(
        """SELECT CASE WHEN src = 'empiar' AND kind NOT IN (0, 1, 20, 21, 26) THEN 'ebi' ELSE source END AS source,
                  src = 'empiar' AND kind NOT IN (0, 1, 20, 21, 26) AS changed, count(*) AS files
           FROM recs GROUP BY ALL"""
    )
)
def legacy_rename(spark: SparkSession, sf: str) -> DataFrame:
    renamed = M.rename_source(parse_records(T.candidate_files(spark, sf), T.ROOTS))
    return renamed.groupBy("source", "changed").agg(F.count(F.lit(1)).alias("files"))


@register(
    with_files(
        """SELECT file, 'rec-' || doc_id AS id, src AS source, 'set-' || substr(sha, 1, 8) AS source_id,
                  CASE WHEN doc_id % 3 = 0 THEN 'failed' ELSE 'complete' END AS status,
                  CASE WHEN doc_id % 2 = 0 THEN strftime(created, '%Y-%m-%dT%H:%M:%SZ')
                       ELSE strftime(mtime, '%Y-%m-%dT%H:%M:%SZ') END AS created_at,
                  text AS description, (doc_id % 64 + 1) || ',8,8' AS volume_shape, bytes AS file_size_bytes, sha AS sha256,
                  10384.0 AS dim_x, 0.0 AS dim_y, 1669.44 AS dim_z, '/vol/' || doc_id || '.npy' AS volume, file AS metadata_file
           FROM recs WHERE kind = 22"""
    )
)
def legacy_migrate(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_records(T.candidate_files(spark, sf), T.ROOTS)
    number = F.regexp_extract("fname", "metadata_([0-9]+)_", 1)
    moved = M.migrate(records, F.concat(F.lit("rec-"), number)).where("outcome = 'converted'")
    r = F.col("record")
    listed = r["metadata"]["core"]["volume_shape"]
    return moved.select(
        "file",
        *[r[c].alias(c) for c in ("id", "source", "source_id", "status", "created_at")],
        r["metadata"]["core"]["description"].alias("description"),
        F.array_join(F.transform(listed, lambda x: x.cast("string")), ",").alias("volume_shape"),
        r["metadata"]["technical"]["file_size_bytes"].alias("file_size_bytes"),
        r["metadata"]["technical"]["sha256"].alias("sha256"),
        *[r["metadata"]["technical"]["dimensions_nm"][i].alias(f"dim_{n}") for i, n in enumerate("xyz")],
        r["files"]["volume"].alias("volume"),
        r["files"]["metadata"].alias("metadata_file"),
    )


@register(
    with_keys(
        """SELECT r.file, 'rec-' || r.doc_id AS id, count(*) + 1 AS members, bool_or(k.key = 'metadata') AS nested
           FROM recs r JOIN keys k ON k.doc_id = r.doc_id WHERE r.kind = 2 GROUP BY r.file, r.doc_id"""
    )
)
def legacy_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Nested records without an id: they get one and keep all their members."""
    records = parse_records(T.candidate_files(spark, sf), T.ROOTS)
    number = F.regexp_extract("fname", "metadata_([0-9]+)_", 1)
    moved = M.migrate(records, F.concat(F.lit("rec-"), number)).where("outcome = 'repaired'")
    doc = F.parse_json("repaired")
    return moved.select(
        "file", F.try_variant_get(doc, "$.id", "string").alias("id"), F.size(V.object_keys(doc)).alias("members"),
        V.is_object(doc, "metadata").alias("nested"),
    )


@register(
    with_files(
        """, o AS (SELECT src, CASE WHEN kind IN (0, 1) THEN 'failed' WHEN kind = 26 THEN 'failed'
                          WHEN src = 'empiar' AND kind IN (2, 22) THEN 'failed' WHEN kind = 2 THEN 'repaired' WHEN kind = 22 THEN 'converted'
                          ELSE 'already_v2' END AS outcome FROM recs)
           SELECT src AS source, outcome, count(*) AS files FROM o GROUP BY GROUPING SETS ((src, outcome), (outcome))"""
    )
)
def legacy_migrate_counts(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_records(T.candidate_files(spark, sf), T.ROOTS)
    moved = M.migrate_checked(records).withColumn("source", F.element_at(F.split("file", "/"), 3))
    return M.outcome_counts(moved.select("source", "outcome"))


@register(
    with_results(
        """, o AS (SELECT source, CASE WHEN load_failed THEN 'error' WHEN valid THEN 'keep_valid'
                          WHEN keyword = 'required' AND error = '''id'' is a required property' THEN 'remove'
                          ELSE 'keep_invalid' END AS outcome FROM results)
           SELECT source, outcome, count(*) AS files FROM o GROUP BY GROUPING SETS ((source, outcome), (outcome))"""
    )
)
def legacy_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    return M.outcome_counts(M.cleanup(T.checked_records(spark, sf)))


# ---- transforms --------------------------------------------------------------------
_NOW = "2024-06-01T00:00:00+00:00"


def _listing(spark: SparkSession, sf: str) -> DataFrame:
    d = T.table(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    number = F.col("doc_id").cast("string")
    path = lambda suffix: F.concat(F.lit("/data/"), number, F.lit(suffix))
    return d.select(
        "doc_id", F.concat(F.lit("rec-"), number).alias("record_id"), F.col("source").alias("entry"),
        F.when(F.col("doc_id") % 3 == 0, F.col("lang")).alias("title"), path(".dm3").alias("raw_path"),
        path(".npy").alias("volume_path"), path("_metadata.json").alias("metadata_path"),
        F.array(F.octet_length("text").cast("bigint")).alias("shape"), F.octet_length("text").cast("bigint").alias("bytes"),
        F.sha2("text", 256).alias("sha256"), F.lit("uint16").alias("dtype"), F.col("doc_id").alias("image_id"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).otherwise(F.lit("")).alias("name"),
        F.concat(F.lit("ftp://host/"), number).alias("url"), F.col("source").alias("source_id"),
        F.array(F.lit(5.0), F.lit(5.0), F.lit(5.0)).alias("voxel_size_nm"),
        F.array(F.col("doc_id"), F.col("doc_id") + 1, F.col("doc_id") + 2).alias("origin"),
        F.array(*[F.lit(8).cast("bigint")] * 3).alias("size"),
        F.array(*[F.lit(0).cast("bigint")] * 3).alias("start"), F.array(*[F.lit(99).cast("bigint")] * 3).alias("stop"),
        F.concat(F.lit("fib/s"), number).alias("array_name"), F.col("source").alias("dataset_id"), F.lit("em").alias("internal_path"),
        F.when(F.col("doc_id") % 4 != 0, F.struct(F.lit(10384.0).alias("x"), F.lit(None).cast("double").alias("y"), F.lit(1669.44).alias("z"))).alias("dimensions"),
    )


_BASE = "SELECT doc_id, text, lang, source, octet_length(encode(text)) AS bytes, sha256(text) AS sha FROM documents"


@register(
    f"""SELECT 'rec-' || doc_id AS id, 'ebi' AS source, source AS source_id, 'complete' AS status,
               CASE WHEN doc_id % 3 = 0 THEN lang ELSE 'EBI EMPIAR dataset ' || source END AS description, 'uint8' AS data_type,
               bytes AS file_size_bytes, sha AS sha256,
               CAST(bytes AS VARCHAR) AS shape, NULL AS voxel_size, NULL AS dimensions, NULL AS crop_size,
               'ftp://host/empiar/world_availability/' || source || '/data/' || doc_id || '.dm3' AS url, '/data/' || doc_id || '.npy' AS volume
        FROM ({_BASE})
        UNION ALL
        SELECT 'rec-' || doc_id, 'idr', 'IDR-' || doc_id, 'complete',
               CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'IDR image ' || doc_id END, 'uint16', bytes, sha, CAST(bytes AS VARCHAR), NULL, NULL, NULL, 'ftp://host/' || doc_id, '/data/' || doc_id || '.npy' FROM ({_BASE})
        UNION ALL
        SELECT 'rec-' || doc_id, 'epfl', source, 'complete', '5x5x5µm section from CA1 hippocampus region', 'uint16', bytes, NULL, CAST(bytes AS VARCHAR), '5.0,5.0,5.0', NULL, NULL, 'ftp://host/' || doc_id, '/data/' || doc_id || '.npy' FROM ({_BASE})
        UNION ALL
        SELECT 'rec-' || doc_id, 'flyem', source, 'complete', 'Random crop at (' || doc_id || ', ' || (doc_id + 1) || ', ' || (doc_id + 2) || ') from FlyEM DVID', 'uint16', bytes, NULL, '8,8,8', NULL, NULL, '8,8,8', 'ftp://host/' || doc_id, '/data/' || doc_id || '.npy' FROM ({_BASE})
        UNION ALL
        SELECT 'rec-' || doc_id, 'openorganelle', source, 'saving-data', 'Array ''fib/s' || doc_id || ''' from OpenOrganelle Zarr S3 store', NULL, NULL, NULL, NULL, '5.0,5.0,5.0', CASE WHEN doc_id % 4 <> 0 THEN '10384.0,0.0,1669.44' END, NULL, 'ftp://host/' || doc_id, '/data/' || doc_id || '.npy' FROM ({_BASE})"""
)
def record_build(spark: SparkSession, sf: str) -> DataFrame:
    """The records of five sources, built side by side in one scan and listed one after another."""
    listing, now = _listing(spark, sf), F.lit(_NOW)
    builders = [
        lambda df: R.slice_record(df, "entry", "title", "raw_path", "host", now),
        lambda df: R.image_record(df, now),
        lambda df: R.section_record(df, now),
        lambda df: R.crop_record(df, now),
        lambda df: R.array_record(df, now),
    ]
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    wanted = {
        "data_type": ("metadata.core.data_type", "string"),
        "file_size_bytes": ("metadata.technical.file_size_bytes", "bigint"),
        "sha256": ("metadata.technical.sha256", "string"),
    }
    lists = {
        "shape": ("metadata.core.volume_shape", "array<bigint>"),
        "voxel_size": ("metadata.core.voxel_size_nm", "array<double>"),
        "dimensions": ("metadata.technical.dimensions_nm", "array<double>"),
        "crop_size": ("additional_metadata.crop_size", "array<bigint>"),
    }
    out, made = listing, []
    for i, build in enumerate(builders):
        one = build(out)
        row = F.struct(
            *[F.col(f"record.{c}") for c in ("id", "source", "source_id", "status", "metadata.core.description")],
            *[R.current(one, path).cast(kind).alias(name) for name, (path, kind) in wanted.items()],
            *[joined(R.current(one, path).cast(kind)).alias(name) for name, (path, kind) in lists.items()],
            F.col("record.metadata.provenance.download_url").alias("url"), F.col("record.files.volume"),
        )
        made.append(f"_row{i}")
        out = one.withColumn(made[-1], row).drop("record")
    return out.select(F.inline(F.array(*made)))


@register(
    f"""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN bytes ELSE 7 END AS file_size_bytes,
               CASE WHEN doc_id % 3 = 0 THEN 'failed' ELSE 'complete' END AS status,
               CASE WHEN doc_id % 3 = 0 THEN CAST(1 AS BIGINT) END AS retry_count,
               CASE WHEN doc_id % 6 = 0 THEN 'boom' END AS message,
               CASE WHEN doc_id % 5 = 0 THEN 50.0 END AS percentage,
               'new-' || doc_id AS alt, 'kept' AS extra
        FROM ({_BASE})"""
)
def record_update(spark: SparkSession, sf: str) -> DataFrame:
    d = T.table(spark, sf, "documents").select("doc_id", "text")
    i, now = F.col("doc_id"), F.lit(_NOW)
    df = d.withColumn("record", R.to_record(R.new_record(F.lit("ebi"), i.cast("string"), F.lit("x"), i.cast("string"), now)))
    df = R.set_paths(df, {"metadata.technical.file_size_bytes": F.lit(7).cast("bigint")})
    df = R.add_technical(df, file_size_bytes=F.when(i % 2 == 0, F.octet_length("text").cast("bigint")))
    df = R.add_files(df, F.create_map(F.lit("alt"), F.lit("old"), F.lit("extra"), F.lit("kept")))
    df = R.add_files(df, F.create_map(F.lit("alt"), F.concat(F.lit("new-"), i.cast("string"))))
    df = R.update_status(
        df, F.when(i % 3 == 0, "failed").otherwise("complete"), now, F.when(i % 5 == 0, 50.0), None,
        F.when(i % 6 == 0, "boom").otherwise(F.lit("")),
    )
    return df.select(
        "doc_id", F.col("record.metadata.technical.file_size_bytes"), F.col("record.status"), F.col("record.error.retry_count"),
        F.col("record.error.message"), F.col("record.progress.percentage"), F.col("record.files.additional")["alt"].alias("alt"),
        F.col("record.files.additional")["extra"].alias("extra"),
    )


@register(
    """SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS kind,
              'none' AS missing, CAST(-1 AS BIGINT) AS too_deep, user_id + 1 AS next_user FROM events"""
)
def dotted_lookup(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("v")
    typed = F.from_json("doc", "struct<event:struct<k:bigint>,user:struct<id:bigint,kind:string>>")
    docs = T.json_docs(spark, sf).withColumn("record", typed)
    return R.set_paths(docs, {"user.id": F.col("record.user.id") + 1}).select(
        "id", V.lookup(v, "event.k", "bigint", 0).alias("k"), V.lookup(v, "user.kind", "string", "").alias("kind"),
        V.lookup(v, "user.none", "string", "none").alias("missing"), V.lookup(v, "user.id.deep", "bigint", -1).alias("too_deep"),
        F.col("record.user.id").alias("next_user"),
    )


@register(
    """SELECT event_id AS id,
              CASE WHEN event_id % 14 = 6 THEN '{"event": {"k": ' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '}, "user": {"id": ' || user_id || ', "kind": "' || event_type || '"}}'
                   WHEN event_id % 14 = 8 THEN NULL
                   WHEN event_id % 2 = 0
                   THEN '{"event": {"k": ' || CAST(json_extract_string(props, '$.k') AS BIGINT) || ', "n": ' || event_id || '}, "user": {"id": ' || user_id || ', "kind": "' || event_type || '"}}'
                   ELSE '{"event": null, "extra": [' || event_id || '], "user": {"id": ' || user_id || ', "kind": "new"}}' END AS merged,
              CASE WHEN event_id % 14 = 8 THEN 'extra is not JSON' END AS error
       FROM events"""
)
def deep_merge(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("id").cast("string")
    extra = F.when(F.col("id") % 2 == 0, F.concat(F.lit('{"event": {"n": '), number, F.lit("}}"))).otherwise(
        F.concat(F.lit('{"event": null, "user": {"kind": "new"}, "extra": ['), number, F.lit("]}"))
    )
    extra = F.when(F.col("id") % 14 == 6, F.lit(None)).when(F.col("id") % 14 == 8, F.lit('{"event": ')).otherwise(extra)
    return T.json_docs(spark, sf).select("id", R.deep_merge("doc", extra).alias("merged"), R.merge_error("doc", extra).alias("error"))


# ---- declared quality rules ------------------------------------------------------------
_MAPPING = {
    "ebi": {"source_id_field": "source_id", "description_field": "metadata.core.description"},
    "epfl": {"source_id_field": "id", "description_field": "status"},
    "flyem": {"source_id_field": "metadata.technical.sha256"},
}


@register(
    with_files(
        """SELECT file,
                  CASE source WHEN 'ebi' THEN 'set-' || substr(sha, 1, 8)
                    WHEN 'epfl' THEN CASE WHEN kind NOT IN (2, 3, 22) THEN 'rec-' || doc_id END
                    WHEN 'flyem' THEN CASE WHEN kind IN (19, 22) THEN NULL WHEN kind IN (14, 27) THEN upper(sha) ELSE sha END END AS mapped_id,
                  CASE source WHEN 'ebi' THEN CASE WHEN kind IN (17, 18, 19, 22) THEN NULL WHEN kind = 5 THEN '' ELSE text END
                    WHEN 'epfl' THEN CASE WHEN kind = 22 THEN CASE WHEN doc_id % 3 = 0 THEN 'failed' END
                         WHEN kind IN (4, 27) THEN 'done'
                         ELSE CASE doc_id % 5 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'saving-data'
                              WHEN 3 THEN 'complete' ELSE 'failed' END END END AS mapped_description
           FROM recs WHERE NOT load_failed"""
    )
)
def field_mapping(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_records(T.candidate_files(spark, sf), T.ROOTS).where("load_error IS NULL")
    return R.map_fields(records, _MAPPING).select("file", "mapped_id", "mapped_description")


@register(
    with_files(
        """SELECT file, source, 'metadata.core.voxel_size_nm' AS field, 'required' AS rule FROM recs
           WHERE NOT load_failed AND source IN ('ebi', 'idr', 'openorganelle') AND kind IN (17, 19, 22)
           UNION ALL SELECT file, source, 'metadata.technical.sha256', 'format' FROM recs WHERE kind IN (14, 27)"""
    )
)
def custom_rules(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        Q.CustomRule("metadata.core.voxel_size_nm", ["ebi", "idr", "openorganelle"]),
        Q.CustomRule("metadata.technical.sha256", pattern=contract.SHA256_PATTERN),
    ]
    return Q.custom_rule_rows(parse_records(T.candidate_files(spark, sf), T.ROOTS), rules)


@register(
    f"""SELECT CASE WHEN doc_id % 6 > 2 THEN 'no_policy'
                    WHEN doc_id % 4 = 3 OR (doc_id % 6 = 1 AND doc_id % 4 <> 0) THEN 'format'
                    WHEN bytes > 2000 THEN 'too_large' WHEN doc_id % 6 = 2 AND doc_id % 5 = 0 THEN 'no_checksum' ELSE 'ok' END AS policy,
              count(*) AS files FROM ({_BASE}) GROUP BY 1"""
)
def policy_filter(spark: SparkSession, sf: str) -> DataFrame:
    d = T.table(spark, sf, "documents")
    i = F.col("doc_id")
    files = d.select(
        T.pick([*contract.SOURCES, "other"], i).alias("source"),
        F.coalesce(S.file_format(F.concat(F.lit("f"), T.pick([".mrc", ".dm3", ".ser", ".xml"], i))), F.lit("none")).alias("format"),
        F.octet_length("text").cast("bigint").alias("nbytes"), F.when(i % 5 != 0, F.sha2("text", 256)).alias("sha256"),
    )
    policy = spark.createDataFrame(
        [("ebi", ["mrc", "dm3", "ser"], 2000, False), ("epfl", ["mrc"], 2000, False), ("flyem", ["mrc", "dm3", "ser"], 2000, True)],
        "source string, formats array<string>, max_bytes bigint, need_checksum boolean",
    )
    return Q.apply_policy(files, policy).groupBy("policy").agg(F.count(F.lit(1)).alias("files"))


@register(
    with_files(
        """SELECT source, 'set-' || substr(sha, 1, 8) AS source_id, count(*) AS copies, min(file) AS first, max(file) AS last
           FROM recs WHERE NOT load_failed GROUP BY ALL HAVING count(*) > 1"""
    )
)
def dup_source_id(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_records(T.candidate_files(spark, sf), T.ROOTS).where("load_error IS NULL")
    rows = records.select("source", "file", V.as_text(F.col("v"), "source_id").alias("source_id"))
    return D.duplicate_groups(rows, ["source", "source_id"], "file")


@register(
    """SELECT d.doc_id, g.first, g.copies FROM documents d
       JOIN (SELECT text, min(doc_id) AS first, count(*) AS copies FROM documents GROUP BY text HAVING count(*) > 1) g
         ON g.text = d.text WHERE d.doc_id <> g.first"""
)
def dup_sha256(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    return D.duplicate_members(rows, ["sha256"], "doc_id").select("doc_id", "first", "copies")


@register(
    """SELECT lang, source, copies, first, last FROM (
         SELECT lang, source, n_chars, count(*) AS copies, min(doc_id) AS first, max(doc_id) AS last
         FROM documents GROUP BY lang, source, n_chars HAVING count(*) > 1)"""
)
def dup_pattern(spark: SparkSession, sf: str) -> DataFrame:
    d = T.table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    rows = d.withColumn("pattern", D.pattern_key(F.col("lang"), F.col("source"), F.col("n_chars")))
    return D.duplicate_groups(rows, ["pattern", "lang", "source"], "doc_id").drop("pattern")


@register(
    with_files(
        """SELECT file, source, CASE doc_id % 8 WHEN 0 THEN 'uint8' WHEN 1 THEN 'uint16' WHEN 2 THEN 'uint32' WHEN 3 THEN 'int8'
                    WHEN 4 THEN 'int16' WHEN 5 THEN 'int32' WHEN 6 THEN 'float32' ELSE 'float64' END AS data_type
           FROM recs WHERE NOT load_failed AND source IN ('ebi', 'flyem') AND kind NOT IN (17, 19, 22, 27) AND doc_id % 8 < 3"""
    )
)
def dataset_list(spark: SparkSession, sf: str) -> DataFrame:
    records = parse_records(T.candidate_files(spark, sf), T.ROOTS).where("load_error IS NULL")
    wanted = spark.createDataFrame([("ebi",), ("flyem",)], "source string")
    listed = J.known_only(records, wanted, "source")
    kind = V.as_text(F.col("v"), "metadata.core.data_type")
    return listed.where(kind.isin("uint8", "uint16", "uint32")).select("file", "source", kind.alias("data_type"))
