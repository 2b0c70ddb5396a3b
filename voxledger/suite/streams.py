"""Streaming queries over the test tables, each with the SQL of its batch twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.sources import files as S
from voxledger.sources import tables as T
from voxledger.streaming import jobs as X
from voxledger.suite.record_sql import with_results

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return X.arriving_table(spark, f"{sf}/{name}.parquet", T.table(spark, sf, name).schema)


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    # The table's timestamps carry no zone; a watermark needs one.
    return _stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@register(with_results("SELECT file, source, valid, error_class, error FROM results"))
def stream_validate(spark: SparkSession, sf: str) -> DataFrame:
    labels = T.table(spark, sf, "labels").select("doc_id", "quality")
    docs = _stream(spark, sf, "documents").select("doc_id", "text", "n_chars").join(labels, "doc_id", "left")
    files = S.scan(T.as_record_files(docs), exclude=T.DRAFT_PATTERNS)
    return X.drain(X.validate_each(files, T.ROOTS))


@register(
    """SELECT user_id AS dataset_id, CASE arg_max(event_type, event_id) WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'processing'
              WHEN 'click' THEN 'saving-data' WHEN 'purchase' THEN 'complete' ELSE 'failed' END AS status,
              nullif(count(*) FILTER (event_type = 'error'), 0) AS retry_count, max(ts) AS updated_at
       FROM events GROUP BY user_id"""
)
def stream_status(spark: SparkSession, sf: str) -> DataFrame:
    folded = X.drain(X.status_fold(T.as_status_events(_stream(spark, sf, "events"))), "update", ["dataset_id"])
    return folded.select("dataset_id", "status", "retry_count", "updated_at")


_CLOSED = "(SELECT max(ts) - INTERVAL '1 hour' FROM events)"


@register(
    f"""SELECT start, files, valid, round(valid * 100.0 / files, 4) AS rate FROM (
          SELECT date_trunc('day', ts) AS start, count(*) AS files, count(*) FILTER (event_type <> 'error') AS valid FROM events GROUP BY 1)
        WHERE start + INTERVAL '1 day' <= {_CLOSED} AND valid * 100.0 / files < 95"""
)
def stream_rate(spark: SparkSession, sf: str) -> DataFrame:
    results = _timed(spark, sf).select("ts", (F.col("event_type") != "error").alias("valid"))
    alerts = X.rate_alerts(X.validation_rate(results))
    return X.drain(alerts).withColumn("rate", F.round("rate", 4))


@register(
    f"""SELECT start, kind, count(*) AS n, sum(cents) AS cents FROM (
          SELECT event_type AS kind, CAST(round(value * 100) AS BIGINT) AS cents,
                 unnest([time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '2024-01-01'),
                         time_bucket(INTERVAL '3 hours', ts, TIMESTAMP '2024-01-01') - INTERVAL '3 hours']) AS start FROM events)
        WHERE start + INTERVAL '6 hours' <= {_CLOSED} GROUP BY ALL"""
)
def stream_access(spark: SparkSession, sf: str) -> DataFrame:
    """Six-hour windows every three hours."""
    events = _timed(spark, sf).select("ts", F.col("event_type").alias("kind"), F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    return X.drain(X.access_windows(events, "6 hours", "3 hours"))


_SESSIONS = """
g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL '3 hours' THEN 0 ELSE 1 END AS new
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g),
f AS (SELECT user_id AS dataset_id, min(ts) AS start, max(ts) + INTERVAL '3 hours' AS "end", count(*) AS n FROM s GROUP BY user_id, session)"""


@register(f"""WITH {_SESSIONS} SELECT dataset_id, start, "end", n FROM f WHERE "end" <= {_CLOSED}""")
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Closed sessions; those still open at the end of the input are not emitted."""
    events = _timed(spark, sf).select("ts", F.col("user_id").alias("dataset_id"))
    return X.drain(X.quiet_sessions(events))


@register(f"""WITH {_SESSIONS} SELECT dataset_id, start, "end", n FROM f""")
def stuck_runs(spark: SparkSession, sf: str) -> DataFrame:
    e = T.table(spark, sf, "events").select(F.col("user_id").alias("dataset_id"), F.col("ts").cast("timestamp").alias("ts"))
    return X.quiet_sessions_batch(e)


@register("SELECT event_id, ts FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The event stream delivered twice, with repeats dropped."""
    events = _timed(spark, sf).select("event_id", "ts")
    return X.drain(X.without_repeats(events.unionByName(events), ["event_id"], "60 days"))


@register(
    """WITH w AS (SELECT max(ts) FILTER (event_id % 2 = 0) - INTERVAL 3 DAY AS one, max(ts) FILTER (event_id % 4 <> 3) - INTERVAL 3 DAY AS two FROM events)
       SELECT event_id, ts FROM events, w
       WHERE event_id % 2 = 0 OR event_id % 4 = 1 AND ts > one OR event_id % 4 = 3 AND ts > two"""
)
def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Three parts of the events arrive one after the other; rows behind the watermark of the parts before are dropped."""
    events = T.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    parts = [events.where(p) for p in ("event_id % 2 = 0", "event_id % 4 = 1", "event_id % 4 = 3")]
    return X.drain_in_turn(parts, lambda arriving: X.without_repeats(arriving, ["event_id"], "3 days"))
