"""Queries over status events, jobs, logs and keyed lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.operators import joins as J
from voxledger.operators import records as R
from voxledger.operators import runs as U
from voxledger.operators.ordered import previous
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


_STATUS = """
st AS (
  SELECT user_id AS dataset_id, event_id AS ord, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'processing' WHEN 'click' THEN 'saving-data'
              WHEN 'purchase' THEN 'complete' ELSE 'failed' END AS status
  FROM events
)"""
_JOBS = """
jobs AS (
  SELECT l_suppkey AS run, l_orderkey, l_linenumber, l_quantity AS seconds, l_extendedprice / 100.0 AS mb, l_quantity > 45 AS special,
         CASE WHEN l_returnflag = 'R' THEN 'failed' WHEN l_linenumber = 7 THEN 'skipped' ELSE 'complete' END AS status,
         CASE l_suppkey % 5 WHEN 0 THEN 'ebi' WHEN 1 THEN 'epfl' WHEN 2 THEN 'flyem' WHEN 3 THEN 'idr' ELSE 'openorganelle' END AS loader
  FROM lineitem
)"""
_LOG = """
ev AS (
  SELECT event_id, event_id // 400 AS log_id, 'svc' || event_id // 4 AS service, event_type AS kind,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
m AS (
  SELECT *, CASE WHEN kind = 'purchase' AND k < 40 THEN 'exit0' WHEN kind = 'error' AND k < 30 THEN 'exit' || (1 + k % 9)
                 WHEN kind = 'error' AND k < 50 THEN 'net' WHEN kind = 'error' AND k < 70 THEN 'perm' WHEN kind = 'error' AND k < 85 THEN 'fail'
                 WHEN kind = 'error' THEN 'err' WHEN kind = 'signup' AND k < 40 THEN 'saved'
                 WHEN kind = 'click' AND k < 2 THEN 'import' ELSE 'info' END AS msg FROM ev
),
f AS (
  SELECT log_id, service, bool_or(msg = 'exit0') AS ok, bool_or(msg LIKE 'exit_' AND msg <> 'exit0') AS bad,
         arg_max(substr(msg, 5), event_id) FILTER (msg LIKE 'exit_') AS code, bool_or(msg = 'saved') AS good,
         bool_or(msg IN ('net', 'perm', 'fail', 'err') OR (msg = 'import' AND false)) AS words, bool_or(msg = 'import') AS import,
         bool_or(msg = 'net') AS net, bool_or(msg = 'perm') AS perm FROM m GROUP BY ALL
),
o AS (
  SELECT log_id, service, CASE WHEN ok THEN 'success' WHEN bad THEN 'failed:' || code WHEN good THEN 'success_words'
           WHEN bool_or(import) OVER (PARTITION BY log_id) THEN 'config_error' WHEN words THEN 'error_words' ELSE 'in_progress' END AS outcome
  FROM f
)"""


# ---- status folds ------------------------------------------------------------------
@register(
    f"""WITH {_STATUS} SELECT dataset_id, arg_max(status, ord) AS status, max(ts) AS updated_at,
          arg_max(CAST(k AS DOUBLE), ord) FILTER (status = 'processing') AS progress,
          'step ' || arg_max(k, ord) FILTER (status = 'saving-data') AS step,
          'code ' || arg_max(k, ord) FILTER (status = 'failed' AND k % 4 <> 0) AS error_message,
          nullif(count(*) FILTER (status = 'failed'), 0) AS retry_count FROM st GROUP BY dataset_id"""
)
def status_latest(spark: SparkSession, sf: str) -> DataFrame:
    return R.status_state(T.status_events(spark, sf))


@register(
    f"""WITH {_STATUS} SELECT dataset_id, arg_max(status, ord) AS status, max(ord) AS ord FROM st
        WHERE status IN ('saving-data', 'complete') GROUP BY dataset_id"""
)
def stub_then_final(spark: SparkSession, sf: str) -> DataFrame:
    """Stub and final writes of each record: the later one holds."""
    events = T.status_events(spark, sf).select("dataset_id", "ord", "status")
    writes = events.where("status = 'saving-data'").unionByName(events.where("status = 'complete'"))
    return R.latest_wins(writes, ["dataset_id"], ["ord"])


@register(
    f"""WITH {_STATUS} SELECT dataset_id, ord, count(*) FILTER (status = 'failed')
          OVER (PARTITION BY dataset_id ORDER BY ord ROWS UNBOUNDED PRECEDING) AS retry_count FROM st"""
)
def retry_count(spark: SparkSession, sf: str) -> DataFrame:
    return U.retry_count(T.status_events(spark, sf)).select("dataset_id", "ord", "retry_count")


@register(
    """SELECT event_id, event_type AS run, completed, succeeded, elapsed, CAST(floor(elapsed / nullif(completed, 0) * 1000) AS BIGINT) AS average_milli,
              CAST(floor((total - completed) * (elapsed / nullif(completed, 0))) AS BIGINT) AS eta
       FROM (SELECT event_id, event_type, row_number() OVER w - 1 AS completed, coalesce(CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER b AS BIGINT), 0) AS elapsed,
                    coalesce(count(*) FILTER (user_id % 3 > 0) OVER b, 0) AS succeeded, count(*) OVER (PARTITION BY event_type) AS total
             FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id),
                  b AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
)
def running_eta(spark: SparkSession, sf: str) -> DataFrame:
    """Progress of five long runs, one per event type, in hundredths of a second."""
    e = T.table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("run"), F.round(F.col("value") * 100).cast("bigint").alias("seconds"),
        F.when(F.col("user_id") % 3 > 0, "complete").otherwise("failed").alias("status"),
    )
    p = U.running_progress(e, ["run"], "event_id")
    return p.select(
        "event_id", "run", "completed", "succeeded", "elapsed", F.floor(F.col("average") * 1000).alias("average_milli"),
        F.floor("eta_seconds").alias("eta"),
    )


@register(
    """SELECT event_id, user_id, lag(event_id) OVER w AS before_id, round(epoch_us(ts) / 1e6 - epoch_us(lag(ts) OVER w) / 1e6, 3) AS gap
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)"""
)
def previous_event(spark: SparkSession, sf: str) -> DataFrame:
    e = T.table(spark, sf, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    p = previous(e, ["user_id"], "event_id", {"before_id": "event_id", "before_ts": "ts"})
    gap = F.unix_micros("ts") / 1e6 - F.unix_micros("before_ts") / 1e6
    return p.select("event_id", "user_id", "before_id", F.round(gap, 3).alias("gap"))


@register(
    """, m AS (SELECT user_id, time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2024-01-01') AS w, sum(b) AS nbytes, max(ts) AS ts
              FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS b FROM events) GROUP BY ALL),
         l AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY w) AS before, sum(nbytes) OVER (PARTITION BY user_id ORDER BY w) AS done FROM m)
       , s AS (SELECT *, nbytes / nullif(epoch_us(ts) / 1e6 - epoch_us(before) / 1e6, 0) AS speed FROM l),
         r AS (SELECT *, CASE WHEN speed > 0 THEN greatest(5000000 - done, 0) / speed ELSE 0.0 END AS eta FROM s)
       SELECT user_id AS dataset_id, w AS start, nbytes, done, round(speed, 3) AS speed, round(eta / 3600, 2) AS eta_hours,
              CASE WHEN eta > 3600 THEN 'h' WHEN eta > 60 THEN 'm' ELSE 's' END AS eta_unit FROM r""".replace(", m AS", "WITH m AS", 1)
)
def interval_speed(spark: SparkSession, sf: str) -> DataFrame:
    e = T.table(spark, sf, "events").select(
        F.col("user_id").alias("dataset_id"), F.col("ts").cast("timestamp").alias("ts"), F.round(F.col("value") * 100).cast("bigint").alias("nbytes")
    )
    marks = U.interval_speed(e, "6 hours", F.lit(5_000_000))
    return marks.select(
        "dataset_id", F.col("w.start").alias("start"), "nbytes", "done", F.round("speed", 3).alias("speed"),
        F.round(F.col("eta_seconds") / 3600, 2).alias("eta_hours"), F.right("eta", F.lit(1)).alias("eta_unit"),
    )


# ---- run summaries ---------------------------------------------------------------------
@register(
    f"""WITH {_JOBS}, a AS (SELECT run, count(*) FILTER (status = 'complete') AS succeeded, count(*) FILTER (status = 'failed') AS failed,
            count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status <> 'skipped') AS tried,
            sum(seconds) FILTER (status <> 'skipped') AS s, sum(mb) FILTER (status <> 'skipped') / 1024.0 AS gb,
            sum(mb) FILTER (status <> 'skipped' AND NOT special) / 1024.0 AS gbn FROM jobs GROUP BY run)
        SELECT run, succeeded, failed, skipped, round(succeeded * 100.0 / nullif(tried, 0), 1) AS success_rate, round(s / tried, 4) AS avg_seconds,
               round(s / nullif(succeeded, 0), 4) AS avg_seconds_success, round(succeeded * 60.0 / s, 4) AS per_minute,
               round(gb * 3600 / s, 4) AS gb_per_hour, round(gbn * 3600 / s, 4) AS gb_per_hour_normal,
               lpad(CAST(CAST(s AS BIGINT) // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(s AS BIGINT) % 3600 // 60 AS VARCHAR), 2, '0')
                 || ':' || lpad(CAST(CAST(s AS BIGINT) % 60 AS VARCHAR), 2, '0') AS duration FROM a"""
)
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return U.run_summary(T.jobs(spark, sf), ["run"])


@register(
    f"""WITH {_JOBS}, a AS (SELECT loader, sum(mb) AS mb, sum(seconds) AS s FROM jobs GROUP BY loader)
        SELECT loader, round(mb, 2) AS mb, s AS seconds, round(mb / s, 4) AS mb_s, rank() OVER (ORDER BY mb / s DESC) AS place FROM a"""
)
def throughput_rank(spark: SparkSession, sf: str) -> DataFrame:
    ranked = U.throughput_rank(T.jobs(spark, sf), "loader")
    return ranked.select("loader", F.round("mb", 2).alias("mb"), "seconds", F.round("mb_s", 4).alias("mb_s"), "place")


@register(
    f"""WITH {_JOBS}, s AS (SELECT CAST(floor(mb / 100) AS BIGINT) AS size_step, avg(mb) AS mb, avg(seconds) AS seconds FROM jobs GROUP BY 1),
          p AS (SELECT *, lag(mb) OVER (ORDER BY size_step) AS pm, lag(seconds) OVER (ORDER BY size_step) AS ps FROM s)
        SELECT size_step, round(mb / pm, 4) AS size_ratio, round(seconds / ps, 4) AS time_ratio, coalesce(seconds / ps > mb / pm, false) AS cliff FROM p"""
)
def size_cliffs(spark: SparkSession, sf: str) -> DataFrame:
    j = T.jobs(spark, sf)
    steps = j.groupBy(F.floor(F.col("mb") / 100).cast("bigint").alias("size_step")).agg(
        F.avg("mb").alias("mb"), F.avg("seconds").alias("seconds")
    )
    found = U.size_cliffs(steps)
    return found.select("size_step", F.round("size_ratio", 4).alias("size_ratio"), F.round("time_ratio", 4).alias("time_ratio"), "cliff")


# ---- logs ----------------------------------------------------------------------------------
@register(
    """SELECT event_id AS line_no, strftime(ts, '%Y-%m-%d %H:%M:%S') AS log_time, 'svc' || event_id // 4 || '-ingest' AS logger,
              CASE WHEN event_type = 'error' AND CAST(json_extract_string(props, '$.k') AS BIGINT) >= 30 THEN 'ERROR' ELSE 'INFO' END AS log_level
       FROM events"""
)
def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return U.parse_log(T.log_lines(spark, sf)).select("line_no", "log_time", "logger", "log_level")


@register(
    f"""WITH {_LOG} SELECT log_id, service, outcome FROM o
        UNION ALL SELECT log_id, 'extra', 'unknown' FROM (SELECT DISTINCT log_id FROM o)"""
)
def log_outcome(spark: SparkSession, sf: str) -> DataFrame:
    lines = T.log_lines(spark, sf)
    seen = lines.select("log_id", "service").distinct()
    expected = seen.unionByName(lines.select("log_id", F.lit("extra").alias("service")).distinct())
    return U.with_unseen(U.log_outcome(lines), expected)


@register(
    f"""WITH {_LOG} SELECT log_id, service, CASE WHEN import THEN 'config' WHEN net THEN 'network' WHEN perm THEN 'auth' ELSE 'none' END AS hint FROM f"""
)
def log_hint(spark: SparkSession, sf: str) -> DataFrame:
    return U.log_hint(T.log_lines(spark, sf))


@register(
    f"""WITH {_LOG} SELECT log_id, coalesce(string_agg(service, ',' ORDER BY service) FILTER (NOT starts_with(outcome, 'success')), '') AS failed_services,
          coalesce(string_agg(service, ',' ORDER BY service) FILTER (starts_with(outcome, 'success')), '') AS successful_services,
          count(*) FILTER (NOT starts_with(outcome, 'success')) AS failed, count(*) FILTER (starts_with(outcome, 'success')) AS succeeded
        FROM o GROUP BY log_id"""
)
def service_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Failed and succeeded services of every log, with their counts."""
    return U.service_lists(U.log_outcome(T.log_lines(spark, sf)))


@register(f"""WITH {_LOG} SELECT log_id, service, outcome, starts_with(outcome, 'success') AS succeeded FROM o""")
def service_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Failed and succeeded services, a row each."""
    return U.service_outcomes(U.log_outcome(T.log_lines(spark, sf)))


@register(
    f"""WITH {_LOG} SELECT log_id, count(*) FILTER (NOT starts_with(outcome, 'success')) AS failed,
          count(*) FILTER (starts_with(outcome, 'success')) AS succeeded FROM o GROUP BY log_id"""
)
def service_counts(spark: SparkSession, sf: str) -> DataFrame:
    return U.service_counts(U.log_outcome(T.log_lines(spark, sf)))


# ---- keyed lookups ---------------------------------------------------------------------------
@register(
    """SELECT c.c_custkey, n.n_name, CASE WHEN n.n_name IS NULL THEN 'No path found for ' || c.k || '.' END AS error
       FROM (SELECT *, c_nationkey + CASE WHEN c_custkey % 10 = 0 THEN 100 ELSE 0 END AS k FROM customer) c
       LEFT JOIN nation n ON n.n_nationkey = c.k"""
)
def source_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = T.table(spark, sf, "customer")
    shifted = F.col("c_nationkey") + F.when(F.col("c_custkey") % 10 == 0, 100).otherwise(0)
    rows = c.select("c_custkey", shifted.alias("n_nationkey"))
    found = J.lookup_or_error(rows, T.table(spark, sf, "nation"), "n_nationkey", "n_name", "No path found for %s.")
    return found.select("c_custkey", "n_name", "error")


@register(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ftp' WHEN 'O' THEN 'http' END AS path,
              CASE o_orderstatus WHEN 'F' THEN 'primary' WHEN 'O' THEN 'fallback' ELSE 'failed' END AS origin FROM orders"""
)
def fallback(spark: SparkSession, sf: str) -> DataFrame:
    o = T.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    first = o.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("ftp").alias("path"))
    second = o.where("o_orderstatus IN ('F', 'O')").select("o_orderkey", F.lit("http").alias("path"))
    return J.primary_or_fallback(o.select("o_orderkey"), first, second, "o_orderkey", "path")


@register("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def work_list(spark: SparkSession, sf: str) -> DataFrame:
    finished = T.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return J.work_list(T.table(spark, sf, "orders").select("o_orderkey"), finished, ["o_orderkey"])


@register("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def known_sources(spark: SparkSession, sf: str) -> DataFrame:
    nations = T.table(spark, sf, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("s_nationkey"))
    return J.known_only(T.table(spark, sf, "supplier"), nations, "s_nationkey").select("s_suppkey", "s_name")


@register(
    """SELECT CAST(s_suppkey AS VARCHAR) AS source, 'n' || s_nationkey AS name,
              CASE WHEN s_nationkey < 5 THEN 'env' WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'default' END AS value FROM supplier"""
)
def settings_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """Defaults overlaid per source and by the environment."""
    s = T.table(spark, sf, "supplier")
    name, source = F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("name"), F.col("s_suppkey").cast("string").alias("source")
    defaults = s.select(source, name, F.lit("default").alias("value"))
    own = s.where("s_suppkey % 2 = 0").select(source, name, F.col("s_name").alias("value"))
    nation = T.table(spark, sf, "nation").where("n_nationkey < 5")
    env = nation.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("name"), F.lit("env").alias("value"))
    return J.overlay(defaults, own, env)
