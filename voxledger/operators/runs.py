"""Run summaries, retries, progress, rankings and log outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxledger import contract
from voxledger.functions.text import duration_text, eta_text
from voxledger.operators.ordered import running


def run_summary(jobs: DataFrame, keys: list[str]) -> DataFrame:
    """Counts, rates and throughput of jobs (status, seconds, mb) per run.

    Success is counted by status.  ``gb_per_hour`` is over every processed
    array; ``gb_per_hour_normal`` leaves the special ones out.
    """
    ok, bad, skip = (F.col("status") == s for s in ("complete", "failed", "skipped"))
    seconds = F.sum(F.when(~skip, F.col("seconds")))
    done = F.count_if(ok)
    tried = F.count_if(~skip)
    gb = F.sum(F.when(~skip, F.col("mb"))) / F.lit(1024.0)
    gb_normal = F.sum(F.when(~skip & ~F.col("special"), F.col("mb"))) / F.lit(1024.0)
    return jobs.groupBy(*keys).agg(
        done.alias("succeeded"),
        F.count_if(bad).alias("failed"),
        F.count_if(skip).alias("skipped"),
        F.round(F.try_divide(done * F.lit(100.0), tried), 1).alias("success_rate"),
        F.round(F.try_divide(seconds, tried), 4).alias("avg_seconds"),
        F.round(F.try_divide(seconds, done), 4).alias("avg_seconds_success"),
        F.round(F.try_divide(done * F.lit(60.0), seconds), 4).alias("per_minute"),
        F.round(F.try_divide(gb * 3600, seconds), 4).alias("gb_per_hour"),
        F.round(F.try_divide(gb_normal * 3600, seconds), 4).alias("gb_per_hour_normal"),
        duration_text(seconds).alias("duration"),
    )


def throughput(jobs: DataFrame, key: str) -> DataFrame:
    """Size and MB/s per loader."""
    return jobs.groupBy(key).agg(
        F.sum("mb").alias("mb"), F.sum("seconds").alias("seconds"),
        F.try_divide(F.sum("mb"), F.sum("seconds")).alias("mb_s"),
    )


def throughput_rank(jobs: DataFrame, key: str) -> DataFrame:
    """Loaders by throughput; the ranked table has one row per loader."""
    return throughput(jobs, key).withColumn("place", F.rank().over(Window.orderBy(F.desc("mb_s"))))


def size_cliffs(steps: DataFrame) -> DataFrame:
    """Time per size step against the step before.

    ``steps`` holds one row per size class (aggregated), so the ordering
    window sees only the classes.
    """
    order = Window.orderBy("size_step")
    before = steps.withColumns(
        {"prev_mb": F.lag("mb").over(order), "prev_seconds": F.lag("seconds").over(order)}
    )
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return before.withColumns(
        {"size_ratio": ratio("mb", "prev_mb"), "time_ratio": ratio("seconds", "prev_seconds")}
    ).withColumn("cliff", F.coalesce(F.col("time_ratio") > F.col("size_ratio"), F.lit(False)))


def running_progress(jobs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Completed and elapsed before each job, the average so far and the ETA."""
    ok = (F.col("status") == "complete").cast("bigint")
    bad = (F.col("status") == "failed").cast("bigint")
    so_far = running(
        jobs, keys, order,
        {"completed": F.lit(1).cast("bigint"), "succeeded": ok, "failed_before": bad, "elapsed": F.col("seconds")},
    )
    total = jobs.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    average = F.try_divide(F.col("elapsed"), F.col("completed"))
    return so_far.join(total, keys).withColumns(
        {"average": average, "eta_seconds": (F.col("total") - F.col("completed")) * average}
    )


def retry_count(events: DataFrame) -> DataFrame:
    """Failures so far per data set at each status event."""
    return running(
        events, ["dataset_id"], "ord", {"retry_count": (F.col("status") == "failed").cast("bigint")}, True
    )


def interval_speed(progress: DataFrame, every: str, total: Column) -> DataFrame:
    """Speed between progress marks and the remaining time.

    Events are first reduced to one mark per key and interval, so the window
    per key runs over intervals, not events.
    """
    marks = progress.groupBy("dataset_id", F.window("ts", every).alias("w")).agg(
        F.sum("nbytes").alias("nbytes"), F.max("ts").alias("ts")
    )
    per_key = Window.partitionBy("dataset_id").orderBy("w.start")
    marks = marks.withColumns(
        {
            "before": F.lag("ts").over(per_key),
            "done": F.sum("nbytes").over(per_key.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    seconds = (F.unix_micros("ts") - F.unix_micros("before")) / F.lit(1e6)
    marks = marks.withColumn("speed", F.try_divide(F.col("nbytes"), seconds))
    eta = F.when(F.col("speed") > 0, F.greatest(total - F.col("done"), F.lit(0)) / F.col("speed")).otherwise(F.lit(0.0))
    return marks.withColumn("eta_seconds", eta).withColumn("eta", eta_text(F.col("eta_seconds")))


# ---- logs ---------------------------------------------------------------------------
def parse_log(lines: DataFrame, column: str = "line") -> DataFrame:
    """``time - logger - LEVEL - message`` lines into columns."""
    pattern = r"^(\S+ \S+) - (\S+) - ([A-Z]+) - (.*)$"
    names = ["log_time", "logger", "log_level", "message"]
    return lines.withColumns({n: F.regexp_extract(column, pattern, i + 1) for i, n in enumerate(names)})


def log_outcome(lines: DataFrame) -> DataFrame:
    """Outcome of each service from the log lines that name it.

    Order of precedence: exit 0, another exit code (the last one named),
    success words, a configuration import error anywhere in the log, error
    words, seen at all.
    """
    text = F.col("line")
    code = F.regexp_extract(text, "exited with code ([0-9]+)", 1)
    exit_line = code != ""
    flags = lines.groupBy("log_id", "service").agg(
        F.bool_or(code.startswith("0")).alias("exit_ok"),
        F.bool_or(code.rlike("^[1-9]")).alias("exit_bad"),
        F.max_by(F.when(exit_line, code), F.when(exit_line, F.col("line_no"))).alias("code"),
        F.bool_or(text.rlike("SUCCESS:.*Saved|completed successfully|SUCCESS")).alias("good_words"),
        F.bool_or(text.rlike("ERROR|Failed|Traceback")).alias("bad_words"),
        F.bool_or(text.rlike(contract.LOG_IMPORT_ERROR)).alias("import_error"),
    )
    per_log = flags.groupBy("log_id").agg(F.bool_or("import_error").alias("log_import_error"))
    outcome = (
        F.when(F.col("exit_ok"), "success")
        .when(F.col("exit_bad"), F.concat(F.lit("failed:"), "code"))
        .when(F.col("good_words"), "success_words")
        .when(F.col("log_import_error"), "config_error")
        .when(F.col("bad_words"), "error_words")
        .otherwise("in_progress")
    )
    return flags.join(per_log, "log_id").select("log_id", "service", outcome.alias("outcome"))


def with_unseen(outcomes: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected services that no line names are ``unknown``."""
    return expected.join(outcomes, ["log_id", "service"], "left").withColumn(
        "outcome", F.coalesce("outcome", F.lit("unknown"))
    )


def log_hint(lines: DataFrame) -> DataFrame:
    """First matching cause of failure per service: config, network or auth."""
    text = F.col("line")
    flags = lines.groupBy("log_id", "service").agg(
        F.bool_or(text.rlike(contract.LOG_IMPORT_ERROR)).alias("config"),
        F.bool_or(text.rlike("Connection refused|timeout|network")).alias("network"),
        F.bool_or(text.rlike("Permission denied|Authentication failed")).alias("auth"),
    )
    hint = F.when(F.col("config"), "config").when(F.col("network"), "network").when(F.col("auth"), "auth")
    return flags.select("log_id", "service", F.coalesce(hint, F.lit("none")).alias("hint"))


def service_outcomes(outcomes: DataFrame) -> DataFrame:
    """A row per log and service: its outcome and whether it succeeded."""
    return outcomes.select("log_id", "service", "outcome", F.col("outcome").startswith("success").alias("succeeded"))


def service_lists(outcomes: DataFrame) -> DataFrame:
    """Failed and succeeded services per log, in order and joined by commas, with their counts."""
    good = F.col("outcome").startswith("success")
    listed = lambda keep: F.array_join(F.array_sort(F.collect_list(F.when(keep, F.col("service")))), ",")
    return outcomes.groupBy("log_id").agg(
        listed(~good).alias("failed_services"), listed(good).alias("successful_services"),
        F.count_if(~good).alias("failed"), F.count_if(good).alias("succeeded"),
    )


def service_counts(outcomes: DataFrame) -> DataFrame:
    """Failed and succeeded services per log."""
    good = F.col("outcome").startswith("success")
    return outcomes.groupBy("log_id").agg(F.count_if(~good).alias("failed"), F.count_if(good).alias("succeeded"))
