"""Structured Streaming forms: validation, status fold, alerts, access, sessions.

Each transformation takes a streaming (or batch) DataFrame; ``drain`` runs one
to the end of its input and returns what the sink holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxledger.operators.records import status_state
from voxledger.operators.validate import validate
from voxledger.session import shared_dir
from voxledger.sources.files import is_folder, with_path_parts


def arriving_files(spark: SparkSession, folder: str) -> DataFrame:
    """Record files as they appear in a folder, whole files as rows."""
    # The argument, not the option: the text reader resets the option.
    raw = spark.readStream.option("recursiveFileLookup", "true").text(folder, wholetext=True)
    return with_path_parts(
        raw.select(
            F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_modification_time").alias("mtime"), "value"
        )
    )


def arriving_table(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table as a stream; a single file is read through its folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def drain(stream: DataFrame, mode: str = "append", keys: list[str] | None = None) -> DataFrame:
    """Run a stream over all available input and return the sink's rows.

    Append results go to a parquet sink.  Update results are written per batch
    and the last batch that holds a key wins.
    """
    spark = stream.sparkSession
    out, state = shared_dir(spark, "stream-out"), shared_dir(spark, "stream-state")
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", out)
    else:

        def save(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

        writer = stream.writeStream.foreachBatch(save)
    query = writer.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    kept = spark.read.schema(stream.schema if mode == "append" else T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).parquet(out)
    if mode == "append":
        return kept
    rest = [c for c in stream.columns if c not in (keys or [])]
    latest = F.max_by(F.struct(*rest), F.col("batch"))
    return kept.groupBy(*(keys or [])).agg(latest.alias("r")).select(*(keys or []), "r.*")


def drain_in_turn(parts: list[DataFrame], change: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows that a stream with one state gives when ``parts`` arrive one after the other, each to its end.

    Every part is written with all its files, then the query is started again where it stopped.
    """
    spark, schema = parts[0].sparkSession, parts[0].schema
    inbox, out, state = (shared_dir(spark, f"stream-{n}") for n in ("inbox", "out", "state"))
    for part in parts:
        part.write.mode("append").parquet(inbox)
        stream = change(arriving_table(spark, inbox, schema))
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(change(arriving_table(spark, inbox, schema)).schema).parquet(out)


def validate_each(files: DataFrame, roots: list[str]) -> DataFrame:
    """The batch rules on arriving files; nothing is kept between batches."""
    return validate(files, roots).select("file", "source", "valid", "error_class", F.get("errors", F.lit(0)).alias("error"))


def watch_folder(spark: SparkSession, folder: str, sink: Callable[[DataFrame, int], None], roots: list[str], checkpoint: str):
    """Validate files as they arrive and hand each batch of results to a sink."""
    results = validate_each(arriving_files(spark, folder), roots)
    return results.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def status_fold(events: DataFrame) -> DataFrame:
    """Current status per data set.

    The fold is made of aggregates ordered by event number, so the state store
    keeps one row per data set and late events need no sorting.
    """
    return status_state(events)


def validation_rate(results: DataFrame, every: str = "1 day", lateness: str = "1 hour") -> DataFrame:
    """Share of valid files per tumbling window of arrival time."""
    return (
        results.withWatermark("ts", lateness)
        .groupBy(F.window("ts", every).alias("w"))
        .agg(F.count(F.lit(1)).alias("files"), F.count_if("valid").alias("valid"))
        .withColumn("rate", F.col("valid") * 100.0 / F.col("files"))
        .select(F.col("w.start").alias("start"), "files", "valid", "rate")
    )


def rate_alerts(rates: DataFrame, threshold: float = 95.0) -> DataFrame:
    return rates.where(F.col("rate") < threshold)


def access_windows(events: DataFrame, size: str, slide: str | None = None, lateness: str = "1 hour") -> DataFrame:
    """Access counts and volume per key and (sliding) window."""
    return (
        events.withWatermark("ts", lateness)
        .groupBy(F.window("ts", size, slide).alias("w"), "kind")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))
        .select(F.col("w.start").alias("start"), "kind", "n", "cents")
    )


def quiet_sessions(events: DataFrame, timeout: str = "3 hours", lateness: str = "1 hour") -> DataFrame:
    """Sessions per data set that end when nothing happens for ``timeout``."""
    return (
        events.withWatermark("ts", lateness)
        .groupBy("dataset_id", F.session_window("ts", timeout).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("dataset_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
    )


def quiet_sessions_batch(events: DataFrame, timeout_seconds: int = 10800) -> DataFrame:
    """Batch twin of ``quiet_sessions`` for hot data sets.

    Events first shrink to one row per data set and time slot shorter than the
    timeout; slots, whose number does not grow with the events, are then joined
    into sessions by the gap between them.
    """
    from pyspark.sql import Window

    micros = F.unix_micros("ts")
    slot = F.floor(micros / (timeout_seconds * 500_000)).cast("bigint")
    slots = events.groupBy("dataset_id", slot.alias("slot")).agg(
        F.min(micros).alias("lo"), F.max(micros).alias("hi"), F.count(F.lit(1)).alias("n")
    )
    order = Window.partitionBy("dataset_id").orderBy("slot")
    gap = timeout_seconds * 1_000_000
    starts = F.coalesce(F.col("lo") - F.lag("hi").over(order) > gap, F.lit(True)).cast("int")
    numbered = slots.withColumn("new", starts).withColumn("session", F.sum("new").over(order))
    return numbered.groupBy("dataset_id", "session").agg(
        F.timestamp_micros(F.min("lo")).alias("start"), F.timestamp_micros(F.max("hi") + gap).alias("end"), F.sum("n").alias("n")
    ).drop("session")


def without_repeats(events: DataFrame, keys: list[str], lateness: str = "1 hour") -> DataFrame:
    """First arrival per key within the watermark."""
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(keys)


def late_rows(query) -> int:
    """Rows a finished query dropped for being later than the watermark."""
    return sum(
        op.numRowsDroppedByWatermark for progress in query.recentProgress for op in progress.stateOperators
    )
