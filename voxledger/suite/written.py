"""Queries over what the sinks wrote: validated records and the report, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxledger.operators import sinks as K
from voxledger.session import shared_dir
from voxledger.sources import tables as T
from voxledger.suite.record_sql import with_results

QUERIES = {}
ORACLES: dict[str, str] = {}


def register(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return add


@register(
    with_results(
        """SELECT file, source, CASE WHEN valid THEN 'valid' ELSE 'quarantine' END AS outcome, error_class, error,
                  parsed AS has_record FROM results"""
    )
)
def validated_write(spark: SparkSession, sf: str) -> DataFrame:
    """Valid records and quarantine from one commit."""
    path = shared_dir(spark, "validated")
    K.write_validated(T.checked_records(spark, sf), path)
    return spark.read.parquet(path).select(
        "file", "source", "outcome", "error_class", F.get("errors", F.lit(0)).alias("error"), F.col("record").isNotNull().alias("has_record")
    )


@register(with_results("SELECT file, source, valid, error FROM results"))
def report_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The report's row of every file."""
    path = shared_dir(spark, "report")
    K.write_report(T.checked_records(spark, sf), f"{path}/rows", f"{path}/summary")
    rows = spark.read.schema("errors array<string>, file string, source string, valid boolean").json(f"{path}/rows")
    return rows.select("file", "source", "valid", F.get("errors", F.lit(0)).alias("error"))


@register(
    with_results(
        """SELECT count(*) AS total_files, count(*) FILTER (valid) AS valid_files, count(*) FILTER (NOT valid) AS invalid_files,
                  count(DISTINCT source) AS sources FROM results"""
    )
)
def report_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The report's one-row summary document."""
    path = shared_dir(spark, "report")
    K.write_report(T.checked_records(spark, sf), f"{path}/rows", f"{path}/summary")
    doc = spark.read.text(f"{path}/summary", wholetext=True).select(F.parse_json("value").alias("d"))
    number = lambda name: F.try_variant_get("d", f"$.summary.{name}", "bigint").alias(name)
    by_source = F.try_variant_get("d", "$.summary.errors_by_source", "map<string,variant>")
    return doc.select(*[number(n) for n in ("total_files", "valid_files", "invalid_files")], F.size(by_source).cast("bigint").alias("sources"))
