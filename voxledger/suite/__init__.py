"""Registered queries and their SQL twins, by area."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
AREAS = ["records", "arrays", "volumes", "runs", "streams", "lookups", "matching", "written"]


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for area in AREAS:
        out.update(import_module(f"voxledger.suite.{area}").QUERIES)
    return out


def all_oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for area in AREAS:
        out.update(import_module(f"voxledger.suite.{area}").ORACLES)
    return out
