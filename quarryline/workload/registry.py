"""Where queries and their SQL are collected."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")

    @wraps(run)
    def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return run(spark, sf_dir)

    QUERIES[name] = in_utc
    if sql is not None:
        ORACLE[name] = sql


def query(name: str, sql: str | None = None):
    """Register the decorated function under a name."""

    def decorate(run):
        register(name, run, sql)
        return run

    return decorate
