"""Registry of the queries, each with the SQL text another engine answers it with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(oracle: str | None = None):
    """Registers a query under its function's name, without underscores at its end."""

    def add(fn):
        name = fn.__name__.rstrip("_")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")
