"""Columnar output, where every type and every NULL stays what it is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.types import quote


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Parquet files. With partition columns, a rebalance lets one large partition value be written by
    many tasks and many small ones by few, instead of every task opening a file for every value. Rows
    sorted by a watermark within each task let later pulls skip row groups by their bounds."""
    if partition_by:
        df = df.hint("rebalance", *(F.col(quote(c)) for c in partition_by))
    if sort_by:
        df = df.sortWithinPartitions(*(F.col(quote(c)) for c in [*(partition_by or []), *sort_by]))
    df.write.mode(mode).partitionBy(*(partition_by or [])).parquet(path)


def remove(spark: SparkSession, path: str) -> bool:
    """Takes away a folder of the store that Spark writes to; whether there was one."""
    store_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return store_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(store_path, True)


def save_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, **options: str) -> None:
    """A table stored by hash of its keys, so that merging changes by these keys moves the changes and
    not the table."""
    df.write.mode("overwrite").options(**options).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
