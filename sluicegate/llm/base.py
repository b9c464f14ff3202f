"""What the operators share: the registry of their queries, the notion of a word, and stored intermediate results."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: A word is a run of bytes that are not ASCII white space (the same pattern in Spark and DuckDB).
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of a batch of rows that goes to Python at once. Texts may be long, and a batch is held several times over.
BATCH_BYTES = 8 << 20

_shipped: set[str] = set()


def ship(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Sends this package to the Python workers of an application, wherever it was started from, and bounds what they
    are handed at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="sluice-")  # Spark serves the archive from here while the driver lives
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        shutil.copytree(package, f"{folder}/src/{os.path.basename(package)}", ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(f"{folder}/sluicegate_llm", "zip", f"{folder}/src"))
        _shipped.add(context.applicationId)


def registered(oracle: str | None = None):
    """Registers a query under its function's name."""

    def add(fn):
        @functools.wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = query
        if oracle is not None:
            ORACLES[fn.__name__] = oracle.strip()
        return fn

    return add


def removed_at_exit(spark: SparkSession, path: str) -> str:
    """Has Hadoop remove a folder of the shared store when the driver ends."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, read back from a table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    path = removed_at_exit(spark, scratch_dir(spark, purpose))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
