"""Job state: one appended row per run, the last of which counts.

A row is added after the run's data is committed. A run that fails before leaves the old state, is
repeated with the same number, and writes to the same folder again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession, functions as F

_SCHEMA = "run long, last_fetched_row string, last_fetched_time string, rows long"


@dataclass(frozen=True)
class State:
    run: int = 0
    last_fetched_row: str | None = None
    last_fetched_time: str | None = None


def read_state(spark: SparkSession, path: str) -> State:
    try:
        runs = spark.read.schema(_SCHEMA).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return State()
    last = runs.agg(F.max_by(F.struct("run", "last_fetched_row", "last_fetched_time"), "run").alias("last")).first()
    return State(*last["last"]) if last["last"] else State()


def append_state(spark: SparkSession, path: str, state: State, rows: int) -> None:
    row = (state.run, state.last_fetched_row, state.last_fetched_time, rows)
    spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("append").json(path)
