"""A target table in hash buckets of its key, of which a merge rewrites only those that its changes fall into.

    <path>/data/run=<n>/bucket=<b>/*.parquet    rows of a bucket as a run left them
    <path>/index/*.json                         one row a run and bucket: the run that holds the bucket's present rows
    <path>/layout/*.json                        the key, the number of buckets and the schema, written once

A merge writes the touched buckets under its own number and then names them in the index, in one file. Until then readers
see the buckets as they were, so a merge that dies midway has changed nothing and is repeated under the same number. Files
of other buckets are neither read nor written. One writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..errors import JobError
from ..functions.types import quote
from ..operators.cdc import IS_DELETED
from ..operators.merge import apply_changes, upsert
from .columnar import remove, write_parquet

BUCKET = "bucket"
_INDEX = f"run long, {BUCKET} int, filled boolean"
_LAYOUT = "keys array<string>, buckets int, schema string"


@dataclass(frozen=True)
class BucketedTable:
    """A stored table: where it is, its key, its number of buckets and its columns."""

    spark: SparkSession
    path: str
    keys: list[str]
    buckets: int
    schema: T.StructType

    @classmethod
    def create(cls, rows: DataFrame, path: str, keys: list[str], buckets: int) -> BucketedTable:
        """Stores ``rows``, which hold each key once, as a new table."""
        if BUCKET in rows.columns or IS_DELETED in rows.columns:
            raise JobError(f'A bucketed table has no columns "{BUCKET}" and "{IS_DELETED}" of its own.')
        table = cls(rows.sparkSession, path, keys, buckets, rows.schema)
        if _read(table.spark, f"{path}/layout", _LAYOUT) is not None:
            raise JobError(f'There is a table at "{path}" already.')
        written = table._write(rows, 0)
        table._index(0, written, written, "overwrite")
        layout = table.spark.createDataFrame([(keys, buckets, rows.schema.json())], _LAYOUT)
        layout.coalesce(1).write.mode("overwrite").json(f"{path}/layout")
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> BucketedTable:
        layout = _read(spark, f"{path}/layout", _LAYOUT)
        if layout is None:
            raise JobError(f'There is no bucketed table at "{path}".')
        row = layout.first()
        return cls(spark, path, list(row["keys"]), row["buckets"], T.StructType.fromJson(json.loads(row["schema"])))

    def bucket(self) -> Column:
        """The bucket of a row by its key, which is taken in the types of the stored columns."""
        key = (F.col(quote(k)).cast(self.schema[k].dataType) for k in self.keys)
        return F.pmod(F.xxhash64(*key), F.lit(self.buckets)).cast("int")

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """The table's present rows, or those of some buckets only."""
        wanted = None if buckets is None else set(buckets)
        folders = [
            f"{self.path}/data/run={run}/{BUCKET}={bucket}"
            for bucket, (run, filled) in sorted(self.present().items())
            if filled and (wanted is None or bucket in wanted)
        ]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def present(self) -> dict[int, tuple[int, bool]]:
        """For every bucket the run that wrote its present rows, and whether there are any; a row a bucket."""
        index = _read(self.spark, f"{self.path}/index", _INDEX)
        newest = index.groupBy(BUCKET).agg(F.max_by(F.struct("run", "filled"), "run").alias("last"))
        return {r[BUCKET]: (r["last"]["run"], r["last"]["filled"]) for r in newest.where(F.col(BUCKET).isNotNull()).collect()}

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets that changes fall into; the driver sees at most all buckets' numbers."""
        return sorted(r[0] for r in changes.select(self.bucket()).distinct().collect())

    def merge(self, changes: DataFrame, run: int | None = None) -> list[int]:
        """Puts changes in by key, one for each, and returns the buckets that were written anew.

        With a delete flag (net changes) flagged keys go, without one (pulled rows) all are put in. A run that is repeated
        under its number does nothing once it is in the index. ``changes`` is read twice: for its buckets, then for its rows.
        """
        last = self._last_run()
        number = last + 1 if run is None else run
        if number <= last:
            return []
        keyed = changes.withColumns({k: F.col(quote(k)).cast(self.schema[k].dataType) for k in self.keys})
        touched = self.touched(keyed)
        if touched:
            old, put_in = self.rows(touched), apply_changes if IS_DELETED in changes.columns else upsert
            written = self._write(put_in(old, keyed, self.keys), number)
        else:
            written = []
        self._index(number, touched, written)
        return touched

    def vacuum(self) -> list[str]:
        """Removes folders of buckets that later runs have replaced, and names them; no reader may still be at work on them."""
        present = {(run, bucket) for bucket, (run, _) in self.present().items()}
        index = _read(self.spark, f"{self.path}/index", _INDEX)
        old = [r for r in index.where("filled").collect() if (r["run"], r[BUCKET]) not in present]
        folders = [f"{self.path}/data/run={r['run']}/{BUCKET}={r[BUCKET]}" for r in old]
        return [f for f in folders if remove(self.spark, f)]

    def _write(self, rows: DataFrame, run: int) -> list[int]:
        """Writes rows under a run's number; the buckets that have any. A large bucket is written by several tasks."""
        folder = f"{self.path}/data/run={run}"
        write_parquet(rows.withColumn(BUCKET, self.bucket()), folder, [BUCKET])
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        listed = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        names = [s.getPath().getName() for s in listed]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}="))

    def _index(self, run: int, touched: list[int], filled: list[int], mode: str = "append") -> None:
        rows = [(run, b, b in set(filled)) for b in touched] or [(run, None, False)]
        self.spark.createDataFrame(rows, _INDEX).coalesce(1).write.mode(mode).json(f"{self.path}/index")

    def _last_run(self) -> int:
        return _read(self.spark, f"{self.path}/index", _INDEX).agg(F.max("run")).first()[0]


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
