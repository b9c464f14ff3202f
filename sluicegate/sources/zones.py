"""A zone map of a table's files: the lowest and highest watermark in each, so that a pull opens only files with new rows.

Parquet folders only. The map is a small table beside the state, a row a file. A file is measured once, by its watermark
column alone, and again if it is replaced by one of another size or time under its name.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.types import quote
from ..operators.incremental import highest, state_literal, watermark_field

_SAME = ["file", "size", "modified"]


def files_of(spark: SparkSession, folder: str) -> DataFrame:
    """Data files of a table, which is a folder or one file: how to load each, its name in scans, its size and its time."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    about = F.col("_metadata")
    return listed.select(
        "path", about["file_path"].alias("file"), about["file_size"].alias("size"), about["file_modification_time"].alias("modified")
    )


def _load(spark: SparkSession, table: DataFrame, folder: str, paths: list[str]) -> DataFrame:
    """Some files of a table, with all of its columns, those of its folders' names included."""
    if not paths:
        return table.limit(0)
    reader, store_path = spark.read.schema(table.schema), spark._jvm.org.apache.hadoop.fs.Path
    is_file = len(paths) == 1 and store_path(paths[0]).toUri().getPath() == store_path(folder).toUri().getPath()
    return (reader if is_file else reader.option("basePath", folder)).parquet(*paths)


def measured(rows: DataFrame, column: str) -> DataFrame:
    """Rows, NULL watermarks, lowest and highest watermark of every file that ``rows`` are read from; one partial row a task and
    file moves."""
    field = watermark_field(rows, column)
    value = F.col(quote(column))
    low = F.min(F.when(~F.isnan(value), value) if field.dataType.typeName() in ("double", "float") else value)
    return rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(value.isNull(), 1)).alias("nulls"), low.alias("low"), highest(field).alias("high")
    )


def read_zones(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def refresh(spark: SparkSession, table: DataFrame, folder: str, column: str, zones: str) -> DataFrame:
    """The zones of a table's present files: known ones as they are stored in ``zones``, new ones measured and added there.

    The driver sees the names of the new files. A table without files: no rows.
    """
    present, known = files_of(spark, folder), read_zones(spark, zones)
    if known is not None and known.schema["high"].dataType != table.schema[column].dataType:
        known = None  # the column has got another type
    new = present if known is None else present.join(known.select(*_SAME), _SAME, "left_anti")
    paths = sorted(r["path"] for r in new.select("path").collect())
    if paths:
        rows = _load(spark, table, folder, paths).select("*", "_metadata")
        found = new.drop("path").join(measured(rows, column), "file", "left")
        mode = "append" if known is not None else "overwrite"
        found.coalesce(1).write.mode(mode).parquet(zones)
    stored = read_zones(spark, zones)
    if stored is None:
        nothing = table.limit(0).select(F.col(quote(column)).alias("low"), F.col(quote(column)).alias("high"))
        stored = nothing.selectExpr("'' AS file", "0L AS size", "timestamp '1970-01-01' AS modified", "0L AS rows", "0L AS nulls", "low", "high")
    return present.join(stored.dropDuplicates(_SAME), _SAME)


def since(spark: SparkSession, table: DataFrame, folder: str, column: str, state: str, zones: str) -> DataFrame:
    """Rows at or after the state, read from those files only that hold such."""
    field = watermark_field(table, column)
    found = refresh(spark, table, folder, column, zones).where(F.col("high") >= state_literal(field, state))
    paths = sorted(r["path"] for r in found.select("path").collect())
    return _load(spark, table, folder, paths).where(F.col(quote(column)) >= state_literal(field, state))
