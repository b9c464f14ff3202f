"""Delimited files read back, with their record shapes checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.checks import BAD_RECORD, CSV_READ_OPTIONS, record_schema


def read_records(spark: SparkSession, path: str, n_fields: int) -> DataFrame:
    """Records as texts ``c1`` to ``cn`` and the raw text of a record of another shape.

    A record may span lines, so a file is read by one task; exports bound their files' size, which
    keeps such reads parallel. A bare empty field is NULL and a quoted one is ''.
    """
    return (
        spark.read.options(**CSV_READ_OPTIONS)
        .option("multiLine", "true")
        .option("columnPruning", "false")
        .schema(record_schema(n_fields))
        .csv(path)
    )


def misshapen_records(spark: SparkSession, path: str, n_fields: int) -> DataFrame:
    """Records without ``n_fields`` fields: their file, their number in it and their text.

    A file's records get rising ids within one task, so the distance to the file's lowest id is the
    record's number.
    """
    # Spark wants a parsed field beside the raw record, hence the look at the first one.
    parsed = F.length(F.coalesce("c1", F.lit(""))) >= 0
    numbered = read_records(spark, path, n_fields).select(
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("__id"),
        F.when(parsed, F.col(BAD_RECORD)).alias("record"),
    )
    first = numbered.groupBy("file").agg(F.min("__id").alias("__first"))
    bad = numbered.where(F.col("record").isNotNull()).join(first, "file")
    return bad.select("file", (F.col("__id") - F.col("__first") + 1).alias("number"), "record")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the byte range they begin in, a number that rises in it, and whether their number of quotes is odd."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line_id"), "value", (quotes % 2).cast("int").alias("odd"),
    )


def _text(order: str) -> Column:
    """The texts of a group in their order, with line ends between them."""
    parts = F.array_sort(F.collect_list(F.struct(order, "value")))
    return F.array_join(F.transform(parts, lambda part: part["value"]), "\n")


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of delimited files as ``file``, ``number`` (from 1 in each file) and ``record``, their raw text.

    A file is read by as many tasks as it has byte ranges, although quoted fields may hold line ends: a line begins a record
    if an even number of quotes comes before it in its file. First every range counts its quotes, and a running sum over
    the ranges of a file, a row each, tells whether a range begins inside quotes. Then lines move once, by range, and are
    put together to records there. Only records that cross ranges, two pieces at most of each range, are joined after that.

    Lines that are empty outside of quotes are no records. A record that never ends holds the rest of its file. Empty
    files: no rows. Ranges are as large as ``spark.sql.files.maxPartitionBytes`` allows.
    """
    lines = _lines(spark, path)
    of_file = Window.partitionBy("file").orderBy("range")
    earlier, so_far = (of_file.rowsBetween(Window.unboundedPreceding, end) for end in (-1, 0))
    ranges = lines.groupBy("file", "range").agg(F.sum("odd").alias("odd"))
    opened = ranges.select("file", "range", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).cast("int").alias("open"))

    in_range = Window.partitionBy("file", "range").orderBy("line_id")
    odd_before = F.coalesce(F.sum("odd").over(in_range.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    placed = lines.withColumn("odd_before", odd_before.cast("int")).join(opened, ["file", "range"])
    begins = F.col("odd_before") == F.col("open")
    own = F.sum(begins.cast("long")).over(in_range.rowsBetween(Window.unboundedPreceding, 0))
    counted = placed.where(~begins | (F.col("value") != "")).withColumn("own", own)
    pieces = counted.groupBy("file", "range", "own").agg(_text("line_id").alias("value"), (F.sum("odd") % 2).alias("odd"))

    # a range's records are numbered after those that begin in the ranges before it
    begun = pieces.groupBy("file", "range").agg(F.max("own").alias("begun"))
    first = begun.select("file", "range", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(first, ["file", "range"])
    number = F.col("before") + F.col("own")
    whole = numbered.where((F.col("own") > 0) & (F.col("odd") == 0)).select("file", number.alias("number"), "value")
    crossing = numbered.where((F.col("own") == 0) | (F.col("odd") == 1))
    # a piece that continues a record has the number of the last record begun before its range, which is ``before``
    joined = crossing.select("file", "range", number.alias("number"), "value").groupBy("file", "number").agg(_text("range").alias("value"))
    return whole.unionByName(joined).withColumnRenamed("value", "record")


def parsed_records(spark: SparkSession, path: str, n_fields: int) -> DataFrame:
    """``split_records`` with the fields ``c1`` to ``cn`` of each, read as ``read_records`` reads them, and ``misshapen``, whether
    there are more or fewer."""
    fields = F.from_csv("record", record_schema(n_fields).simpleString(), CSV_READ_OPTIONS)
    parsed = split_records(spark, path).withColumn("__fields", fields)
    shown = [F.col("__fields").getField(f"c{i}").alias(f"c{i}") for i in range(1, n_fields + 1)]
    return parsed.select("file", "number", *shown, F.col("__fields").getField(BAD_RECORD).isNotNull().alias("misshapen"), "record")
