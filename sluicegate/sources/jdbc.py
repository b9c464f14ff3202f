"""JDBC reads: options, splits of a table into parallel reads, and catalog views.

Only options and text are made here; Spark's own JDBC source reads. Nothing here has been run against
a database.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..functions.types import SOURCE_TYPE, quote
from ..operators.catalog import Snapshot
from ..operators.cdc import ChangeLog

FETCH_ROWS = "50000"

# Fixed value: statement that makes a session read uncommitted rows.
READ_UNCOMMITTED = "SET TRANSACTION ISOLATION LEVEL READ UNCOMMITTED"


def sql_name(*parts: str | None) -> str:
    """Identifier in standard quotes."""
    return ".".join('"' + p.replace('"', '""') + '"' for p in parts if p)


def read_options(base: dict[str, str], read_uncommitted: bool = False, timeout_s: int | None = None) -> dict[str, str]:
    options = {"fetchsize": FETCH_ROWS, "preferTimestampNTZ": "true", **base}
    if read_uncommitted:
        options["sessionInitStatement"] = READ_UNCOMMITTED
    if timeout_s:
        options["queryTimeout"] = str(timeout_s)
    return options


def load_table(spark: SparkSession, options: dict[str, str], schema: str | None, name: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).option("dbtable", sql_name(schema, name)).load()


def load_table_split(
    spark: SparkSession, options: dict[str, str], schema: str | None, name: str, column: str, splits: int
) -> DataFrame:
    """A table read in parallel by ranges of a numeric, date or time column.

    Lower and upper bound come from one query that the database answers; rows outside and NULLs
    belong to the first and the last read, so no row is lost whatever the bounds.
    """
    quoted = sql_name(column)
    bounds = f"SELECT MIN({quoted}) AS low, MAX({quoted}) AS high FROM {sql_name(schema, name)}"
    low, high = spark.read.format("jdbc").options(**options).option("query", bounds).load().collect()[0]
    if low is None:
        return load_table(spark, options, schema, name)
    return load_table(
        spark,
        {
            **options,
            "partitionColumn": quoted,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(splits),
        },
        schema,
        name,
    )


def load_table_ranges(
    spark: SparkSession, options: dict[str, str], schema: str | None, name: str, column: str, bounds: list
) -> DataFrame:
    """A table read in parallel by given ranges, for columns whose values are spread unevenly."""
    properties = {k: v for k, v in options.items() if k != "url"}
    predicates = range_predicates(column, bounds)
    return spark.read.jdbc(options["url"], sql_name(schema, name), predicates=predicates, properties=properties)


def change_log(spark: SparkSession, options: dict[str, str], schema: str, name: str, keys: list[str]) -> ChangeLog:
    """Change table of a tracked table, with commit times out of the server's position list. The log's own columns have
    names that a tracked column is not likely to have."""
    times = load_table(spark, options, "cdc", "lsn_time_mapping").select(
        F.col("start_lsn").alias("__lsn"), F.col("tran_end_time").alias("__ts")
    )
    changes = load_table(spark, options, "cdc", f"{schema}_{name}_CT")
    renamed = {"__$start_lsn": "__lsn", "__$seqval": "__seq", "__$operation": "__op"}
    payload = [c for c in changes.columns if not c.startswith("__$")]
    log = changes.select(
        *(F.col(quote(c)) for c in payload), *(F.col(quote(old)).alias(new) for old, new in renamed.items())
    ).join(times, "__lsn")
    return ChangeLog(log, keys, lsn="__lsn", op="__op", time="__ts", sequence=["__seq"], positions=times)


def catalog_settings(name: str, url: str, **options: str) -> dict[str, str]:
    """Session settings for a JDBC catalog, which hands filters, limits, top-n and aggregates of whole
    tables to the database."""
    prefix = f"spark.sql.catalog.{name}"
    pushed = ("pushDownPredicate", "pushDownAggregate", "pushDownLimit", "pushDownOffset")
    return {
        prefix: "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        f"{prefix}.url": url,
        **{f"{prefix}.{option}": "true" for option in pushed},
        **{f"{prefix}.{key}": value for key, value in options.items()},
    }


def split_bounds(df: DataFrame, column: str, splits: int, accuracy: int = 10_000) -> Row:
    """``splits - 1`` inner bounds between ranges of about equal size, on the driver."""
    points = [i / splits for i in range(1, splits)]
    return df.agg(F.percentile_approx(F.col(quote(column)), points, accuracy).alias("bounds")).collect()[0]["bounds"]


def even_bounds(low: int, high: int, splits: int) -> list[int]:
    """Inner bounds of ``splits`` ranges of equal width."""
    return [low + (high - low) * i // splits for i in range(1, splits)]


def range_of(column: str, bounds: list) -> Column:
    """Number of the range a value falls into: how many bounds lie below it. NULLs are in range 0."""
    value = F.col(quote(column))
    number = F.lit(0)
    for bound in sorted(set(bounds)):
        number = number + F.when(value > F.lit(bound), 1).otherwise(0)
    return number


def range_predicates(column: str, bounds: list) -> list[str]:
    """WHERE texts for a parallel JDBC read; together they take every row once."""
    name, cuts = sql_name(column), sorted(set(bounds))
    if not cuts:
        return ["1 = 1"]
    inner = [f"{name} > {a} AND {name} <= {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{name} <= {cuts[0]} OR {name} IS NULL", *inner, f"{name} > {cuts[-1]}"]


# Catalog views by the part of a snapshot they fill. Each is a plain list of columns; all joins are
# made in Spark.
CATALOG_QUERIES = {
    "tables": "SELECT TABLE_CATALOG AS catalog, TABLE_SCHEMA AS [schema], TABLE_NAME AS [table], TABLE_TYPE AS type "
    "FROM INFORMATION_SCHEMA.TABLES",
    "objects": "SELECT SCHEMA_NAME(schema_id) AS [schema], name AS [table], RTRIM(type) AS kind, "
    "is_ms_shipped AS is_system FROM sys.objects",
    "cdc_tables": "SELECT SCHEMA_NAME(schema_id) AS [schema], name AS [table], is_tracked_by_cdc AS is_tracked "
    "FROM sys.tables",
    "columns": "SELECT OBJECT_SCHEMA_NAME(object_id) AS [schema], OBJECT_NAME(object_id) AS [table], "
    "name AS [column], column_id AS ordinal, TYPE_NAME(system_type_id) AS data_type, is_nullable AS nullable, "
    "CAST(precision AS int) AS precision, CAST(scale AS int) AS scale, CAST(max_length AS int) AS char_length, "
    "OBJECT_DEFINITION(default_object_id) AS [default], is_identity FROM sys.columns",
    "indexes": "SELECT OBJECT_SCHEMA_NAME(object_id) AS [schema], OBJECT_NAME(object_id) AS [table], index_id, "
    "name AS index_name, is_primary_key AS is_primary FROM sys.indexes",
    "index_columns": "SELECT OBJECT_SCHEMA_NAME(object_id) AS [schema], OBJECT_NAME(object_id) AS [table], index_id, "
    "column_id AS ordinal FROM sys.index_columns",
    "constraints": "SELECT TABLE_SCHEMA AS [schema], TABLE_NAME AS [table], CONSTRAINT_NAME AS [constraint], "
    "CONSTRAINT_TYPE AS type FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS",
    "key_usage": "SELECT u.TABLE_SCHEMA AS [schema], u.TABLE_NAME AS [table], u.CONSTRAINT_NAME AS [constraint], "
    "u.COLUMN_NAME AS [column], u.ORDINAL_POSITION AS ordinal FROM INFORMATION_SCHEMA.KEY_COLUMN_USAGE u UNION ALL "
    "SELECT c.TABLE_SCHEMA, c.TABLE_NAME, c.CONSTRAINT_NAME, c.COLUMN_NAME, 0 "
    "FROM INFORMATION_SCHEMA.CONSTRAINT_COLUMN_USAGE c WHERE EXISTS (SELECT 1 FROM "
    "INFORMATION_SCHEMA.CHECK_CONSTRAINTS k WHERE k.CONSTRAINT_SCHEMA = c.CONSTRAINT_SCHEMA "
    "AND k.CONSTRAINT_NAME = c.CONSTRAINT_NAME)",
    "references": "SELECT CONSTRAINT_SCHEMA AS [schema], CONSTRAINT_NAME AS [constraint], "
    "UNIQUE_CONSTRAINT_SCHEMA AS ref_schema, UNIQUE_CONSTRAINT_NAME AS ref_constraint "
    "FROM INFORMATION_SCHEMA.REFERENTIAL_CONSTRAINTS",
}


def catalog_snapshot(spark: SparkSession, options: dict[str, str]) -> Snapshot:
    """The catalog of a database as DataFrames."""
    reader = spark.read.format("jdbc").options(**options)
    return Snapshot(**{part: reader.option("query", sql).load() for part, sql in CATALOG_QUERIES.items()})


def with_catalog_types(df: DataFrame, listing: list[Row]) -> DataFrame:
    """``df`` whose fields carry what one table's column profile says: type names, NULLs, defaults."""
    known = {row["column"]: row for row in listing}
    shown = []
    for field in df.schema.fields:
        row = known.get(field.name)
        metadata = dict(field.metadata or {})
        if row is not None:
            metadata.update({SOURCE_TYPE: row["type"], **{k: row[k] for k in ("nullable", "default", "unique_key", "ordinal")}})
        kept = {k: v for k, v in metadata.items() if v is not None}
        shown.append(F.col(quote(field.name)).alias(field.name, metadata=kept))
    return df.select(*shown)
