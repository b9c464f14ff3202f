"""Where tables come from: parquet folders, session catalogs, databases over JDBC.

All sources answer the same calls with lazy DataFrames, so a job is planned in the same way over each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from ..errors import JobError
from ..functions.types import quote
from ..operators import catalog, incremental
from ..operators.cdc import ChangeLog
from ..operators.project import select_columns
from . import jdbc, zones as file_zones


@dataclass
class FolderSource:
    """Files named ``<table>.<format>`` in one folder, or in ``<schema>/`` below it.

    A listed set of files does not change while it is read, so the highest watermark of what was
    written is the state (``live`` is False). With ``zone_maps``, pulls of parquet tables open only files
    that can hold new rows.
    """

    spark: SparkSession
    root: str
    format: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    with_schema: bool = False
    live: bool = False
    zone_maps: bool = False

    def _path(self, schema: str | None, name: str) -> str:
        folder = f"{self.root}/{schema}" if self.with_schema and schema else self.root
        return f"{folder}/{name}.{self.format}"

    def table(self, schema: str | None, name: str, **_) -> DataFrame:
        return self.spark.read.format(self.format).options(**self.options).load(self._path(schema, name))

    def since(self, table: DataFrame, schema: str | None, name: str, column: str, state: str | None, zones: str) -> DataFrame:
        """Rows of ``table`` at or after a state; the map of its files is kept in ``zones``."""
        if not self.zone_maps or self.format != "parquet" or state is None:
            return incremental.since(table, column, state)
        return file_zones.since(self.spark, table, self._path(schema, name), column, state, zones)

    def query(self, sql: str, **_) -> DataFrame:
        return run_query(self.spark, sql)

    def about(self, schema: str | None, name: str) -> dict:
        return {"name": name, "schema": schema}

    def changes(self, schema: str | None, name: str, keys: list[str]) -> ChangeLog:
        return ChangeLog(self.table(schema, f"{name}_changes"), keys)


@dataclass
class CatalogSource:
    """Tables and views of a catalog, the session's own by default; change logs end in ``_changes``.

    With the catalog of ``jdbc.catalog_settings`` and ``live`` set, limits and highest watermarks are
    worked out by the database.
    """

    spark: SparkSession
    catalog: str | None = None
    live: bool = False

    def _name(self, schema: str | None, name: str) -> str:
        return ".".join(quote(p) for p in (self.catalog, schema, name) if p)

    def table(self, schema: str | None, name: str, **_) -> DataFrame:
        return self.spark.table(self._name(schema, name))

    def query(self, sql: str, **_) -> DataFrame:
        return run_query(self.spark, sql)

    def about(self, schema: str | None, name: str) -> dict:
        kind = self.spark.catalog.getTable(self._name(schema, name)).tableType
        return {"name": name, "schema": schema, "type": "VIEW" if kind in ("VIEW", "TEMPORARY") else "BASE TABLE"}

    def changes(self, schema: str | None, name: str, keys: list[str]) -> ChangeLog:
        return ChangeLog(self.spark.table(self._name(schema, f"{name}_changes")), keys)


@dataclass
class JdbcSource:
    """A database. It goes on changing while it is read, so the state is taken before the scan.

    ``splits`` names, by table, the column and the number of ranges a table is read in; a table that is
    not named is read by one task. Type names and keys come from the database's own catalog.
    """

    spark: SparkSession
    options: dict[str, str]
    splits: dict[str, tuple[str, int]] = field(default_factory=dict)
    live: bool = True
    _snapshot: catalog.Snapshot | None = None
    _profiles: dict = field(default_factory=dict)

    @property
    def snapshot(self) -> catalog.Snapshot:
        if self._snapshot is None:
            self._snapshot = jdbc.catalog_snapshot(self.spark, self.options)
        return self._snapshot

    def _only(self, schema: str | None, name: str) -> DataFrame:
        return self.spark.createDataFrame([(schema, name)], "schema string, table string")

    def _profile(self, schema: str | None, name: str) -> list[Row]:
        """Column profile of one table; it is asked for once per job."""
        if (schema, name) not in self._profiles:
            columns = catalog.list_columns_with_constraints(self.snapshot, self._only(schema, name))
            self._profiles[schema, name] = catalog.profile(columns).collect()
        return self._profiles[schema, name]

    def about(self, schema: str | None, name: str) -> dict:
        row = catalog.list_tables(self.snapshot, self._only(schema, name)).first()
        known = {"catalog": row["catalog"], "type": row["type"]} if row else {}
        return {"name": name, "schema": schema, **known}

    def table(self, schema: str | None, name: str, read_uncommitted: bool = False, timeout_s: int | None = None):
        options = jdbc.read_options(self.options, read_uncommitted, timeout_s)
        if name in self.splits:
            df = jdbc.load_table_split(self.spark, options, schema, name, *self.splits[name])
        else:
            df = jdbc.load_table(self.spark, options, schema, name)
        return jdbc.with_catalog_types(df, self._profile(schema, name))

    def query(self, sql: str, timeout_s: int | None = None, **_) -> DataFrame:
        options = jdbc.read_options(self.options, False, timeout_s)
        return self.spark.read.format("jdbc").options(**options).option("query", sql).load()

    def changes(self, schema: str | None, name: str, keys: list[str]) -> ChangeLog:
        return jdbc.change_log(self.spark, self.options, schema, name, keys)


def scan(source, schema: str | None, name: str, columns: list[str] | None = None, **options) -> DataFrame:
    """A table or view, with the columns asked for in that order."""
    return select_columns(source.table(schema, name, **options), columns)


def register_views(spark: SparkSession, folder: str, names: list[str], format: str = "parquet") -> None:
    """Temporary views over the files of a folder, under the files' names."""
    for name in names:
        spark.read.format(format).load(f"{folder}/{name}.{format}").createOrReplaceTempView(name)


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """A user's own query, as it is."""
    return spark.sql(sql.strip().rstrip(";"))


def describe_query(spark: SparkSession, sql: str) -> list[tuple[str, str]]:
    """Names and types of a query's columns, from its plan; no row is read."""
    return [(f.name, f.dataType.simpleString()) for f in with_distinct_names(run_query(spark, sql)).schema.fields]


def with_distinct_names(df: DataFrame) -> DataFrame:
    """``df``, once its columns are known to have names that tell them apart."""
    names = df.columns
    if "" in names or len({n.lower() for n in names}) < len(names):
        raise JobError(f"The query's columns need distinct names: {names}")
    return df
