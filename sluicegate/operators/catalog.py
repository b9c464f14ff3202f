"""Catalog listings: tables, columns and constraints out of a snapshot of catalog views.

A snapshot is a set of DataFrames, so a listing is a few joins and one aggregation however many tables
there are. Constraints are reduced to one row per column before they are joined, so a column with many
constraints is still listed once. Nothing is forced into a broadcast: a catalog's size is not known.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions import text
from ..functions.types import base_type_col, default_unwrap_col, field_length_col
from .filters import keep_listed

TABLE = ["schema", "table"]
COLUMN = ["schema", "table", "column"]

# Object kinds that can be read, and constraint types.
READABLE_KINDS = ("U", "V")
PRIMARY_KEY, UNIQUE, FOREIGN_KEY, CHECK = "PRIMARY KEY", "UNIQUE", "FOREIGN KEY", "CHECK"


@dataclass(frozen=True)
class Snapshot:
    """Catalog views at one moment.

    tables(catalog, schema, table, type), objects(schema, table, kind, is_system),
    cdc_tables(schema, table, is_tracked),
    columns(schema, table, column, ordinal, data_type, nullable, precision, scale, char_length,
    default, is_identity), indexes(schema, table, index_id, index_name, is_primary),
    index_columns(schema, table, index_id, ordinal), constraints(schema, table, constraint, type),
    key_usage(schema, table, constraint, column, ordinal),
    references(schema, constraint, ref_schema, ref_constraint)
    """

    tables: DataFrame
    objects: DataFrame
    cdc_tables: DataFrame
    columns: DataFrame
    indexes: DataFrame
    index_columns: DataFrame
    constraints: DataFrame
    key_usage: DataFrame
    references: DataFrame

    def readable(self) -> DataFrame:
        """User tables and views that the server does not ship itself."""
        return self.objects.where(F.col("kind").isin(*READABLE_KINDS) & ~F.col("is_system")).select(*TABLE)


def _listed(df: DataFrame, whitelist: DataFrame | None) -> DataFrame:
    return df if whitelist is None else keep_listed(df, whitelist, TABLE)


def _tables(snapshot: Snapshot, whitelist: DataFrame | None) -> DataFrame:
    tables = _listed(snapshot.tables, whitelist).join(snapshot.readable(), TABLE)
    flagged = tables.join(snapshot.cdc_tables, TABLE, "left")
    return flagged.select("catalog", *TABLE, "type", F.coalesce(F.col("is_tracked"), F.lit(False)).alias("cdc_enabled"))


def list_tables(snapshot: Snapshot, whitelist: DataFrame | None = None) -> DataFrame:
    """Readable tables with type and change-capture flag; no column is looked at."""
    return _tables(snapshot, whitelist).orderBy(*TABLE)


def _columns(snapshot: Snapshot) -> DataFrame:
    keys = (
        snapshot.indexes.where("is_primary")
        .join(snapshot.index_columns, [*TABLE, "index_id"])
        .groupBy(*TABLE, "ordinal")
        .agg(F.min("index_name").alias("pk_name"))
    )
    columns = snapshot.columns.join(snapshot.readable(), TABLE, "left_semi").join(keys, [*TABLE, "ordinal"], "left")
    return columns.select(
        *COLUMN, "ordinal", "data_type", "nullable", "precision", "scale", "char_length", "is_identity", "pk_name"
    )


def list_columns(snapshot: Snapshot) -> DataFrame:
    """All columns of all readable tables, with the primary key found by index."""
    return _columns(snapshot).orderBy(*TABLE, "ordinal")


def column_constraints(snapshot: Snapshot, whitelist: DataFrame | None = None) -> DataFrame:
    """One row per constrained column: names of its key constraints, its check, its first reference."""
    usage = _listed(snapshot.key_usage, whitelist)
    keys = snapshot.constraints.where(F.col("type").isin(PRIMARY_KEY, UNIQUE, CHECK))
    keyed = usage.join(keys, [*TABLE, "constraint"]).select(*COLUMN, "type", "constraint")
    target = snapshot.key_usage.select(
        F.col("schema").alias("ref_schema"),
        F.col("constraint").alias("ref_constraint"),
        F.col("table").alias("ref_table"),
        F.col("column").alias("ref_column"),
        "ordinal",
    )
    linked = (
        usage.join(snapshot.references, ["schema", "constraint"])
        .join(target, ["ref_schema", "ref_constraint", "ordinal"])
        .select(*COLUMN, F.lit(FOREIGN_KEY).alias("type"), "constraint", "ref_schema", "ref_table", "ref_column")
    )

    def named(kind: str):
        return F.min(F.when(F.col("type") == kind, F.col("constraint")))

    reference = F.when(
        F.col("type") == FOREIGN_KEY, F.struct(F.col("constraint").alias("name"), "ref_schema", "ref_table", "ref_column")
    )
    per_column = keyed.unionByName(linked, allowMissingColumns=True).groupBy(*COLUMN).agg(
        named(PRIMARY_KEY).alias("pk_name"),
        named(UNIQUE).alias("uk_name"),
        named(CHECK).alias("chk_name"),
        F.min(reference).alias("fk"),
    )
    return per_column.select(
        *COLUMN, "pk_name", "uk_name", "chk_name", F.col("fk.name").alias("fk_name"),
        "fk.ref_schema", "fk.ref_table", "fk.ref_column",
    )


def list_columns_with_constraints(snapshot: Snapshot, whitelist: DataFrame | None = None) -> DataFrame:
    """Columns of the listed tables with everything their constraints say, once each."""
    columns = _listed(snapshot.columns, whitelist)
    joined = columns.join(column_constraints(snapshot, whitelist), COLUMN, "left")
    return joined.select(
        *columns.columns, "pk_name", "uk_name", "chk_name", "fk_name", "ref_schema", "ref_table", "ref_column"
    ).orderBy(*TABLE, "ordinal")


def profile(columns: DataFrame) -> DataFrame:
    """Column listing as typed profile rows: base type, length, default, keys, identity."""
    has = set(columns.columns)
    kind = F.coalesce(F.col("data_type"), F.lit("USER_DEFINED_TYPE"))

    def present(name: str):
        return F.col(name).isNotNull() if name in has else F.lit(False)

    def value(name: str):
        return F.col(name) if name in has else F.lit(None).cast("string")

    return columns.select(
        *COLUMN,
        "ordinal",
        text.sanitize(F.col("column")).alias("sanitized_name"),
        kind.alias("type"),
        base_type_col(kind).alias("base_type"),
        F.when(
            F.col("data_type").isNotNull(),
            field_length_col(F.col("data_type"), F.col("precision"), F.col("scale"), F.col("char_length")),
        ).alias("length"),
        F.col("nullable"),
        default_unwrap_col(kind, value("default")).alias("default"),
        present("pk_name").alias("primary_key"),
        present("uk_name").alias("unique_key"),
        value("fk_name").alias("fk_name"),
        value("ref_schema").alias("ref_schema"),
        value("ref_table").alias("ref_table"),
        value("ref_column").alias("ref_column"),
        F.coalesce(F.col("is_identity"), F.lit(False)).alias("auto_increment"),
    )


def nested(snapshot: Snapshot, whitelist: DataFrame | None = None) -> DataFrame:
    """One row per readable table with its columns as a JSON array in table order.

    The array holds one entry per column of a table, which a server limits (to 1,024, or 30,000 for
    wide tables), so a group cannot grow with the data.
    """
    entry = F.struct(
        "ordinal",
        F.col("column").alias("name"),
        F.coalesce(F.col("data_type"), F.lit("USER_DEFINED_TYPE")).alias("type"),
        F.col("pk_name").isNotNull().alias("primaryKey"),
    )
    arrays = _listed(_columns(snapshot), whitelist).groupBy(*TABLE).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    shown = F.transform("entries", lambda e: e.dropFields("ordinal"))
    listing = _tables(snapshot, whitelist).join(arrays, TABLE, "left").orderBy(*TABLE)
    return listing.select(*TABLE, "cdc_enabled", F.to_json(shown).alias("columns"))
