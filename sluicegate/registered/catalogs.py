"""Catalog listings over a snapshot that Spark derives from the tables: every order stands for a
table, and its line numbers for that table's columns."""

from pyspark.sql import functions as F

from ..operators import catalog
from ..sinks.manifest import manifest_rows as manifest_entries
from .base import registered, table
from .projections import sql_type_name, type_name


def _schema(key):
    return F.concat(F.lit("s"), (key % 7).cast("string"))


def _table(key):
    return F.concat(F.lit("order "), key.cast("string"))


def snapshot(spark, sf_dir) -> catalog.Snapshot:
    orders = table(spark, sf_dir, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    named = [_schema(key).alias("schema"), _table(key).alias("table")]
    is_view = status == "P"
    tables = orders.select(
        F.lit("shop").alias("catalog"), *named, F.when(is_view, "VIEW").otherwise("BASE TABLE").alias("type")
    )
    objects = orders.select(
        *named, F.when(is_view, "V").otherwise("U").alias("kind"), (F.col("o_totalprice") > 450000).alias("is_system")
    )
    tracked = orders.where(~is_view).select(*named, (F.col("o_custkey") % 2 == 0).alias("is_tracked"))

    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey", "l_linenumber")
        .agg(
            F.min("l_partkey").alias("part"),
            F.max("l_suppkey").alias("supplier"),
            F.max("l_quantity").cast("int").alias("quantity"),
        )
    )
    order, number = F.col("l_orderkey"), F.col("l_linenumber")
    owned = [_schema(order).alias("schema"), _table(order).alias("table")]
    column = F.concat(F.lit("_line%d "), number.cast("string"))
    quantity = F.col("quantity")
    columns = lines.select(
        *owned,
        column.alias("column"),
        number.alias("ordinal"),
        F.when(quantity < 49, type_name(F.col("part"))).alias("data_type"),
        (quantity > 10).alias("nullable"),
        F.when(quantity > 25, F.lit(18)).otherwise(0).alias("precision"),
        F.when(quantity > 35, F.lit(4)).otherwise(0).alias("scale"),
        quantity.alias("char_length"),
        F.when(quantity > 40, F.concat(F.lit("(("), quantity.cast("string"), F.lit("))"))).alias("default"),
        ((number == 1) & (quantity > 20)).alias("is_identity"),
    )
    index_columns = lines.where(number <= 2).select(*owned, number.alias("index_id"), number.alias("ordinal"))
    indexes = lines.where(number <= 2).select(
        *owned,
        number.alias("index_id"),
        F.concat(F.lit("ix_"), order.cast("string"), F.lit("_"), number.cast("string")).alias("index_name"),
        (number == 1).alias("is_primary"),
    )
    def kind(prefix: str, name: str, condition):
        return F.when(condition, F.struct(F.lit(prefix).alias("p"), F.lit(name).alias("type")))

    kinds = F.array(
        kind("pk", catalog.PRIMARY_KEY, number == 1),
        kind("uk", catalog.UNIQUE, quantity > 30),
        kind("uz", catalog.UNIQUE, quantity > 40),
        kind("fk", catalog.FOREIGN_KEY, number == 2),
        kind("ck", catalog.CHECK, quantity > 45),
    )
    constrained = lines.select(
        "*", F.explode(F.filter(kinds, lambda k: k.isNotNull())).alias("k")
    ).withColumn("constraint", F.concat_ws("_", "k.p", order.cast("string"), number.cast("string")))
    constraints = constrained.select(*owned, "constraint", F.col("k.type").alias("type"))
    key_usage = constrained.select(*owned, "constraint", column.alias("column"), F.lit(1).alias("ordinal"))
    target = F.col("supplier")
    references = constrained.where(F.col("k.p") == "fk").select(
        _schema(order).alias("schema"),
        "constraint",
        _schema(target).alias("ref_schema"),
        F.concat(F.lit("pk_"), target.cast("string"), F.lit("_1")).alias("ref_constraint"),
    )
    return catalog.Snapshot(
        tables, objects, tracked, columns, indexes, index_columns, constraints, key_usage, references
    )


SQL_SNAPSHOT = f"""
readable AS (SELECT o_orderkey AS k, 's' || (o_orderkey % 7) AS "schema", 'order ' || o_orderkey AS "table",
                    o_orderstatus AS status, o_custkey FROM orders WHERE NOT o_totalprice > 450000),
lines AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS part, max(l_suppkey) AS supplier,
                 CAST(max(l_quantity) AS INTEGER) AS q FROM lineitem GROUP BY ALL),
cols AS (SELECT k, n, supplier, q, 's' || (k % 7) AS "schema", 'order ' || k AS "table", '_line%d ' || n AS "column",
                CASE WHEN q < 49 THEN {sql_type_name('part')} END AS data_type, q > 10 AS nullable,
                CASE WHEN q > 25 THEN 18 ELSE 0 END AS "precision", CASE WHEN q > 35 THEN 4 ELSE 0 END AS scale,
                q AS char_length, CASE WHEN q > 40 THEN '((' || q || '))' END AS "default",
                (n = 1 AND q > 20) AS is_identity FROM lines),
full_cols AS (
  SELECT c.k, c.n, c."schema", c."table", c."column", c.n AS ordinal, c.data_type, c.nullable, c."precision", c.scale,
         c.char_length, c."default", c.is_identity,
         CASE WHEN c.n = 1 THEN 'pk_' || c.k || '_' || c.n END AS pk_name,
         CASE WHEN c.q > 30 THEN 'uk_' || c.k || '_' || c.n END AS uk_name,
         CASE WHEN c.q > 45 THEN 'ck_' || c.k || '_' || c.n END AS chk_name,
         CASE WHEN c.n = 2 AND t.k IS NOT NULL THEN 'fk_' || c.k || '_' || c.n END AS fk_name,
         CASE WHEN c.n = 2 AND t.k IS NOT NULL THEN 's' || (c.supplier % 7) END AS ref_schema,
         CASE WHEN c.n = 2 AND t.k IS NOT NULL THEN 'order ' || c.supplier END AS ref_table,
         CASE WHEN c.n = 2 AND t.k IS NOT NULL THEN '_line%d 1' END AS ref_column
  FROM cols c LEFT JOIN (SELECT k FROM lines WHERE n = 1) t ON t.k = c.supplier
  WHERE c.k IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'))"""


def listed(spark, sf_dir):
    key = F.col("o_orderkey")
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '2-HIGH'")
    return urgent.select(_schema(key).alias("schema"), _table(key).alias("table"))


@registered(f"""
WITH {SQL_SNAPSHOT}
SELECT 'shop' AS catalog, "schema", "table", CASE WHEN status = 'P' THEN 'VIEW' ELSE 'BASE TABLE' END AS type,
       (status <> 'P' AND o_custkey % 2 = 0) AS cdc_enabled FROM readable
""")
def catalog_tables(spark, sf_dir):
    return catalog.list_tables(snapshot(spark, sf_dir))


@registered(f"""
WITH {SQL_SNAPSHOT}
SELECT "schema", "table", "column", n AS ordinal, data_type, nullable, "precision", scale, char_length, is_identity,
       CASE WHEN n = 1 THEN 'ix_' || k || '_1' END AS pk_name
FROM cols WHERE k IN (SELECT k FROM readable)
""")
def catalog_columns(spark, sf_dir):
    return catalog.list_columns(snapshot(spark, sf_dir))


@registered(f"""
WITH {SQL_SNAPSHOT}
SELECT "schema", "table", "column", ordinal, data_type, nullable, "precision", scale, char_length, "default", is_identity,
       pk_name, uk_name, chk_name, fk_name, ref_schema, ref_table, ref_column FROM full_cols
""")
def catalog_constraints(spark, sf_dir):
    return catalog.list_columns_with_constraints(snapshot(spark, sf_dir), listed(spark, sf_dir))


SQL_PROFILE = f"""
{SQL_SNAPSHOT},
profiled AS (
  SELECT "schema", "table", "column", ordinal, 'line_d_' || n AS sanitized_name,
    coalesce(data_type, 'USER_DEFINED_TYPE') AS type,
    CASE WHEN data_type = 'date' THEN 'DATE'
         WHEN data_type IN ('datetime', 'datetime2', 'smalldatetime', 'datetimeoffset') THEN 'TIMESTAMP'
         WHEN lower(data_type) IN ('integer', 'int', 'smallint', 'tinyint', 'bigint') THEN 'INTEGER'
         WHEN lower(data_type) IN ('numeric', 'decimal', 'money', 'smallmoney') THEN 'NUMERIC'
         WHEN data_type IN ('real', 'float') THEN 'FLOAT' WHEN data_type = 'bit' THEN 'BOOLEAN' ELSE 'STRING' END AS base_type,
    CASE WHEN data_type IS NULL OR data_type IN ('datetimeoffset', 'datetime2', 'datetime', 'time', 'smalldatetime', 'date') THEN NULL
         WHEN "precision" > 0 AND scale > 0 THEN "precision" || ',' || scale
         WHEN "precision" > 0 THEN CAST("precision" AS VARCHAR)
         WHEN char_length = 16 AND data_type = 'text' THEN NULL ELSE CAST(char_length AS VARCHAR) END AS length,
    nullable,
    CASE WHEN lower(data_type) IN ('int', 'bigint', 'smallint', 'tinyint', 'decimal', 'numeric', 'float')
         THEN replace(replace("default", '((', ''), '))', '') ELSE "default" END AS "default",
    pk_name IS NOT NULL AS primary_key, uk_name IS NOT NULL AS unique_key, fk_name, ref_schema, ref_table, ref_column,
    is_identity AS auto_increment
  FROM full_cols)"""


@registered(f"WITH {SQL_PROFILE} SELECT * FROM profiled")
def column_profile(spark, sf_dir):
    return catalog.profile(catalog.list_columns_with_constraints(snapshot(spark, sf_dir), listed(spark, sf_dir)))


@registered(f"""
WITH {SQL_PROFILE}
SELECT "schema", "table", ordinal,
  '{{"name":"' || sanitized_name || '","nullable":' || nullable || ',"primary_key":' || primary_key
  || ',"data_type":{{"base":{{"type":"' || base_type || '"' || coalesce(',"default":"' || "default" || '"', '') || '}}}}'
  || ',"metadata":{{"sourceName":"' || "column" || '","sanitizedName":"' || sanitized_name
  || '","uniqueKey":' || unique_key || ',"ordinalPosition":' || ordinal || '}}}}' AS entry
FROM profiled
""")
def manifest_rows(spark, sf_dir):
    listing = catalog.list_columns_with_constraints(snapshot(spark, sf_dir), listed(spark, sf_dir))
    return manifest_entries(catalog.profile(listing))


@registered(f"""
WITH {SQL_SNAPSHOT},
arrays AS (
  SELECT k, '[' || string_agg('{{"name":"' || "column" || '","type":"' || coalesce(data_type, 'USER_DEFINED_TYPE')
         || '","primaryKey":' || (n = 1) || '}}', ',' ORDER BY n) || ']' AS columns FROM cols GROUP BY k)
SELECT r."schema", r."table", (status <> 'P' AND o_custkey % 2 = 0) AS cdc_enabled, a.columns
FROM readable r LEFT JOIN arrays a ON a.k = r.k
""")
def catalog_nested(spark, sf_dir):
    return catalog.nested(snapshot(spark, sf_dir))
