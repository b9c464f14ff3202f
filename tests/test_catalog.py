import json

import pytest
from pyspark.sql import functions as F

from sluicegate.operators import catalog

TABLE, COLUMN = "schema string, table string", "schema string, table string, column string"


def snapshot(spark, **parts):
    empty = {
        "tables": f"catalog string, {TABLE}, type string",
        "objects": f"{TABLE}, kind string, is_system boolean",
        "cdc_tables": f"{TABLE}, is_tracked boolean",
        "columns": f"{COLUMN}, ordinal int, data_type string, nullable boolean, precision int, scale int, "
        "char_length int, default string, is_identity boolean",
        "indexes": f"{TABLE}, index_id int, index_name string, is_primary boolean",
        "index_columns": f"{TABLE}, index_id int, ordinal int",
        "constraints": f"{TABLE}, constraint string, type string",
        "key_usage": f"{TABLE}, constraint string, column string, ordinal int",
        "references": "schema string, constraint string, ref_schema string, ref_constraint string",
    }
    return catalog.Snapshot(**{k: spark.createDataFrame(parts.get(k, []), s) for k, s in empty.items()})


@pytest.fixture
def shop(spark):
    return snapshot(
        spark,
        tables=[("test", "dbo", t, k) for t, k in (("sales", "BASE TABLE"), ("v", "VIEW"), ("sys", "BASE TABLE"))]
        + [("test", "other", "sales", "BASE TABLE")],
        objects=[("dbo", "sales", "U", False), ("dbo", "v", "V", False), ("dbo", "sys", "U", True),
                 ("other", "sales", "U", False), ("dbo", "proc", "P", False)],
        cdc_tables=[("dbo", "sales", True), ("other", "sales", False)],
        columns=[("dbo", "sales", "name", 2, "varchar", True, 0, 0, 100, None, False),
                 ("dbo", "sales", "id", 1, "int", False, 10, 0, 4, "((7))", True),
                 ("dbo", "sales", "kind", 3, None, True, None, None, None, None, None),
                 ("dbo", "v", "id", 1, "int", True, 10, 0, 4, None, False),
                 ("other", "sales", "id", 1, "decimal", False, 18, 2, 9, None, False),
                 ("dbo", "sys", "id", 1, "int", True, 10, 0, 4, None, False)],
        indexes=[("dbo", "sales", 1, "PK_sales", True), ("dbo", "sales", 2, "IX", False)],
        index_columns=[("dbo", "sales", 1, 1), ("dbo", "sales", 2, 2)],
        constraints=[("dbo", "sales", "PK_sales", "PRIMARY KEY"), ("dbo", "sales", "UNI", "UNIQUE"),
                     ("dbo", "sales", "C1", "CHECK"), ("dbo", "sales", "C2", "CHECK"), ("dbo", "sales", "C3", "CHECK"),
                     ("dbo", "sales", "FK_b", "FOREIGN KEY"), ("dbo", "sales", "FK_a", "FOREIGN KEY"),
                     ("other", "sales", "PK_other", "PRIMARY KEY")],
        key_usage=[("dbo", "sales", "PK_sales", "id", 1), ("dbo", "sales", "UNI", "name", 1),
                   ("dbo", "sales", "C1", "name", 0), ("dbo", "sales", "C2", "name", 0), ("dbo", "sales", "C3", "name", 0),
                   ("dbo", "sales", "FK_b", "id", 1), ("dbo", "sales", "FK_a", "id", 1),
                   ("other", "sales", "PK_other", "id", 1)],
        references=[("dbo", "FK_a", "other", "PK_other"), ("dbo", "FK_b", "dbo", "PK_sales")],
    )


def test_tables(shop):
    got = [tuple(r) for r in catalog.list_tables(shop).collect()]
    assert got == [
        ("test", "dbo", "sales", "BASE TABLE", True),
        ("test", "dbo", "v", "VIEW", False),
        ("test", "other", "sales", "BASE TABLE", False),
    ]


def test_whitelist_takes_pairs(spark, shop):
    listed = spark.createDataFrame([("dbo", "v"), ("other", "sales")], "schema string, table string")
    got = [(r.schema, r.table) for r in catalog.list_tables(shop, listed).collect()]
    assert got == [("dbo", "v"), ("other", "sales")]


def test_columns_in_table_order(shop):
    got = [(r.schema, r.table, r.column, r.pk_name) for r in catalog.list_columns(shop).collect()]
    assert got == [("dbo", "sales", "id", "PK_sales"), ("dbo", "sales", "name", None), ("dbo", "sales", "kind", None),
                   ("dbo", "v", "id", None), ("other", "sales", "id", None)]


def test_a_column_with_many_constraints_is_listed_once(spark, shop):
    listed = spark.createDataFrame([("dbo", "sales")], "schema string, table string")
    rows = catalog.list_columns_with_constraints(shop, listed).collect()
    assert [r.column for r in rows] == ["id", "name", "kind"]
    key, name, kind = rows
    assert (key.pk_name, key.fk_name, key.ref_schema, key.ref_table, key.ref_column) == (
        "PK_sales", "FK_a", "other", "sales", "id",
    )
    assert (name.uk_name, name.chk_name, name.pk_name) == ("UNI", "C1", None)
    assert kind.pk_name is None


def test_profile(spark, shop):
    rows = {(r.schema, r.table, r.column): r for r in catalog.profile(catalog.list_columns_with_constraints(shop)).collect()}
    key = rows["dbo", "sales", "id"]
    assert (key.type, key.base_type, key.length, key.default, key.nullable) == ("int", "INTEGER", "10", "7", False)
    assert (key.primary_key, key.unique_key, key.auto_increment) == (True, False, True)
    assert rows["dbo", "sales", "name"].length == "100" and rows["dbo", "sales", "name"].unique_key
    unknown = rows["dbo", "sales", "kind"]
    assert (unknown.type, unknown.base_type, unknown.length) == ("USER_DEFINED_TYPE", "STRING", None)
    assert rows["other", "sales", "id"].length == "18,2"
    quick = catalog.profile(catalog.list_columns(shop)).where("primary_key").collect()
    assert [(r.schema, r.column) for r in quick] == [("dbo", "id")]


def test_nested_listing(shop):
    rows = {(r.schema, r.table): r for r in catalog.nested(shop).collect()}
    sales = rows["dbo", "sales"]
    assert sales.cdc_enabled
    assert json.loads(sales.columns) == [
        {"name": "id", "type": "int", "primaryKey": True},
        {"name": "name", "type": "varchar", "primaryKey": False},
        {"name": "kind", "type": "USER_DEFINED_TYPE", "primaryKey": False},
    ]


def test_many_tables_at_once(spark):
    """5 schemas of 100 tables of 51 columns."""
    ids = spark.range(500).select(
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("schema"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("table"),
    )
    base = snapshot(spark)
    columns = ids.select("*", F.explode(F.sequence(F.lit(1), F.lit(51))).alias("ordinal")).select(
        "schema", "table", F.concat(F.lit("c"), F.col("ordinal").cast("string")).alias("column"), "ordinal",
        F.lit("varchar").alias("data_type"), F.lit(True).alias("nullable"), F.lit(0).alias("precision"),
        F.lit(0).alias("scale"), F.lit(50).alias("char_length"), F.lit(None).cast("string").alias("default"),
        (F.col("ordinal") == 1).alias("is_identity"),
    )
    shot = catalog.Snapshot(
        tables=ids.select(F.lit("test").alias("catalog"), "*", F.lit("BASE TABLE").alias("type")),
        objects=ids.select("*", F.lit("U").alias("kind"), F.lit(False).alias("is_system")),
        cdc_tables=base.cdc_tables,
        columns=columns,
        indexes=ids.select("*", F.lit(1).alias("index_id"), F.lit("pk").alias("index_name"), F.lit(True).alias("is_primary")),
        index_columns=ids.select("*", F.lit(1).alias("index_id"), F.lit(1).alias("ordinal")),
        constraints=base.constraints,
        key_usage=base.key_usage,
        references=base.references,
    )
    rows = catalog.nested(shot).collect()
    assert len(rows) == 500
    entries = json.loads(rows[0].columns)
    assert [e["name"] for e in entries] == [f"c{i}" for i in range(1, 52)]
    assert [e["primaryKey"] for e in entries] == [True] + [False] * 50
