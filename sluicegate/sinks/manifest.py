"""Schema manifests: what a loader needs to know about an output."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import text
from ..functions.types import base_type, source_type, takes_null


def _columns(schema: T.StructType, primary_key: list[str]) -> list[dict]:
    names = text.sanitize_names(schema.names)
    return [
        {
            "source_name": f.name,
            "name": name,
            "nullable": takes_null(f) and f.name not in primary_key,
            "base_type": base_type(source_type(f)),
            "default": (f.metadata or {}).get("default"),
            "unique_key": bool((f.metadata or {}).get("unique_key", False)),
            "ordinal": (f.metadata or {}).get("ordinal", i),
            "primary_key": f.name in primary_key,
        }
        for i, (f, name) in enumerate(zip(schema.fields, names), start=1)
    ]


def _table(catalog: str | None, schema: str | None, name: str, kind: str) -> dict:
    known = {"name": name, "sanitizedName": text.sanitize_name(name), "schema": schema, "catalog": catalog, "type": kind}
    return {key: value for key, value in known.items() if value is not None}


def manifest(
    schema: T.StructType,
    destination: str,
    incremental: bool = False,
    primary_key: list[str] | None = None,
    table: dict | None = None,
    native_types: bool = False,
    prefix: str = "",
) -> dict:
    """Manifest of an output with the given schema.

    ``table`` (name, and schema, catalog and type if known) is for outputs of table jobs; a query's
    output has no table metadata and no positions. ``native_types`` picks the layout with a ``schema``
    list; ``prefix`` goes before every metadata key.
    """
    columns = _columns(schema, primary_key or [])
    about = _table(table.get("catalog"), table.get("schema"), table["name"], table.get("type", "BASE TABLE")) if table else None
    result: dict = {"destination": destination, "incremental": incremental}
    if native_types:
        if about:
            result["table_metadata"] = {prefix + k: v for k, v in about.items()}
        result["schema"] = [_native_column(c, bool(table), prefix) for c in columns]
        return result
    if about:
        result["metadata"] = [{"key": prefix + k, "value": v} for k, v in about.items()]
    result["columns"] = [c["name"] for c in columns]
    if primary_key:
        result["primary_key"] = [c["name"] for c in columns if c["primary_key"]]
    result["column_metadata"] = {
        c["name"]: [{"key": prefix + k, "value": v} for k, v in _metadata(c, bool(table)).items()] for c in columns
    }
    return result


def _facts(column: dict, of_table: bool) -> dict:
    facts = {
        "sourceName": column["source_name"],
        "sanitizedName": column["name"],
        "uniqueKey": column["unique_key"],
    }
    if of_table:
        facts["ordinalPosition"] = column["ordinal"]
    return facts


def _metadata(column: dict, of_table: bool) -> dict:
    typed = {"datatype.nullable": column["nullable"], "datatype.basetype": column["base_type"]}
    if column["default"] is not None:
        typed["datatype.default"] = column["default"]
    return {**typed, **_facts(column, of_table)}


def _native_column(column: dict, of_table: bool, prefix: str) -> dict:
    base = {"type": column["base_type"]}
    if column["default"] is not None:
        base["default"] = column["default"]
    return {
        "name": column["name"],
        "nullable": column["nullable"],
        "primary_key": column["primary_key"],
        "data_type": {"base": base},
        "metadata": {prefix + k: v for k, v in _facts(column, of_table).items()},
    }


def manifest_rows(profile: DataFrame) -> DataFrame:
    """Manifest entries of all columns of a profiled catalog, one row each, in the native layout."""
    entry = F.struct(
        F.col("sanitized_name").alias("name"),
        "nullable",
        "primary_key",
        F.struct(F.struct(F.col("base_type").alias("type"), "default").alias("base")).alias("data_type"),
        F.struct(
            F.col("column").alias("sourceName"),
            F.col("sanitized_name").alias("sanitizedName"),
            F.col("unique_key").alias("uniqueKey"),
            F.col("ordinal").alias("ordinalPosition"),
        ).alias("metadata"),
    )
    return profile.select("schema", "table", "ordinal", F.to_json(entry).alias("entry"))


def write_json(spark: SparkSession, value: dict, path: str) -> None:
    """One small JSON document as a folder of one text file."""
    rows = spark.createDataFrame([(json.dumps(value),)], "value string").coalesce(1)
    rows.write.mode("overwrite").text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
