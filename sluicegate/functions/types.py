"""Source type names: base types, watermark families, field lengths, defaults.

Each rule exists once for a Python name (used on schemas, on the driver) and once as a column
expression (used on catalog snapshots, on the executors); both read the same fixed lists.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

# Source type names by base type. A name in none of the lists is a STRING.
BASE_TYPES = {
    "DATE": ("date",),
    "TIMESTAMP": ("datetime", "datetime2", "smalldatetime", "datetimeoffset"),
    "INTEGER": ("integer", "int", "smallint", "tinyint", "bigint"),
    "NUMERIC": ("numeric", "decimal", "money", "smallmoney"),
    "FLOAT": ("real", "float"),
    "BOOLEAN": ("bit",),
}

# Source type names by the way a watermark of that type is compared.
WATERMARK_FAMILIES = {
    "numeric": BASE_TYPES["INTEGER"] + BASE_TYPES["NUMERIC"] + BASE_TYPES["FLOAT"],
    "datetime": ("datetime", "datetime2", "datetimeoffset", "date"),
    "minute": ("smalldatetime",),
    "binary": ("timestamp", "rowversion"),
}

# Types whose length is never reported, and types whose default loses its brackets.
LENGTHLESS_TYPES = ("datetimeoffset", "datetime2", "datetime", "time", "smalldatetime", "date")
UNWRAPPED_TYPES = ("int", "bigint", "smallint", "tinyint", "decimal", "numeric", "float")

ROW_VERSION_TYPES = ("timestamp", "rowversion")
LARGE_TEXT_TYPES = ("text", "ntext", "xml")

#: StructField metadata key that carries the type name at the source.
SOURCE_TYPE = "source_type"

# The source type assumed for a Spark type when the field does not name one.
_DEFAULT_SOURCE_TYPES = {
    T.ByteType: "tinyint",
    T.ShortType: "smallint",
    T.IntegerType: "int",
    T.LongType: "bigint",
    T.FloatType: "real",
    T.DoubleType: "float",
    T.DecimalType: "decimal",
    T.BooleanType: "bit",
    T.DateType: "date",
    T.TimestampType: "datetime2",
    T.TimestampNTZType: "datetime2",
    T.BinaryType: "varbinary",
    T.StringType: "varchar",
}


def source_type(field: T.StructField) -> str:
    """Type name of a field at its source, from its metadata or else from its Spark type."""
    named = (field.metadata or {}).get(SOURCE_TYPE)
    if named:
        return named.lower()
    for spark_type, name in _DEFAULT_SOURCE_TYPES.items():
        if isinstance(field.dataType, spark_type):
            return name
    raise TypeError(f'Column "{field.name}" has the nested type {field.dataType.simpleString()}.')


def takes_null(field: T.StructField) -> bool:
    """Whether a column may hold NULL at its source; readers often report every column as if it may."""
    return bool((field.metadata or {}).get("nullable", field.nullable))


def with_source_types(df, types: dict[str, str]):
    """``df`` whose named columns carry their source type name; no data is touched."""
    return df.select(
        *(
            F.col(quote(f.name)).alias(f.name, metadata={**(f.metadata or {}), SOURCE_TYPE: types[f.name]})
            if f.name in types
            else F.col(quote(f.name))
            for f in df.schema.fields
        )
    )


def quote(name: str) -> str:
    """Identifier in back-ticks, for any column name."""
    return "`" + name.replace("`", "``") + "`"


def _lookup(table: dict[str, tuple[str, ...]], name: str, other):
    return next((key for key, names in table.items() if name.lower() in names), other)


def _lookup_col(table: dict[str, tuple[str, ...]], name: Column, other: Column) -> Column:
    lowered = F.lower(name)
    (first_key, first_names), *rest = table.items()
    start = F.when(lowered.isin(*first_names), F.lit(first_key))
    return reduce(lambda acc, kv: acc.when(lowered.isin(*kv[1]), F.lit(kv[0])), rest, start).otherwise(other)


def base_type(name: str) -> str:
    return _lookup(BASE_TYPES, name, "STRING")


def base_type_col(name: Column) -> Column:
    return _lookup_col(BASE_TYPES, name, F.lit("STRING"))


def watermark_family(name: str) -> str | None:
    """``numeric``, ``datetime``, ``minute`` or ``binary``; None if the type orders nothing."""
    return _lookup(WATERMARK_FAMILIES, name, None)


def watermark_family_col(name: Column) -> Column:
    return _lookup_col(WATERMARK_FAMILIES, name, F.lit(None).cast("string"))


def field_length_col(data_type: Column, precision: Column, scale: Column, char_length: Column) -> Column:
    """Reported length of a column as text: ``p``, ``p,s``, a character count, or NULL."""
    unbounded = (char_length == -1) | ((char_length == 16) & (data_type == "text"))
    by_precision = F.when(
        F.coalesce(scale, F.lit(0)) > 0,
        F.concat_ws(",", precision.cast("string"), scale.cast("string")),
    ).otherwise(precision.cast("string"))
    return (
        F.when(data_type.isin(*LENGTHLESS_TYPES), F.lit(None).cast("string"))
        .when(F.coalesce(precision, F.lit(0)) > 0, by_precision)
        .when(unbounded, F.lit(None).cast("string"))
        .otherwise(char_length.cast("string"))
    )


def default_unwrap_col(data_type: Column, default: Column) -> Column:
    """Default of a numeric column without its double brackets: ``((7))`` becomes ``7``."""
    inner = F.regexp_extract(default, r"\(\((.+)\)\)", 1)
    wrapped = F.lower(data_type).isin(*UNWRAPPED_TYPES) & (inner != "")
    return F.when(wrapped, inner).otherwise(default)
