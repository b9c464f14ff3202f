"""Projections: column choice, identifier handling and per-type export forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import JobError
from ..functions import text
from ..functions.types import (
    LARGE_TEXT_TYPES,
    ROW_VERSION_TYPES,
    base_type,
    quote,
    source_type,
    takes_null,
)


def select_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The named columns in the order asked for; all of them in table order by default."""
    if not columns:
        return df
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise JobError(f'Column "{missing[0]}" was not found.')
    return df.select(*(F.col(quote(c)) for c in columns))


def _plain(field: T.StructField) -> Column:
    value, kind = F.col(quote(field.name)), source_type(field)
    if kind in ROW_VERSION_TYPES:
        return text.rowversion_hex(value)
    if kind in LARGE_TEXT_TYPES:
        return value.cast("string")
    return value


def project_plain(df: DataFrame) -> DataFrame:
    """Row versions as hex and large texts as strings; every other column as it is."""
    return df.select(*(_plain(f).alias(f.name) for f in df.schema.fields))


def _selective(field: T.StructField) -> Column:
    value, kind = F.col(quote(field.name)), source_type(field)
    if kind in ROW_VERSION_TYPES:
        return text.rowversion_hex(value)
    base = base_type(kind)
    if base == "STRING":
        shown = text.rowversion_hex(value) if isinstance(field.dataType, T.BinaryType) else value.cast("string")
        return text.enclose(text.null_to_empty(shown) if takes_null(field) else shown)
    if base == "TIMESTAMP":
        return text.timestamp_digits(value, 0) if kind == "smalldatetime" else text.timestamp_ms(value)
    if base == "BOOLEAN":
        return value.cast("int")
    return value


def project_selective(df: DataFrame) -> DataFrame:
    """Strings enclosed (NULL as an empty one where NULL is possible), wall times as text in
    milliseconds, row versions as hex; numbers keep their type."""
    return df.select(*(_selective(f).alias(f.name) for f in df.schema.fields))


def field_text(field: T.StructField) -> Column:
    """A column as the bare text that stands between the quotes of an output line."""
    value, kind = F.col(quote(field.name)), source_type(field)
    if isinstance(field.dataType, T.BinaryType):
        return text.rowversion_hex(value)
    if isinstance(field.dataType, T.BooleanType):
        return value.cast("int").cast("string")
    if base_type(kind) == "TIMESTAMP":
        digits = {"smalldatetime": 0, "datetime": 3}.get(kind, 6)
        return text.timestamp_digits(value, (field.metadata or {}).get("scale", digits))
    return value.cast("string")


def clean_nul_fields(df: DataFrame) -> DataFrame:
    """Every text that is exactly one NUL character becomes empty."""
    return df.select(
        *(
            text.nul_cleanup(F.col(quote(f.name))).alias(f.name, metadata=f.metadata)
            if isinstance(f.dataType, T.StringType)
            else F.col(quote(f.name))
            for f in df.schema.fields
        )
    )


def with_safe_names(df: DataFrame) -> DataFrame:
    """The same columns under sanitized, unique names."""
    return df.toDF(*text.sanitize_names(df.columns))
