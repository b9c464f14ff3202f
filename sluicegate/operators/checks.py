"""Counts taken while data is written, row shapes and key checks."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from ..functions.types import quote
from .incremental import highest, state_text

BAD_RECORD = "__bad_record"


def observed(
    df: DataFrame, column: str | None = None, keys: list[str] | None = None
) -> tuple[DataFrame, Observation]:
    """``df`` that reports its row count, highest watermark, NULL watermarks and NULL keys as it is
    written.

    It is to stand directly before the write: in the last stage a task that runs again is still
    counted once.
    """
    seen = Observation()
    measures = [F.count(F.lit(1)).alias("rows")]
    if column:
        value = F.col(quote(column))
        measures += [
            state_text(df.schema[column], highest(df.schema[column])).alias("watermark"),
            F.count(F.when(value.isNull(), 1)).alias("null_watermarks"),
        ]
    if keys:
        keyless = reduce(or_, (F.col(quote(k)).isNull() for k in keys))
        measures.append(F.count(F.when(keyless, 1)).alias("null_keys"))
    return df.observe(seen, *measures), seen


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def record_schema(n_fields: int) -> T.StructType:
    fields = [T.StructField(f"c{i}", T.StringType()) for i in range(1, n_fields + 1)]
    return T.StructType([*fields, T.StructField(BAD_RECORD, T.StringType())])


# CSV options under which a quoted empty field is '' and a bare one is NULL. The text for
# NULL is one that no field holds, as a field equal to it would be read as NULL.
CSV_READ_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "charToEscapeQuoteEscaping": '"',
    "emptyValue": "",
    "nullValue": "\u0001no such text\u0001",
    "lineSep": "\n",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": BAD_RECORD,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "maxCharsPerColumn": "-1",
}


def misshapen(lines: DataFrame, n_fields: int, line: str = "line") -> DataFrame:
    """Lines that do not hold exactly ``n_fields`` delimited fields."""
    parsed = F.from_csv(F.col(quote(line)), record_schema(n_fields).simpleString(), CSV_READ_OPTIONS)
    return lines.where(parsed.getField(BAD_RECORD).isNotNull())


def null_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that cannot be keyed, as part of their key is NULL."""
    return df.where(reduce(or_, (F.col(quote(k)).isNull() for k in keys)))


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that more than one row has."""
    return df.groupBy(*(F.col(quote(k)) for k in keys)).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def key_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows there are, how many lack a key, how many keys repeat."""
    key = [F.col(quote(k)) for k in keys]
    has_null = reduce(or_, (k.isNull() for k in key))
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    total = F.coalesce(F.sum("__n"), F.lit(0))
    return per_key.agg(
        total.alias("rows"),
        F.coalesce(F.sum(F.when(has_null, F.col("__n"))), F.lit(0)).alias("null_keys"),
        F.count(F.when(~has_null & (F.col("__n") > 1), 1)).alias("repeated_keys"),
    )


def as_key(df: DataFrame, keys: list[str]) -> T.StructType:
    """Schema of ``df`` in which the key columns take no NULL."""
    return T.StructType(
        [T.StructField(f.name, f.dataType, f.nullable and f.name not in keys, f.metadata) for f in df.schema.fields]
    )
