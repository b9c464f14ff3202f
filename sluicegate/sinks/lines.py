"""Delimited text: three ways to show NULL, one row as one line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import JobError
from ..functions import text
from ..functions.types import quote
from ..operators.project import field_text, project_selective

MODES = ("selective", "quoted", "null_aware")

#: Records per file. A file whose records span lines is read back by one task.
RECORDS_PER_FILE = 1_000_000


def _selective_fields(df: DataFrame) -> list[Column]:
    return [text.null_to_empty(F.col(quote(c)).cast("string")) for c in df.columns]


def _field(field: T.StructField, mode: str) -> Column:
    shown = text.enclose(field_text(field))
    return F.coalesce(shown, F.lit('""' if mode == "quoted" else ""))


def lines(df: DataFrame, mode: str = "selective") -> DataFrame:
    """Rows as lines without a header, fields by comma, in one text column ``line``.

    ``selective`` quotes texts only and shows a NULL text as ``""``; ``quoted`` quotes everything and
    shows NULL as ``""``; ``null_aware`` quotes everything but leaves NULL bare, apart from ``""``.
    Every field is made a text first: joining with a separator would drop a NULL field.
    """
    if mode not in MODES:
        raise JobError(f'Unknown line mode "{mode}".')
    if mode == "null_aware" and len(df.columns) == 1:
        raise JobError("A NULL alone on a line cannot be told from no line; use another mode for a single column.")
    if mode == "selective":
        rendered = project_selective(df)
        return rendered.select(F.concat_ws(",", *_selective_fields(rendered)).alias("line"))
    return df.select(F.concat_ws(",", *(_field(f, mode) for f in df.schema.fields)).alias("line"))


def write_lines(df: DataFrame, path: str, mode: str = "selective", records_per_file: int = RECORDS_PER_FILE) -> None:
    (
        lines(df, mode)
        .write.mode("overwrite")
        .option("lineSep", "\n")
        .option("maxRecordsPerFile", records_per_file)
        .text(path)
    )


def write_quoted_csv(df: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Quoted mode through Spark's own CSV writer."""
    shown = df.select(*(text.null_to_empty(field_text(f)).alias(f.name) for f in df.schema.fields))
    (
        shown.write.mode("overwrite")
        .options(quoteAll="true", quote='"', escape='"', header="false", emptyValue="", lineSep="\n")
        .options(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
        .option("maxRecordsPerFile", records_per_file)
        .csv(path)
    )
