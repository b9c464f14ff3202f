"""Row predicates that are not watermarks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.types import ROW_VERSION_TYPES, quote, source_type


def like_any_case(value: Column, pattern: str) -> Column:
    """``LIKE`` under a case-insensitive collation."""
    return value.ilike(pattern)


def keep_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key combination is listed. Whole combinations are matched, so a schema of one
    entry never pairs with the table of another; each is kept once before it moves."""
    return df.join(listed.select(*on).distinct(), on=on, how="left_semi")


def matching_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``df`` that equal some row of ``rows`` in every column but row versions.

    NULL equals NULL, and for texts NULL equals the empty text, as both leave an export as the
    same field. ``rows`` is made distinct first, so copies of one row do not pile up in the join.
    """
    fields = [f for f in df.schema.fields if source_type(f) not in ROW_VERSION_TYPES]

    def comparable(field: T.StructField) -> Column:
        value = F.col(quote(field.name))
        return F.coalesce(value, F.lit("")) if isinstance(field.dataType, T.StringType) else value

    wanted = rows.select(*(comparable(f).alias(f"__m{i}") for i, f in enumerate(fields))).distinct()
    same = reduce(and_, (comparable(f).eqNullSafe(F.col(f"__m{i}")) for i, f in enumerate(fields)))
    return df.join(wanted, same, "left_semi")
