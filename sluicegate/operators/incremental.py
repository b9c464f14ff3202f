"""Incremental pulls: watermark predicates, limited pulls, next state, boundary repeats."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..errors import JobError, StuckWatermarkError
from ..functions import text
from ..functions.types import quote, source_type, watermark_family
from ..session import ensure_checkpoint_dir

#: Rows that one task may sort or merge for a limit.
HEAP_ROWS = 100_000
MERGED_ROWS = 1_000_000

def watermark_field(df: DataFrame, column: str) -> T.StructField:
    """The watermark column's field, once it is known to exist and to be orderable."""
    field = next((f for f in df.schema.fields if f.name == column), None)
    if field is None:
        raise JobError(f'Column "{column}" specified for incremental fetching was not found.')
    if watermark_family(source_type(field)) is None:
        raise JobError(f'Column "{column}" specified for incremental fetching is not numeric or datetime.')
    return field


def state_literal(field: T.StructField, state: str) -> Column:
    """State text as a literal of the column's own type, so that a scan can push it down."""
    if isinstance(field.dataType, T.BinaryType):
        digits = state[2:] if state[:2].lower() == "0x" else state
        return F.lit(bytes.fromhex(digits.rjust(16, "0")))
    return F.lit(state).cast(field.dataType)


def state_text(field: T.StructField, value: Column) -> Column:
    """A watermark as state text; ``state_literal`` reads it back. Spark makes the text, so that a time
    does not pass through the driver's own zone; an instant is written in UTC with its offset, so that it
    means the same to a session of another zone."""
    if isinstance(field.dataType, T.BinaryType):
        return text.rowversion_hex(value)
    if isinstance(field.dataType, T.TimestampType):
        seconds = (F.unix_micros(value).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
        zero = F.lit(0)
        at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)
        return F.concat(at.cast("string"), F.lit("+00:00"))
    return value.cast("string")


def highest(field: T.StructField) -> Column:
    """The largest watermark. NaN is no watermark: it would be above all others for ever."""
    value = F.col(quote(field.name))
    is_float = isinstance(field.dataType, (T.DoubleType, T.FloatType))
    return F.max(F.when(~F.isnan(value), value) if is_float else value)


def since(df: DataFrame, column: str, state: str | None) -> DataFrame:
    """Rows at or after the state. The boundary row comes again, so nothing written at the same
    watermark is lost; without a state every row qualifies, NULL watermarks included."""
    field = watermark_field(df, column)
    if state is None:
        return df
    return df.where(F.col(quote(column)) >= state_literal(field, state))


def row_digest(columns: list[str]) -> Column:
    """A digest of a row's values in order, the same in every time zone and under other column names."""
    values = F.struct(*(F.col(quote(c)).alias(f"c{i}") for i, c in enumerate(columns)))
    return F.sha2(F.to_json(values, {"ignoreNullFields": "false", "timeZone": "UTC"}), 256)


def unsent(df: DataFrame, column: str, state: str | None, sent: DataFrame | None) -> DataFrame:
    """Rows after the state, and those at it that are not among ``sent`` (``digest``, ``n``), copies counted.

    Only rows at the state are looked up, by their digests and with one partial row for all copies in a task, so a watermark
    that very many rows share moves digests and one image of each.
    """
    if state is None or sent is None:
        return since(df, column, state)
    value, bound = F.col(quote(column)), state_literal(watermark_field(df, column), state)
    image = F.struct(*(F.col(quote(c)) for c in df.columns))
    at_state = df.where(value == bound).select(row_digest(df.columns).alias("digest"), image.alias("row"))
    met = at_state.groupBy("digest").agg(F.any_value("row").alias("row"), F.count(F.lit(1)).alias("there"))
    left = F.col("there") - F.coalesce("n", F.lit(0))
    more = met.join(sent.groupBy("digest").agg(F.sum("n").alias("n")), "digest", "left").where(left > 0)
    copies = more.select(F.explode(F.array_repeat("row", left.cast("int"))).alias("row"))
    return df.where(value > bound).unionByName(copies.select(*(F.col("row").getField(c).alias(c) for c in df.columns)))


def boundary(written: DataFrame, column: str, state: str | None) -> DataFrame:
    """Digests (``digest``, ``n``) of the written rows that are at the state, which a later pull meets again."""
    if state is None:
        at_state = written.limit(0)
    else:
        at_state = written.where(F.col(quote(column)) == state_literal(watermark_field(written, column), state))
    return at_state.groupBy(row_digest(written.columns).alias("digest")).agg(F.count(F.lit(1)).alias("n"))


def first_rows(
    df: DataFrame, column: str, n: int, tie_break: list[str] | None = None, heap_rows: int | None = None
) -> DataFrame:
    """The ``n`` rows with the lowest watermarks, NULLs first, ties in ``tie_break`` order.

    A small limit is a top-k: each task keeps ``n`` rows and one task merges them all. The larger the
    cluster, the more tasks there are and the smaller a limit has to be for that. Any other limit would
    overload the merging task, so the n-th order key is found first, and the batch becomes a filter
    that every task answers for itself. Passes over the watermark leave a narrow band that holds the
    n-th row; only the order columns of that band are moved to find its key.
    """
    watermark_field(df, column)
    order = [column, *(c for c in tie_break or [] if c != column)]
    spark = df.sparkSession
    if not tie_break:  # rows that share a watermark are told apart by their content, in either way of taking them
        order.append(_ROW_HASH)
        df = df.withColumn(_ROW_HASH, F.xxhash64(*(F.col(quote(c)) for c in df.columns)))
    if n <= (heap_rows or min(HEAP_ROWS, MERGED_ROWS // spark.sparkContext.defaultParallelism)):
        return df.orderBy(*_ascending(order)).limit(n).drop(_ROW_HASH)
    ensure_checkpoint_dir(spark)
    band, rows_before = _band(df, column, n)
    keys = df.where(band).groupBy(*(F.col(quote(c)) for c in order)).agg(F.count(F.lit(1)).alias(_COPIES))
    cut, copies, all_copies = _cut(keys, order, n - rows_before, heap_rows or HEAP_ROWS)
    if cut is None:
        batch = df
    elif copies == all_copies:  # always so with a unique key: one filter on one scan
        batch = df.where(_before(df, order, cut) | _equal(df, order, cut))
    else:
        at_cut = df.where(_equal(df, order, cut)).limit(copies)
        batch = df.where(_before(df, order, cut)).unionByName(at_cut)
    return batch.drop(_ROW_HASH)


_ROW_HASH, _COPIES, _PART = "__row_hash", "__copies", "__part"


#: Steps of the watermark's distribution that a large limit looks up, and how often it looks closer.
_STEPS, _LOOKS = 200, 3

_MEASURED_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _band(df: DataFrame, column: str, n: int) -> tuple[Column, int]:
    """Watermarks among which the n-th row is, and how many rows come before them."""
    band, before = F.lit(True), 0
    for _ in range(_LOOKS):
        narrower = _narrow(df.where(band).select(F.col(quote(column))), n - before)
        if narrower is None:
            break
        band, skipped, inside = narrower
        before += skipped
        if inside <= MERGED_ROWS:
            break
    return band, before


def _narrow(watermarks: DataFrame, n: int) -> tuple[Column, int, int] | None:
    """A band around the n-th watermark, the rows before it and the rows in it.

    An approximate distribution proposes the band and an exact count confirms it. None if there is no
    narrower band. Splits are put together first, as each of them sends a summary to one task.
    """
    (column,) = watermarks.columns
    value = F.col(quote(column))
    if not isinstance(watermarks.schema[column].dataType, _MEASURED_TYPES):
        return None
    steps = [i / _STEPS for i in range(_STEPS + 1)]
    tasks = 2 * watermarks.sparkSession.sparkContext.defaultParallelism
    rows, filled, marks = (
        watermarks.coalesce(tasks)
        .agg(F.count(F.lit(1)), F.count(value), F.percentile_approx(value, steps, 10 * _STEPS))
        .first()
    )
    nulls = rows - filled
    if n >= rows or nulls == rows:
        return None
    if n <= nulls:
        return value.isNull(), 0, nulls
    place = int((n - nulls) / filled * _STEPS)
    low = _cut_literal(watermarks, column, marks[max(place - 1, 0)])
    high = _cut_literal(watermarks, column, marks[min(place + 2, _STEPS)])
    inside = value.between(low, high)
    before, within = watermarks.agg(F.count(F.when(value < low, 1)), F.count(F.when(inside, 1))).first()
    before += nulls
    return (inside, before, within) if before < n <= before + within < before + rows else None


def _ascending(names: list[str]) -> list[Column]:
    return [F.col(quote(c)).asc_nulls_first() for c in names]


def _cut(keys: DataFrame, order: list[str], n: int, heap_rows: int) -> tuple[list | None, int, int]:
    """Order key of the n-th row, how many rows with just that key belong to the first n, and how many have it; None if
    there are no more than n rows.

    Distinct keys with their row counts are range-partitioned and written to the checkpoint folder,
    so counts and keys come from the same partitions even when executors are lost. The driver sees
    one count per partition; only the partition that holds the n-th key is looked into again.
    """
    width = max(2, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = keys.repartitionByRange(width, *_ascending(order)).withColumn(_PART, F.spark_partition_id()).checkpoint()
    parts = ranged.groupBy(_PART).agg(F.sum(_COPIES).alias("rows"), F.count(F.lit(1)).alias("keys")).orderBy(_PART)
    left = n
    counted = parts.collect()
    all_keys = sum(p["keys"] for p in counted)
    for part in counted:
        if left <= part["rows"]:
            break
        left -= part["rows"]
    else:
        return None, 0, 0
    inside = ranged.where(F.col(_PART) == part[_PART]).drop(_PART)
    if part["keys"] > max(heap_rows, 1):
        if part["keys"] == all_keys:
            raise JobError("The order keys of the limited pull cannot be dealt out in ranges.")
        return _cut(inside, order, left, heap_rows)
    seen = F.sum(_COPIES).over(Window.orderBy(*_ascending(order)).rowsBetween(Window.unboundedPreceding, 0))
    hit = inside.withColumn("__seen", seen).where(F.col("__seen") >= left).orderBy("__seen").limit(1).collect()[0]
    return [hit[c] for c in order], left - (hit["__seen"] - hit[_COPIES]), hit[_COPIES]


def _cut_literal(df: DataFrame, name: str, value) -> Column:
    return F.lit(bytes(value) if isinstance(value, bytearray) else value).cast(df.schema[name].dataType)


def _equal(df: DataFrame, order: list[str], cut: list) -> Column:
    same = F.lit(True)
    for name, value in zip(order, cut):
        same = same & F.col(quote(name)).eqNullSafe(_cut_literal(df, name, value))
    return same


def _before(df: DataFrame, order: list[str], cut: list) -> Column:
    """Rows strictly before the cut in lexicographic order, NULLs first."""
    earlier = F.lit(False)
    for name, value in reversed(list(zip(order, cut))):
        column, bound = F.col(quote(name)), _cut_literal(df, name, value)
        if value is None:
            earlier = column.isNull() & earlier
        else:
            earlier = column.isNull() | (column < bound) | ((column == bound) & earlier)
    return earlier


def watermark_max(df: DataFrame, column: str) -> DataFrame:
    """One row with the highest watermark of a whole table; NULL for an empty one."""
    field = watermark_field(df, column)
    top = highest(field)
    shown = text.rowversion_hex(top) if isinstance(field.dataType, T.BinaryType) else top
    return df.agg(shown.alias("watermark"))


def next_state(field: T.StructField, previous: str | None, highest: str | None) -> str | None:
    """State after a pull: the highest value seen, but never less than before."""
    if highest is None or previous is None:
        return previous if highest is None else highest
    return previous if _state_value(field, highest) < _state_value(field, previous) else highest


def _state_value(field: T.StructField, state: str):
    """State text as a value that compares like the column."""
    if isinstance(field.dataType, T.BinaryType):
        return int(state, 16)
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        at = dt.datetime.fromisoformat(state)  # states of earlier releases have no offset
        return at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    return Decimal(state)


def check_progress(previous: str | None, new: str | None, rows: int, limit: int | None) -> None:
    """A full batch that ends where it began would be pulled again for ever."""
    if limit and rows == limit and new is None:
        raise StuckWatermarkError(
            f"All {rows} rows of the limited pull have no watermark; raise the limit above the number of such rows."
        )
    if limit and previous is not None and rows == limit and previous == new:
        raise StuckWatermarkError(
            f"All {rows} rows of the limited pull share the watermark {new}; raise the limit above the number "
            "of rows with that value."
        )


def newest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in ``order``. Every task first drops all but its own last row of a
    key, so a key with very many rows sends one row per task. The key columns stay the ones that
    were grouped by, so a join by the same key does not move the rows again."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*(F.col(quote(c)) for c in order))
    image = F.struct(*(F.col(quote(c)) for c in rest)) if rest else F.lit(1)
    last = df.groupBy(*(F.col(quote(k)) for k in keys)).agg(F.max_by(image, rank).alias("__last"))
    return last.select(*(F.col(quote(c)) if c in keys else F.col("__last").getField(c).alias(c) for c in df.columns))
