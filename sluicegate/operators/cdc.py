"""Change data capture: log positions by time, net changes per key, full loads.

A change log has one row per change: key and payload columns, a log position that orders the changes,
an operation (fixed values: 1 delete, 2 insert, 3 row before an update, 4 row after it) and the commit
time of the position.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..errors import JobError, LsnRangeError
from ..functions.types import quote
from .incremental import state_text

DELETE, INSERT, BEFORE_UPDATE, UPDATE = 1, 2, 3, 4

IS_DELETED = "is_deleted"


@dataclass(frozen=True)
class ChangeLog:
    """A change log and the meaning of its columns.

    Positions rise with commit times. ``sequence`` orders changes of one position. ``positions`` is a
    list of positions and their commit times, where one is kept beside the log; the log itself serves
    otherwise.
    """

    df: DataFrame
    keys: list[str]
    lsn: str = "lsn"
    op: str = "op"
    time: str = "ts"
    sequence: list[str] = field(default_factory=list)
    positions: DataFrame | None = None

    @property
    def payload(self) -> list[str]:
        meta = {self.lsn, self.op, self.time, *self.sequence}
        return [c for c in self.df.columns if c not in meta]

    @property
    def times(self) -> DataFrame:
        return self.df if self.positions is None else self.positions

    def between(self, from_lsn, to_lsn) -> DataFrame:
        """Changes of a range, both ends included."""
        position = F.col(quote(self.lsn))
        return self.df.where((position >= F.lit(from_lsn)) & (position <= F.lit(to_lsn)))


def first_lsn_since(log: ChangeLog, time: Column) -> DataFrame:
    """Smallest position committed at or after ``time``; NULL if there is none."""
    return log.times.where(F.col(quote(log.time)) >= time).agg(F.min(F.col(quote(log.lsn))).alias("lsn"))


def last_lsn_until(log: ChangeLog, time: Column) -> DataFrame:
    """Largest position committed at or before ``time``; NULL if there is none."""
    return log.times.where(F.col(quote(log.time)) <= time).agg(F.max(F.col(quote(log.lsn))).alias("lsn"))


def lsn_bounds(log: ChangeLog, begin: Column, end: Column, on_no_change: str = "min") -> DataFrame:
    """One row with the positions to read between two times, in one pass over two columns.

    When nothing was committed at or after ``begin``, the range starts at the log's minimum
    (``on_no_change="min"``, which sends the whole retention again) or stays NULL (``"empty"``).
    """
    if on_no_change not in ("min", "empty"):
        raise JobError(f'on_no_change is "min" or "empty", not "{on_no_change}".')
    position, time = F.col(quote(log.lsn)), F.col(quote(log.time))
    since, low = F.min(F.when(time >= begin, position)), F.min(position)
    return log.times.agg(
        (F.coalesce(since, low) if on_no_change == "min" else since).alias("from_lsn"),
        F.max(F.when(time <= end, position)).alias("to_lsn"),
        low.alias("min_lsn"),
        F.max(position).alias("max_lsn"),
    )


def range_between(log: ChangeLog, begin: Column, end: Column, on_no_change: str = "min") -> tuple:
    """First and last position to read between two times.

    What was committed since ``begin`` is looked at first, a predicate that lets a scan skip the older
    part of the log; only when that leaves a bound open is the whole log asked.
    """
    position, time = F.col(quote(log.lsn)), F.col(quote(log.time))
    recent = tuple(log.times.where(time >= begin).agg(F.min(position), F.max(F.when(time <= end, position))).first())
    if None not in recent:
        return recent
    return tuple(lsn_bounds(log, begin, end, on_no_change).first()[:2])


def positions_at(times: DataFrame, asked: DataFrame, tables: list[str], time: str = "ts", lsn: str = "lsn") -> DataFrame:
    """``asked`` with ``last_until`` and ``first_since``: the largest position committed at or before its ``time``, and the
    smallest at or after it, in the log of its ``tables`` columns. Many times of many logs are looked up at once.

    Times and positions of a log meet by day, in one shuffle and two sorts of each, as positions after a time are looked up in
    falling order: Spark adds to a frame that starts with its partition, but computes one that ends with it anew for every row.
    What lies beyond a day's ends is carried over from the days before and after, of which a log has one row each. Positions
    rise with commit times, and those of one time are reduced before they move.

    NULL without such a position, for a log without positions and for a NULL time. Logs are matched NULL-safe. Repeated
    rows of ``asked``: each is answered. Empty tables: no rows, or NULLs.
    """
    names = [F.col(quote(c)) for c in tables]
    at = F.col(quote(time))
    known = times.where(at.isNotNull()).groupBy(*names, at).agg(F.min(F.col(quote(lsn))).alias("__low"), F.max(F.col(quote(lsn))).alias("__high"))
    known = known.select(*names, at, "__low", "__high", F.lit(None).cast(asked.select(F.struct("*")).schema[0].dataType).alias("__row"))
    low, high = (F.lit(None).cast(known.schema[c].dataType).alias(c) for c in ("__low", "__high"))
    met = known.unionByName(asked.select(*names, at, low, high, F.struct("*").alias("__row"))).withColumn("__day", at.cast("date"))
    of_day = Window.partitionBy(*names, "__day").rangeBetween(Window.unboundedPreceding, 0)
    inside = met.select(
        "*", F.max("__high").over(of_day.orderBy(at)).alias("__until"), F.min("__low").over(of_day.orderBy(at.desc())).alias("__since"),
    ).where(F.col("__row").isNotNull())
    days = met.groupBy(*names, "__day").agg(F.min("__low").alias("__low"), F.max("__high").alias("__high"))
    of_log = Window.partitionBy(*names).rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(
        *(n.alias(f"__log{i}") for i, n in enumerate(names)), F.col("__day").alias("__of"),
        F.max("__high").over(of_log.orderBy("__day")).alias("__before"),
        F.min("__low").over(of_log.orderBy(F.desc("__day"))).alias("__after"),
    )
    same = F.col("__day") == F.col("__of")
    for i, name in enumerate(names):
        same = same & name.eqNullSafe(F.col(f"__log{i}"))
    found = inside.join(carried, same, "left")
    is_asked = at.isNotNull()
    return found.select(
        *(F.col("__row").getField(c).alias(c) for c in asked.columns),
        F.when(is_asked, F.coalesce("__until", "__before")).alias("last_until"),
        F.when(is_asked, F.coalesce("__since", "__after")).alias("first_since"),
    )


def check_range(from_lsn, to_lsn) -> None:
    if from_lsn is not None and to_lsn is not None and to_lsn < from_lsn:
        raise LsnRangeError("The end LSN is less than the start LSN.")


def net_changes(
    log: ChangeLog,
    from_lsn,
    to_lsn,
    columns: list[str] | None = None,
    with_log_columns: bool = False,
    keep_vanished: bool = False,
) -> DataFrame:
    """The one change per key that a range amounts to, with its delete flag.

    A key's last row image wins. A key that was inserted and deleted inside the range is left out, or kept as a
    delete with ``keep_vanished``: ranges of runs share a position, so an earlier one may have sent the insert. One
    that was deleted and inserted again counts as updated. First and last change of a key come out of
    one aggregation that every task starts on its own rows, so a key with very many changes sends one
    row per task. Only the columns asked for are carried along.
    """
    check_range(from_lsn, to_lsn)
    op = F.col(quote(log.op))
    changes = log.between(from_lsn, to_lsn).where(op != BEFORE_UPDATE)
    shown = columns or log.payload
    carried = [c for c in shown if c not in log.keys] + [log.op] + ([log.lsn, log.time] if with_log_columns else [])
    order = [F.col(quote(c)) for c in [log.lsn, *log.sequence]]
    rank = order[0] if len(order) == 1 else F.struct(*order)
    net = changes.groupBy(*(F.col(quote(k)) for k in log.keys)).agg(
        F.max_by(F.struct(*(F.col(quote(c)) for c in carried)), rank).alias("__last"),
        F.min_by(op, rank).alias("__first_op"),
    )
    last = F.col("__last")
    last_op = last.getField(log.op)
    vanished = (F.col("__first_op") == INSERT) & (last_op == DELETE)
    net_op = F.when(last_op == DELETE, DELETE).when(F.col("__first_op") == INSERT, INSERT).otherwise(UPDATE)
    result = [F.col(quote(c)) if c in log.keys else last.getField(c).alias(c) for c in shown]
    if with_log_columns:
        result += [last.getField(log.lsn).alias(log.lsn), net_op.alias(log.op), last.getField(log.time).alias(log.time)]
    kept = net if keep_vanished else net.where(~vanished)
    return kept.select(*result, F.when(last_op == DELETE, 1).otherwise(0).alias(IS_DELETED))


def all_changes(log: ChangeLog, from_lsn, to_lsn) -> DataFrame:
    """Every change of a range, both images of updates included."""
    check_range(from_lsn, to_lsn)
    return log.between(from_lsn, to_lsn)


def full_load(table: DataFrame) -> DataFrame:
    """A whole table in the shape of net changes."""
    return table.withColumn(IS_DELETED, F.lit(0))


def commit_time(log: ChangeLog, since: Column | None = None) -> DataFrame:
    """Commit time of the log's last position, which is the next run's start. With ``since`` only newer
    positions are looked at; NULL then says that there are none."""
    times = log.times if since is None else log.times.where(F.col(quote(log.time)) >= since)
    return times.agg(F.max_by(F.col(quote(log.time)), F.col(quote(log.lsn))).alias("last_fetched_time"))


def last_position(log: ChangeLog, since: Column | None = None) -> tuple:
    """The log's last position and its commit time as state text; with ``since`` only newer ones are looked at. NULLs
    if there is none."""
    times = log.times if since is None else log.times.where(F.col(quote(log.time)) >= since)
    position, time = F.col(quote(log.lsn)), F.col(quote(log.time))
    return tuple(times.agg(F.max(position), state_text(times.schema[log.time], F.max_by(time, position))).first())


def time_literal(log: ChangeLog, text: str) -> Column:
    """State text in the type of the log's commit times; an instant's text has its offset."""
    return F.lit(text).cast(log.times.schema[log.time].dataType)


def changes_since(
    table: DataFrame,
    log: ChangeLog,
    last_time: str | None,
    now: Column,
    full_load_fallback: bool = False,
    always_flag: bool = False,
    on_no_change: str = "min",
    end_lsn=None,
    keep_vanished: bool = False,
) -> DataFrame:
    """What a run exports: the whole table at first, net changes since ``last_time`` later.

    With ``end_lsn`` the range ends there, whatever a clock says. The two bounds are the only values that reach the driver; as literals they prune the second scan.
    A range that ends before it starts is an error, or a flagged full load if that is allowed.
    """
    if last_time is None:
        return full_load(table) if always_flag else table
    from_lsn, to_lsn = range_between(log, time_literal(log, last_time), now, on_no_change)
    to_lsn = to_lsn if end_lsn is None else end_lsn
    if from_lsn is None or to_lsn is None:
        return full_load(table).where(F.lit(False))
    try:
        return net_changes(log, from_lsn, to_lsn, table.columns, keep_vanished=keep_vanished)
    except LsnRangeError:
        if not full_load_fallback:
            raise
        return full_load(table)
