"""From a job's options to a plan, one write, a manifest and a new state."""

from __future__ import annotations

import logging
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..errors import BatchError, JobError
from ..functions.types import quote
from ..operators import cdc, checks, incremental
from ..operators.project import clean_nul_fields, select_columns, with_safe_names
from ..sinks.columnar import remove, write_parquet
from ..sinks.lines import MODES, write_lines
from ..sinks.manifest import manifest, write_json
from ..sinks.state import State, append_state, read_state
from ..sources.tables import scan, with_distinct_names
from ..spec import JobSpec

log = logging.getLogger("sluicegate")


@dataclass(frozen=True)
class JobResult:
    output: str
    rows: int
    data_path: str | None
    manifest_path: str
    state: State
    null_watermarks: int = 0
    null_keys: int = 0


def plan(spec: JobSpec, source, state: State, end_lsn=None, base: str | None = None) -> DataFrame:
    """The rows of one run, lazily. A change range ends at ``end_lsn``, the position its state is taken from. What earlier
    runs left beside their state is looked up below ``base``."""
    if spec.query:
        rows = with_distinct_names(source.query(spec.query, timeout_s=spec.timeout_s))
        return clean_nul_fields(select_columns(rows, spec.columns))
    table = source.table(spec.schema, spec.table, read_uncommitted=spec.read_uncommitted, timeout_s=spec.timeout_s)
    if spec.cdc:
        return _plan_changes(spec, source, table, state, end_lsn)
    if spec.watermark:
        incremental.watermark_field(table, spec.watermark)
        if base and hasattr(source, "since"):
            table = source.since(table, spec.schema, spec.table, spec.watermark, state.last_fetched_row, f"{base}/zones")
        else:
            table = incremental.since(table, spec.watermark, state.last_fetched_row)
        if spec.exactly_once and base:
            sent = read_boundary(table.sparkSession, base, state)
            table = incremental.unsent(select_columns(table, spec.columns), spec.watermark, state.last_fetched_row, sent)
        if spec.limit:
            table = incremental.first_rows(table, spec.watermark, spec.limit, spec.primary_key)
    return select_columns(table, spec.columns)


def _plan_changes(spec: JobSpec, source, table: DataFrame, state: State, end_lsn) -> DataFrame:
    if not spec.primary_key:
        raise JobError("Change capture needs a primary key.")
    changes = source.changes(spec.schema, spec.table, spec.primary_key)
    kind = changes.df.schema[changes.time].dataType
    now = F.current_timestamp() if isinstance(kind, T.TimestampType) else F.localtimestamp()
    return cdc.changes_since(
        select_columns(table, spec.columns), changes, state.last_fetched_time, now, spec.cdc_full_load_fallback,
        end_lsn=end_lsn, keep_vanished=True,
    )


@contextmanager
def time_limit(spark: SparkSession, seconds: int | None):
    """Cancels the Spark jobs of the block when it takes longer than ``seconds``."""
    if not seconds:
        yield
        return
    context, tag = spark.sparkContext, f"sluice-{uuid.uuid4().hex}"
    expired = threading.Event()

    def stop():
        expired.set()
        context.cancelJobsWithTag(tag)

    timer = threading.Timer(seconds, stop)
    context.addJobTag(tag)
    timer.start()
    try:
        yield
    except Exception as e:
        if expired.is_set():
            raise TimeoutError(f"The job timed out after {seconds} seconds.") from e
        raise
    finally:
        timer.cancel()
        context.removeJobTag(tag)


def run_job(
    spark: SparkSession, spec: JobSpec, source, out_dir: str, format: str = "parquet", native_types: bool = False
) -> JobResult:
    """One run: pull what is new, write it once, then its manifest, then the new state.

    Rows, highest watermark and NULL watermarks are observed in the write itself. A live source is
    asked for its highest watermark before it is read, so that rows which arrive meanwhile come with
    the next run. Folders are named by the run's number, so a repeated run replaces its own output.
    """
    if format != "parquet" and format not in MODES:
        raise JobError(f'Unknown output format "{format}".')
    base = f"{out_dir}/{spec.output}"
    with time_limit(spark, spec.timeout_s):
        state = read_state(spark, f"{base}/state")
        run = state.run + 1
        end_lsn, before = _state_before(spec, source, state)
        planned = plan(spec, source, state, end_lsn, base)
        if spec.exactly_once:  # what is written and what is remembered of it are to be the same rows
            planned = _pulled(spark, planned, f"{base}/pulled/run={run}")
        key = [k for k in spec.primary_key if k in planned.columns]
        rows, seen = checks.observed(planned, _shown_watermark(spec), key)
        data_path = f"{base}/data/run={run}"
        if format == "parquet":
            write_parquet(with_safe_names(rows), data_path)
        else:
            write_lines(rows, data_path, format)
        measured = seen.get
        count = measured.get("rows") or 0
        new = _state_after(spec, source, state, before, measured, run)
        if spec.watermark and not spec.exactly_once:
            incremental.check_progress(state.last_fetched_row, new.last_fetched_row, count, spec.limit)
        if measured.get("null_keys"):
            log.warning('%d rows of "%s" have a NULL in their primary key.', measured["null_keys"], spec.output)
        about = None if spec.query else source.about(spec.schema, spec.table)
        document = manifest(rows.schema, spec.output, spec.incremental, spec.primary_key, about, native_types)
        write_json(spark, document, f"{base}/manifest/run={run}")
        if count == 0:
            if not spec.query:
                remove(spark, data_path)
            log.warning('Query result set is empty. Exported "0" rows to "%s".', spec.output)
        if spec.exactly_once:
            write_boundary(spark, base, planned, spec.watermark, state, new)
        append_state(spark, f"{base}/state", new, count)
        if spec.exactly_once:
            remove(spark, f"{base}/pulled/run={run}")
    kept = data_path if count or spec.query else None
    return JobResult(
        spec.output,
        count,
        kept,
        f"{base}/manifest/run={run}",
        new,
        measured.get("null_watermarks") or 0,
        measured.get("null_keys") or 0,
    )


_BOUNDARY = "digest string, n long"


def _pulled(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """The same rows, read back from a table; under numbers, as parquet takes no odd names."""
    names = [f"c{i}" for i in range(len(rows.columns))]
    rows.toDF(*names).write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.toDF(*names).schema).parquet(path).toDF(*rows.columns)


def read_boundary(spark: SparkSession, base: str, state: State) -> DataFrame | None:
    """Digests of the rows at the state's watermark that the runs up to it have written."""
    return spark.read.schema(_BOUNDARY).parquet(f"{base}/boundary/run={state.run}") if state.run else None


def write_boundary(spark: SparkSession, base: str, rows: DataFrame, watermark: str, old: State, new: State) -> None:
    """Keeps them for the next run; where the watermark has not moved, those of the runs before are among them."""
    found = incremental.boundary(rows, watermark, new.last_fetched_row)
    if old.run and old.last_fetched_row == new.last_fetched_row:
        found = found.unionByName(read_boundary(spark, base, old)).groupBy("digest").agg(F.sum("n").alias("n"))
    found.write.mode("overwrite").parquet(f"{base}/boundary/run={new.run}")


def _shown_watermark(spec: JobSpec) -> str | None:
    """The watermark column, where the output holds it."""
    return spec.watermark if spec.watermark and (not spec.columns or spec.watermark in spec.columns) else None


def _state_before(spec: JobSpec, source, state: State) -> tuple:
    """Where the run's change range ends, and the state, as far as they are to be known before the scan starts.

    Both come from the log's last position in one look, so that what is committed meanwhile, or by a clock ahead of this
    one, is neither read nor passed over.
    """
    if spec.cdc:
        changes = source.changes(spec.schema, spec.table, spec.primary_key)
        since = cdc.time_literal(changes, state.last_fetched_time) if state.last_fetched_time else None
        return cdc.last_position(changes, since)
    if spec.watermark and not spec.limit and (source.live or not _shown_watermark(spec)):
        table = source.table(spec.schema, spec.table)
        field = incremental.watermark_field(table, spec.watermark)
        return None, table.agg(incremental.state_text(field, incremental.highest(field))).first()[0]
    return None, None


def _state_after(spec: JobSpec, source, state: State, before: str | None, measured: dict, run: int) -> State:
    if spec.cdc:
        return replace(state, run=run, last_fetched_time=before or state.last_fetched_time)
    if not spec.watermark:
        return replace(state, run=run)
    if spec.limit and not _shown_watermark(spec):
        raise JobError("A limited pull must output its watermark column.")
    highest = before if before is not None else measured.get("watermark")
    field = incremental.watermark_field(source.table(spec.schema, spec.table), spec.watermark)
    new = incremental.next_state(field, state.last_fetched_row, highest)
    return replace(state, run=run, last_fetched_row=new)


def run_jobs(spark: SparkSession, specs: list[JobSpec], source, out_dir: str, parallel: int = 4, **options) -> list[JobResult]:
    """All enabled jobs, some at a time, sharing the cluster fairly.

    A job that fails stops none of the others; once all have ended, a ``BatchError`` tells what failed and what did not.
    """
    enabled = [s for s in specs if s.enabled]
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "sluicegate")
    try:
        work = inheritable_thread_target(spark)(lambda s: run_job(spark, s, source, out_dir, **options))
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            ended = [(spec, pool.submit(work, spec)) for spec in enabled]
        failures = {spec.output: job.exception() for spec, job in ended if job.exception() is not None}
        results = [job.result() for _, job in ended if job.exception() is None]
        if failures:
            raise BatchError(results, failures) from next(iter(failures.values()))
        return results
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def table_counts(source, tables: list[tuple[str | None, str]]) -> DataFrame:
    """Row counts of several tables in one plan whose branches run side by side."""
    counts = [
        scan(source, schema, name).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for schema, name in tables
    ]
    result, *rest = counts
    for part in rest:
        result = result.unionByName(part)
    return result
