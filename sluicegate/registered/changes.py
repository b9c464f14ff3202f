"""Change data capture over the event table as a change log."""

from pyspark.sql import functions as F

from ..operators import cdc, incremental, merge
from ..session import scratch_dir
from ..sinks.buckets import BucketedTable
from ..streaming import pull
from .base import registered, table

BEGIN, END = "2024-01-08 12:00:00", "2024-01-25 06:00:00"

SQL_LOG = """
log AS (SELECT event_id AS lsn, ts, user_id, value, event_type,
               CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 ELSE 4 END AS op FROM events)"""

SQL_NET = f"""
{SQL_LOG},
bounds AS (SELECT coalesce(min(lsn) FILTER (WHERE ts >= TIMESTAMP '{BEGIN}'), min(lsn)) AS from_lsn,
                  max(lsn) FILTER (WHERE ts <= TIMESTAMP '{END}') AS to_lsn FROM log),
ranked AS (SELECT log.*, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n,
                  first_value(op) OVER (PARTITION BY user_id ORDER BY lsn) AS first_op
           FROM log, bounds WHERE lsn BETWEEN from_lsn AND to_lsn),
net AS (SELECT user_id, value, event_type, lsn,
               CASE WHEN op = 1 THEN 1 WHEN first_op = 2 THEN 2 ELSE 4 END AS op, ts,
               CASE WHEN op = 1 THEN 1 ELSE 0 END AS is_deleted
        FROM ranked WHERE n = 1 AND NOT (first_op = 2 AND op = 1))"""


def time(value: str):
    return F.lit(value).cast("timestamp_ntz")


def change_log(spark, sf_dir) -> cdc.ChangeLog:
    op = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "signup", 2).otherwise(4)
    events = table(spark, sf_dir, "events")
    log = events.select(F.col("event_id").alias("lsn"), "ts", "user_id", "value", "event_type", op.alias("op"))
    return cdc.ChangeLog(log, ["user_id"])


def range_in_time(log: cdc.ChangeLog):
    return cdc.range_between(log, time(BEGIN), time(END))


@registered(f"SELECT min(event_id) AS lsn FROM events WHERE ts >= TIMESTAMP '{BEGIN}'")
def cdc_lsn_ge(spark, sf_dir):
    return cdc.first_lsn_since(change_log(spark, sf_dir), time(BEGIN))


@registered(f"SELECT max(event_id) AS lsn FROM events WHERE ts <= TIMESTAMP '{END}'")
def cdc_lsn_le(spark, sf_dir):
    return cdc.last_lsn_until(change_log(spark, sf_dir), time(END))


@registered("""
SELECT 'changed' AS case, coalesce(min(event_id) FILTER (WHERE ts >= TIMESTAMP '2024-01-08 12:00:00'), min(event_id)) AS from_lsn,
       max(event_id) FILTER (WHERE ts <= TIMESTAMP '2024-01-25 06:00:00') AS to_lsn,
       min(event_id) AS min_lsn, max(event_id) AS max_lsn FROM events
UNION ALL
SELECT 'unchanged', coalesce(min(event_id) FILTER (WHERE ts >= TIMESTAMP '2030-01-01'), min(event_id)),
       max(event_id) FILTER (WHERE ts <= TIMESTAMP '2030-01-02'), min(event_id), max(event_id) FROM events
""")
def cdc_bounds(spark, sf_dir):
    log = change_log(spark, sf_dir)
    changed = cdc.lsn_bounds(log, time(BEGIN), time(END)).select(F.lit("changed").alias("case"), "*")
    unchanged = cdc.lsn_bounds(log, time("2030-01-01 00:00:00"), time("2030-01-02 00:00:00"))
    return changed.unionByName(unchanged.select(F.lit("unchanged").alias("case"), "*"))


@registered(f"WITH {SQL_NET} SELECT * FROM net")
def cdc_net_changes(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return cdc.net_changes(log, *range_in_time(log), with_log_columns=True)


@registered(f"""
WITH {SQL_LOG} SELECT * FROM log
WHERE lsn >= (SELECT min(lsn) FROM log WHERE ts >= TIMESTAMP '{BEGIN}')
  AND lsn <= (SELECT max(lsn) FROM log WHERE ts <= TIMESTAMP '{END}')
""")
def cdc_all_changes(spark, sf_dir):
    log = change_log(spark, sf_dir)
    return cdc.all_changes(log, *range_in_time(log))


@registered(f"""
WITH {SQL_NET},
base AS (SELECT user_id, value, event_type FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM log, bounds
           WHERE lsn < from_lsn) r WHERE n = 1 AND op <> 1)
SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM net)
UNION ALL SELECT user_id, value, event_type FROM net WHERE is_deleted = 0
""")
def cdc_apply(spark, sf_dir):
    log = change_log(spark, sf_dir)
    from_lsn, to_lsn = range_in_time(log)
    before = incremental.newest_per_key(log.df.where(F.col("lsn") < from_lsn), ["user_id"], ["lsn"])
    base = before.where("op <> 1").select("user_id", "value", "event_type")
    return merge.apply_changes(base, cdc.net_changes(log, from_lsn, to_lsn), ["user_id"])


@registered(f"""
WITH {SQL_LOG}
SELECT user_id, value, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM log) r
WHERE n = 1 AND op <> 1
""")
def cdc_runs(spark, sf_dir):
    """A snapshot and three runs after it, each from the position where the one before ended."""
    log = change_log(spark, sf_dir)
    first, last = log.df.agg(F.min("lsn"), F.max("lsn")).first()
    ends = [first + (last - first) * i // 4 for i in range(1, 5)]
    images = incremental.newest_per_key(log.df.where(F.col("lsn") <= ends[0]), ["user_id"], ["lsn"])
    target = images.where("op <> 1").select("user_id", "value", "event_type")
    for begin, end in zip(ends, ends[1:]):
        target = merge.apply_changes(target, cdc.net_changes(log, begin, end, keep_vanished=True), ["user_id"])
    return target


@registered(f"""
WITH {SQL_NET},
base AS (SELECT user_id, value, event_type FROM (
           SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM log, bounds
           WHERE lsn < from_lsn) r WHERE n = 1 AND op <> 1)
SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM net)
UNION ALL SELECT user_id, value, event_type FROM net WHERE is_deleted = 0
""")
def merge_touched(spark, sf_dir):
    """Changes merged into a stored table, of which only the buckets they fall into are written anew."""
    log = change_log(spark, sf_dir)
    from_lsn, to_lsn = range_in_time(log)
    before = incremental.newest_per_key(log.df.where(F.col("lsn") < from_lsn), ["user_id"], ["lsn"])
    base = before.where("op <> 1").select("user_id", "value", "event_type")
    target = BucketedTable.create(base, scratch_dir(spark, "merge-touched"), ["user_id"], 32)
    target.merge(cdc.net_changes(log, from_lsn, to_lsn))
    return target.rows()


@registered("SELECT o_orderkey, o_orderstatus, o_totalprice, 0 AS is_deleted FROM orders")
def cdc_full_load(spark, sf_dir):
    """A range that ends before it starts, with the full load allowed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    log = change_log(spark, sf_dir)
    return cdc.changes_since(orders, log, "2024-01-20 00:00:00", time("2024-01-10 00:00:00"), full_load_fallback=True)


@registered("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def cdc_first_load(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return cdc.changes_since(orders, change_log(spark, sf_dir), None, F.localtimestamp())


@registered("SELECT max_by(ts, event_id) AS last_fetched_time FROM events")
def cdc_state(spark, sf_dir):
    return cdc.commit_time(change_log(spark, sf_dir))


@registered("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_incremental(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    out = scratch_dir(spark, "stream-incremental")
    stream = pull.table_stream(spark, f"{sf_dir}/events.parquet", schema)
    pull.pull_new(stream, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(schema).parquet(f"{out}/data")


@registered(f"""
WITH {SQL_LOG}
SELECT user_id, value, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM log) r
WHERE n = 1 AND op <> 1
""")
def stream_cdc(spark, sf_dir):
    log = change_log(spark, sf_dir)
    out = scratch_dir(spark, "stream-cdc")
    stream = pull.table_stream(spark, f"{sf_dir}/events.parquet", table(spark, sf_dir, "events").schema)
    op = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "signup", 2).otherwise(4)
    changes = stream.select(F.col("event_id").alias("lsn"), "ts", "user_id", "value", "event_type", op.alias("op"))
    pull.apply_changes(changes, log, f"{out}/kept", f"{out}/checkpoint").awaitTermination()
    return pull.current_rows(spark.read.parquet(f"{out}/kept"), log)


@registered(f"""
WITH {SQL_LOG}
SELECT user_id, value, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC) AS n FROM log) r
WHERE n = 1 AND op <> 1
""")
def stream_current(spark, sf_dir):
    """A bucketed table kept at the state of a change stream, whose newest images are held in a state store."""
    log = change_log(spark, sf_dir)
    out = scratch_dir(spark, "stream-current")
    stream = pull.table_stream(spark, f"{sf_dir}/events.parquet", table(spark, sf_dir, "events").schema)
    op = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "signup", 2).otherwise(4)
    changes = stream.select(F.col("event_id").alias("lsn"), "ts", "user_id", "value", "event_type", op.alias("op"))
    empty = log.df.limit(0).select(*log.payload)
    target = BucketedTable.create(empty, f"{out}/table", log.keys, 16)
    pull.keep_current(changes, log, target, f"{out}/checkpoint").awaitTermination()
    return target.rows()


@registered("""
WITH times AS (SELECT event_type AS log, ts, max(event_id) AS high, min(event_id) AS low FROM events GROUP BY event_type, ts),
asked AS (SELECT event_id, event_type AS log, ts + INTERVAL 90 MINUTE AS ts FROM events),
until_ AS (SELECT a.event_id, a.log, a.ts, t.high FROM asked a ASOF LEFT JOIN times t ON a.log = t.log AND a.ts >= t.ts)
SELECT u.event_id, u.log, u.ts, u.high AS last_until, t.low AS first_since
FROM until_ u ASOF LEFT JOIN times t ON u.log = t.log AND u.ts <= t.ts
""")
def cdc_positions_at(spark, sf_dir):
    """Positions around the times 90 minutes after every event, in one log for each event type."""
    events = table(spark, sf_dir, "events").select(F.col("event_type").alias("log"), "ts", F.col("event_id").alias("lsn"))
    later = F.col("ts") + F.expr("INTERVAL '90' MINUTE")
    asked = events.select(F.col("lsn").alias("event_id"), "log", later.alias("ts"))
    return cdc.positions_at(events, asked, ["log"])
