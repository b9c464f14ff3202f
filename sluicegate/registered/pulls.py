"""Incremental pulls, limits, watermarks, and predicates over whole tables."""

from pyspark.sql import functions as F

from ..functions import text, types
from ..operators import checks, filters, incremental, merge
from ..session import scratch_dir
from ..sinks.columnar import write_parquet
from ..sources import zones
from .base import money, registered, table

DATE_STATE = "1996-03-15 00:00:00"
TIME_STATE = "2024-01-10 00:00:00.123"


@registered("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def incr_first_run(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return incremental.since(orders, "o_orderkey", None)


@registered("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderkey >= 440")
def incr_numeric(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return incremental.since(orders, "o_orderkey", "440")


@registered("""
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price FROM orders
WHERE CAST(o_totalprice AS DECIMAL(18,2)) >= 112946.26
""")
def incr_decimal(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", money("o_totalprice").alias("price"))
    return incremental.since(orders, "price", "112946.26").withColumn("price", F.col("price").cast("double"))


def versioned_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", text.rowversion_bytes(F.col("event_id")).alias("version"))
    return types.with_source_types(events, {"version": "timestamp"})


@registered("""
SELECT event_id, '0x' || lpad(upper(hex(event_id)), 16, '0') AS version FROM events WHERE event_id >= 255
""")
def incr_binary(spark, sf_dir):
    pulled = incremental.since(versioned_events(spark, sf_dir), "version", "0x0000FF")
    return pulled.select("event_id", text.rowversion_hex(F.col("version")).alias("version"))


@registered(f"SELECT event_id, ts, user_id, event_type FROM events WHERE ts >= TIMESTAMP '{TIME_STATE}'")
def incr_datetime(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return incremental.since(events, "ts", TIME_STATE)


@registered("""
SELECT event_id, date_trunc('minute', ts) AS minute FROM events
WHERE date_trunc('minute', ts) >= TIMESTAMP '2024-01-10 10:25:00'
""")
def incr_minute(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", text.minute_start(F.col("ts")).alias("minute"))
    typed = types.with_source_types(events, {"minute": "smalldatetime"})
    return incremental.since(typed, "minute", "2024-01-10 10:25:00")


@registered("""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST LIMIT 500
""")
def topn_incremental(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return incremental.first_rows(orders, "o_orderdate", 500, ["o_orderkey"])


@registered(f"""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '{DATE_STATE}'
ORDER BY o_orderdate ASC NULLS FIRST, o_orderkey ASC NULLS FIRST LIMIT 50
""")
def topn_with_state(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    pulled = incremental.since(orders, "o_orderdate", DATE_STATE)
    return incremental.first_rows(pulled, "o_orderdate", 50, ["o_orderkey"])


@registered("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate FROM lineitem
ORDER BY l_shipdate ASC NULLS FIRST, l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 20000
""")
def topn_large_limit(spark, sf_dir):
    """A limit above the heap's size, which is answered by a filter and not by one task."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate")
    order = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return incremental.first_rows(lines, "l_shipdate", 20_000, order, heap_rows=10_000)


@registered("SELECT max(o_orderdate) AS watermark FROM orders")
def watermark_max(spark, sf_dir):
    return incremental.watermark_max(table(spark, sf_dir, "orders"), "o_orderdate")


@registered("SELECT '0x' || lpad(upper(hex(max(event_id))), 16, '0') AS watermark FROM events")
def watermark_max_binary(spark, sf_dir):
    return incremental.watermark_max(versioned_events(spark, sf_dir), "version")


@registered("""
SELECT max(o_orderkey) AS watermark FROM (
  SELECT o_orderkey FROM orders WHERE o_orderkey >= 440 ORDER BY o_orderkey ASC NULLS FIRST LIMIT 1000) batch
""")
def watermark_batch(spark, sf_dir):
    pulled = incremental.since(table(spark, sf_dir, "orders"), "o_orderkey", "440")
    return incremental.watermark_max(incremental.first_rows(pulled, "o_orderkey", 1000), "o_orderkey")


@registered(f"""
SELECT max(ts) AS watermark FROM (
  SELECT ts FROM events WHERE ts >= TIMESTAMP '{TIME_STATE}' ORDER BY ts ASC NULLS FIRST, event_id LIMIT 700) batch
""")
def watermark_batch_ts(spark, sf_dir):
    pulled = incremental.since(table(spark, sf_dir, "events"), "ts", TIME_STATE)
    return incremental.watermark_max(incremental.first_rows(pulled, "ts", 700, ["event_id"]), "ts")


@registered("SELECT count(*) AS rows FROM lineitem")
def row_count(spark, sf_dir):
    return checks.row_count(table(spark, sf_dir, "lineitem"))


@registered("""
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) ranked
WHERE n = 1
""")
def dedupe_boundary(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return incremental.newest_per_key(events, ["user_id"], ["ts", "event_id"])


@registered("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment ILIKE 'mach%'")
def ci_like(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return customers.where(filters.like_any_case(F.col("c_mktsegment"), "mach%"))


@registered("""
SELECT l_partkey, l_suppkey, l_orderkey, l_quantity FROM lineitem
WHERE (l_partkey, l_suppkey) IN (SELECT (l_partkey, l_suppkey) FROM lineitem WHERE l_quantity = 50)
""")
def whitelist(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_quantity")
    return filters.keep_listed(lines, lines.where("l_quantity = 50"), ["l_partkey", "l_suppkey"])


@registered("""
SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment, nullif(c_nationkey, 3) AS nation
FROM customer WHERE c_acctbal > 0
""")
def null_safe_match(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
        F.nullif(F.col("c_nationkey"), F.lit(3)).alias("nation"),
        "c_acctbal",
    )
    exported = customers.where("c_acctbal > 0").withColumn("segment", F.coalesce("segment", F.lit("")))
    return filters.matching_rows(customers.drop("c_acctbal"), exported.drop("c_acctbal"))


NEWEST_PER_USER = """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events WHERE {}) r
WHERE n = 1"""


@registered(f"""
WITH base AS ({NEWEST_PER_USER.format("ts < TIMESTAMP '2024-01-29'")}),
arrived AS ({NEWEST_PER_USER.format("ts >= TIMESTAMP '2024-01-29'")})
SELECT * FROM base WHERE user_id NOT IN (SELECT user_id FROM arrived) UNION ALL SELECT * FROM arrived
""")
def merge_upsert(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    cut = F.lit("2024-01-29 00:00:00").cast("timestamp_ntz")
    base = incremental.newest_per_key(events.where(F.col("ts") < cut), ["user_id"], ["ts", "event_id"])
    arrived = incremental.newest_per_key(events.where(F.col("ts") >= cut), ["user_id"], ["ts", "event_id"])
    return merge.upsert(base, arrived, ["user_id"])


SQL_RECONCILE = """
WITH copy AS (
  SELECT c_custkey, CASE WHEN c_acctbal > 9000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
  FROM customer WHERE c_nationkey <> 3
  UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_nationkey = 4),
both_sides AS (
  SELECT c_custkey, c_mktsegment, 1 AS s, 0 AS c FROM customer
  UNION ALL SELECT c_custkey, c_mktsegment, 0, 1 FROM copy)
SELECT c_custkey, c_mktsegment, CAST(sum(s) AS BIGINT) AS in_source, CAST(sum(c) AS BIGINT) AS in_copy
FROM both_sides GROUP BY c_custkey, c_mktsegment HAVING sum(s) <> sum(c)
"""


@registered(SQL_RECONCILE)
def reconcile(spark, sf_dir):
    return merge.reconcile(*customers_and_copy(spark, sf_dir))


@registered(SQL_RECONCILE)
def reconcile_digests(spark, sf_dir):
    """The same rows, found by digests of key buckets first."""
    return merge.reconcile_by_digests(*customers_and_copy(spark, sf_dir), ["c_custkey"], 4_096)


def customers_and_copy(spark, sf_dir):
    """Customers, and a copy of them that lacks a nation, holds another twice and spells some segments otherwise."""
    customers = table(spark, sf_dir, "customer")
    source = customers.select("c_custkey", "c_mktsegment")
    changed = F.when(F.col("c_acctbal") > 9000, F.lower("c_mktsegment")).otherwise(F.col("c_mktsegment"))
    kept = customers.where("c_nationkey <> 3").select("c_custkey", changed.alias("c_mktsegment"))
    twice = customers.where("c_nationkey = 4").select("c_custkey", "c_mktsegment")
    return source, kept.unionByName(twice)


@registered("""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (WHERE k IS NULL), 0) AS BIGINT) AS null_keys,
       count(*) FILTER (WHERE k IS NOT NULL AND n > 1) AS repeated_keys
FROM (SELECT k, l_linenumber, count(*) AS n
      FROM (SELECT CASE WHEN l_quantity = 50 THEN NULL ELSE l_orderkey END AS k, l_linenumber FROM lineitem) keyed
      GROUP BY k, l_linenumber) counted
""")
def pk_check(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_quantity") == 50, None).otherwise(F.col("l_orderkey")).alias("k"), "l_linenumber"
    )
    return checks.key_report(lines, ["k", "l_linenumber"])


@registered(f"SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '{TIME_STATE}'")
def incr_zone_map(spark, sf_dir):
    """A pull from the files of a table whose zones can hold new rows."""
    folder = scratch_dir(spark, "zoned")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    write_parquet(events.repartitionByRange("ts"), f"{folder}/events", sort_by=["ts"])
    stored = spark.read.schema(events.schema).parquet(f"{folder}/events")
    return zones.since(spark, stored, f"{folder}/events", "ts", TIME_STATE, f"{folder}/zones")


@registered("""
WITH arrived AS (SELECT event_id, CAST(ts AS DATE) AS day, user_id, value,
                        1 + (3 * (event_id - min(event_id) OVER ())) // (1 + max(event_id) OVER () - min(event_id) OVER ()) AS run
                 FROM events),
states AS (SELECT r.run, max(day) AS state FROM (SELECT DISTINCT run FROM arrived) r JOIN arrived a ON a.run < r.run GROUP BY r.run)
SELECT a.run, event_id, day, user_id, value FROM arrived a LEFT JOIN states s ON a.run = s.run
WHERE s.state IS NULL OR day >= s.state
""")
def incr_exactly_once(spark, sf_dir):
    """Three pulls by day of a table that grows, each without the rows of the last day that were sent before."""
    events = table(spark, sf_dir, "events")
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    run = F.floor((3 * (F.col("event_id") - first)) / F.lit(last - first + 1)).cast("int") + 1
    grown = events.select(run.alias("run"), "event_id", F.col("ts").cast("date").alias("day"), "user_id", "value")
    state, sent, pulls, folder = None, None, [], scratch_dir(spark, "exactly-once")
    for number in (1, 2, 3):
        there = grown.where(F.col("run") <= number).drop("run")
        incremental.unsent(there, "day", state, sent).write.parquet(f"{folder}/run={number}")
        pulled = spark.read.schema(there.schema).parquet(f"{folder}/run={number}")
        pulls.append(pulled.select(F.lit(number).cast("long").alias("run"), "*"))
        field = incremental.watermark_field(there, "day")
        new = incremental.next_state(field, state, pulled.agg(incremental.state_text(field, incremental.highest(field))).first()[0])
        found = incremental.boundary(pulled, "day", new)
        sent, state = found if sent is None or new != state else found.unionByName(sent), new
    return pulls[0].unionByName(pulls[1]).unionByName(pulls[2])
