"""Scans of tables, views and files, and users' own queries."""

from pyspark.sql import functions as F

from ..plans.job import table_counts
from ..session import scratch_dir
from ..sinks.lines import write_lines
from ..sources.delimited import read_records
from ..sources.jdbc import even_bounds, range_of
from ..sources.tables import CatalogSource, FolderSource, register_views, run_query, scan
from .base import registered, table


@registered("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_table(spark, sf_dir):
    return scan(FolderSource(spark, sf_dir), None, "customer", read_uncommitted=True)


@registered("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_size >= 10")
def scan_view(spark, sf_dir):
    table(spark, sf_dir, "part").where("p_size >= 10").createOrReplaceTempView("part_from_size_10")
    return scan(CatalogSource(spark), None, "part_from_size_10", ["p_partkey", "p_name", "p_retailprice"])


@registered("""
WITH ends AS (SELECT min(l_orderkey) AS low, max(l_orderkey) AS high FROM lineitem),
cuts AS (SELECT low + ((high - low) * i) // 8 AS cut FROM ends, range(1, 8) AS r(i)),
placed AS (SELECT l_orderkey, CAST((SELECT count(*) FROM cuts WHERE cut < l_orderkey) AS INTEGER) AS range_no FROM lineitem)
SELECT range_no, count(*) AS rows, min(l_orderkey) AS low, max(l_orderkey) AS high FROM placed GROUP BY range_no
""")
def bulk_scan_ranges(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey")
    low, high = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    placed = lines.withColumn("range_no", range_of("l_orderkey", even_bounds(low, high, 8)))
    return placed.groupBy("range_no").agg(
        F.count(F.lit(1)).alias("rows"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high")
    )


@registered("""
SELECT 'customer' AS "table", count(*) AS rows FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events
""")
def batch_counts(spark, sf_dir):
    names = ["customer", "orders", "lineitem", "events"]
    return table_counts(FolderSource(spark, sf_dir), [(None, n) for n in names])


@registered("""
SELECT CAST(doc_id AS VARCHAR) AS c1, text AS c2, nullif(lang, 'fr') AS c3,
       CASE WHEN source = 'src1' THEN '' ELSE source END AS c4, CAST(n_chars AS VARCHAR) AS c5
FROM documents
""")
def csv_roundtrip(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(
        "doc_id",
        "text",
        F.nullif(F.col("lang"), F.lit("fr")).alias("lang"),
        F.when(F.col("source") == "src1", "").otherwise(F.col("source")).alias("source"),
        "n_chars",
    )
    path = scratch_dir(spark, "csv-roundtrip")
    write_lines(documents, path, "null_aware")
    return read_records(spark, path, 5).select("c1", "c2", "c3", "c4", "c5")


QUERY_FILTER = "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_name <> 'it''s'"


@registered(QUERY_FILTER)
def query_filter(spark, sf_dir):
    register_views(spark, sf_dir, ["customer"])
    return run_query(spark, QUERY_FILTER)


QUERY_JOIN_AGG = """
SELECT n.n_name, c.c_mktsegment, count(*) AS orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
       max(o.o_orderdate) AS last_order
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
GROUP BY n.n_name, c.c_mktsegment
"""


@registered(QUERY_JOIN_AGG)
def query_join_agg(spark, sf_dir):
    register_views(spark, sf_dir, ["orders", "customer", "nation"])
    return run_query(spark, QUERY_JOIN_AGG)


QUERY_WINDOW = """
SELECT o_custkey, o_orderkey, o_totalprice, place FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS INT) AS place
  FROM orders) ranked
WHERE place <= 3
"""


@registered(QUERY_WINDOW)
def query_window(spark, sf_dir):
    register_views(spark, sf_dir, ["orders"])
    return run_query(spark, QUERY_WINDOW)


QUERY_SETOPS = """
SELECT 'active' AS kind, k FROM (SELECT o_custkey AS k FROM orders INTERSECT SELECT c_custkey FROM customer) a
UNION ALL
SELECT 'idle' AS kind, k FROM (SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders) b
UNION ALL
SELECT 'supplier' AS kind, k FROM (SELECT s_suppkey AS k FROM supplier EXCEPT ALL SELECT l_suppkey FROM lineitem) c
"""


@registered(QUERY_SETOPS)
def query_setops(spark, sf_dir):
    register_views(spark, sf_dir, ["orders", "customer", "supplier", "lineitem"])
    return run_query(spark, QUERY_SETOPS)


QUERY_ROLLUP = """
SELECT l_returnflag, l_linestatus, count(*) AS rows, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity
FROM lineitem
GROUP BY ROLLUP (l_returnflag, l_linestatus)
"""


@registered(QUERY_ROLLUP)
def query_rollup(spark, sf_dir):
    register_views(spark, sf_dir, ["lineitem"])
    return run_query(spark, QUERY_ROLLUP)


QUERY_SEMI_ANTI = """
SELECT 'with' AS kind, c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
UNION ALL
SELECT 'without' AS kind, c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
"""


@registered(QUERY_SEMI_ANTI)
def query_semi_anti(spark, sf_dir):
    register_views(spark, sf_dir, ["customer", "orders"])
    return run_query(spark, QUERY_SEMI_ANTI)


@registered("""
SELECT least(count(*), 5) AS n_rows, least(count(*), 5) AS n_fitting FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def query_any_n(spark, sf_dir):
    """Which rows a limit without an order returns is open; how many they are and that they fit is not."""
    register_views(spark, sf_dir, ["customer"])
    rows = run_query(spark, "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'MACHINERY' LIMIT 5;")
    return rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col("c_mktsegment") == "MACHINERY").alias("n_fitting"))
