"""Plans: what reaches the scan, how often rows move, and that hot keys are reduced before they do."""

import re

import pytest
from plans import physical, shuffles
from pyspark.sql import functions as F

from sluicegate.functions import text, types
from sluicegate.operators import cdc, checks, incremental, merge
from sluicegate.registered import QUERIES
from sluicegate.registered.base import table
from sluicegate.registered.changes import change_log
from sluicegate.sinks.columnar import save_bucketed
from sluicegate.sinks.lines import lines
from sluicegate.sources.tables import CatalogSource

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "name, column, state, pushed",
    [("orders", "o_orderkey", "40", "GreaterThanOrEqual(o_orderkey,40)"),
     ("orders", "o_orderdate", "1996-03-15 00:00:00", "GreaterThanOrEqual(o_orderdate,1996-03-15T00:00)"),
     ("events", "ts", "2024-01-10 00:00:00.123", "GreaterThanOrEqual(ts,2024-01-10T00:00:00.123)")],
)
def test_state_reaches_the_scan(spark, name, column, state, pushed):
    plan = physical(incremental.since(table(spark, SF, name), column, state).select(column))
    assert pushed in plan and "Exchange" not in plan
    assert re.search(rf"ReadSchema: struct<{column}:\w+>", plan)


def test_a_pull_without_a_limit_moves_and_sorts_nothing(spark):
    plan = physical(lines(incremental.since(table(spark, SF, "orders"), "o_orderkey", "40"), "selective"))
    assert "Exchange" not in plan and "Sort" not in plan and "*(1) Project" in plan


def test_small_limit_is_a_top_k(spark):
    plan = physical(incremental.first_rows(table(spark, SF, "orders"), "o_orderdate", 50, ["o_orderkey"]))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_large_limit_is_a_filter_on_the_scan(spark):
    orders = table(spark, SF, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    plan = physical(incremental.first_rows(orders, "o_orderdate", 700, ["o_orderkey"], heap_rows=100))
    assert "LessThan(o_orderdate," in plan and "TakeOrdered" not in plan


def test_net_changes_move_rows_once_and_reduce_them_before(spark):
    df = cdc.net_changes(change_log(spark, SF), 100, 900)
    plan = physical(df)
    assert shuffles(df) == 1 and "Window" not in plan
    assert plan.index("partial_max_by") > plan.index("Exchange")  # below the exchange
    assert "GreaterThanOrEqual(event_id,100)" in plan and "LessThanOrEqual(event_id,900)" in plan


def test_applying_changes_does_not_move_them_again(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = change_log(spark, SF)
        net = cdc.net_changes(log, 100, 900)
        base = spark.range(1000).select(F.col("id").alias("user_id"), F.lit(1.0).alias("value"), F.lit("x").alias("event_type"))
        plan = physical(merge.apply_changes(base, net, ["user_id"]))
        assert plan.count("Exchange hashpartitioning") == 2  # the base and the log, once each
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changes_are_merged_into_a_bucketed_table_without_moving_it(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = spark.range(1000).select(F.col("id").alias("user_id"), F.lit(1.0).alias("value"), F.lit("x").alias("event_type"))
        save_bucketed(base, "bucketed_users", ["user_id"], 8, path=str(tmp_path / "users"))
        net = cdc.net_changes(change_log(spark, SF), 100, 900)
        df = merge.apply_changes(spark.table("bucketed_users"), net, ["user_id"])
        assert physical(df).count("Exchange hashpartitioning") == 1  # the log, once
        assert CatalogSource(spark, catalog="spark_catalog").table("default", "bucketed_users").count() == 1000
        assert df.count() == 1000 - net.where("is_deleted = 1").count() + net.where("user_id >= 1000").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS bucketed_users")


def test_recent_positions_are_found_by_the_scan(spark):
    log = change_log(spark, SF)
    plan = physical(cdc.commit_time(log, F.lit("2024-01-20").cast("timestamp_ntz")))
    assert "GreaterThanOrEqual(ts,2024-01-20T00:00)" in plan


def test_bounds_read_two_columns_in_one_pass(spark):
    t = F.lit("2024-01-10").cast("timestamp_ntz")
    plan = physical(cdc.lsn_bounds(change_log(spark, SF), t, t))
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_newest_per_key_reduces_before_it_moves(spark):
    df = incremental.newest_per_key(table(spark, SF, "events"), ["user_id"], ["ts", "event_id"])
    assert shuffles(df) == 1 and "partial_max_by" in physical(df)


def test_reconcile_moves_both_sides_once(spark):
    orders = table(spark, SF, "orders")
    df = merge.reconcile(orders, orders.where("o_orderkey > 3"))
    assert shuffles(df) == 1 and "Join" not in physical(df) and "partial_sum" in physical(df)


def test_key_report_is_two_aggregations(spark):
    df = checks.key_report(table(spark, SF, "orders"), ["o_orderkey"])
    assert physical(df).count("Exchange hashpartitioning") == 1 and "Join" not in physical(df)


def test_row_version_watermark_is_a_constant(spark):
    df = types.with_source_types(
        table(spark, SF, "events").select(text.rowversion_bytes(F.col("event_id")).alias("v")), {"v": "timestamp"}
    )
    assert "0x00000000000007D0" in physical(incremental.since(df, "v", "0x7D0"))


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_cdc", "stream_incremental", "csv_roundtrip"}))
def test_no_python_workers_no_cross_joins_no_forced_broadcasts(spark, name):
    df = QUERIES[name](spark, SF)
    plan = physical(df)
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEval", "RDDScan"):
        assert word not in plan, (name, word)
    assert "hint" not in df._jdf.queryExecution().logical().toString().lower()
