"""Headline queries, timed: one warm-up, then the median of three runs. Prints one JSON line.

``BENCH_SF_DIR`` names the tables' folder and ``BENCH_CPUS`` the number of cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, functions as F

from sluicegate.operators import catalog
from sluicegate.registered import QUERIES
from sluicegate.registered.base import money, table
from sluicegate.session import build_session, scratch_dir
from sluicegate.sinks.lines import write_lines

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

REGISTERED = (
    "query_join_agg", "query_window", "query_rollup", "scan_table", "bulk_scan_ranges", "incr_numeric", "incr_datetime",
    "topn_incremental", "topn_with_state", "topn_large_limit", "watermark_max", "row_count", "dedupe_boundary", "cdc_bounds",
    "cdc_net_changes", "cdc_apply", "merge_upsert", "reconcile", "null_safe_match", "project_selective", "enclose_string",
    "lines_null_aware", "csv_roundtrip", "bad_rows", "pk_check", "sink_parquet", "catalog_columns", "catalog_constraints",
    "stream_incremental", "stream_cdc",
)


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def export_lineitem(spark, sf_dir: str) -> None:
    """Every lineitem as a delimited line, written to files."""
    prices = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    rows = table(spark, sf_dir, "lineitem").withColumns({c: money(c) for c in prices})
    write_lines(rows, scratch_dir(spark, "bench-lines"), "selective")


def big_catalog(spark) -> catalog.Snapshot:
    """5 schemas of 100 tables of 51 columns."""
    tables = spark.range(500).select(
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("schema"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("table"),
    )
    columns = tables.select("*", F.explode(F.sequence(F.lit(1), F.lit(51))).alias("ordinal")).select(
        "schema", "table", F.concat(F.lit("c"), F.col("ordinal").cast("string")).alias("column"), "ordinal",
        F.lit("varchar").alias("data_type"), F.lit(True).alias("nullable"), F.lit(0).alias("precision"),
        F.lit(0).alias("scale"), F.lit(50).alias("char_length"), (F.col("ordinal") == 1).alias("is_identity"),
    )
    key = tables.select("*", F.lit(1).alias("index_id"))
    return catalog.Snapshot(
        tables=tables.select(F.lit("test").alias("catalog"), "*", F.lit("BASE TABLE").alias("type")),
        objects=tables.select("*", F.lit("U").alias("kind"), F.lit(False).alias("is_system")),
        cdc_tables=tables.select("*", F.lit(False).alias("is_tracked")),
        columns=columns,
        indexes=key.select("*", F.lit("pk").alias("index_name"), F.lit(True).alias("is_primary")),
        index_columns=key.select("*", F.lit(1).alias("ordinal")),
        constraints=None,
        key_usage=None,
        references=None,
    )


def list_big_catalog(spark, sf_dir: str) -> None:
    consume(catalog.nested(big_catalog(spark)))


def timed(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        begun = time.perf_counter()
        run()
        times.append(time.perf_counter() - begun)
    return round(statistics.median(times), 4)


def main() -> None:
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    results = {
        "export_lineitem": timed(lambda: export_lineitem(spark, SF_DIR)),
        "catalog_500_tables": timed(lambda: list_big_catalog(spark, SF_DIR)),
    }
    for name in REGISTERED:
        results[name] = timed(lambda: consume(QUERIES[name](spark, SF_DIR)))
    spark.stop()
    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": results, "sf": SF_DIR}))


if __name__ == "__main__":
    main()
