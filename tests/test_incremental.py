import random

import fixtures
import pytest
from pyspark.sql import functions as F

from sluicegate.errors import JobError, StuckWatermarkError
from sluicegate.operators import incremental


def highest(df, column):
    return df.agg(incremental.state_text(df.schema[column], F.max(f"`{column}`"))).first()[0]


@pytest.mark.parametrize(
    "column, state, rows, new_state",
    [("_Weir%d I-D", None, 6, "6"), ("_Weir%d I-D", "4", 3, "6"), ("someDecimal", "4.40", 3, "6.60"),
     ("smalldatetime", "2012-01-10 10:10:00", 4, "2012-01-10 10:25:00"),
     ("datetime", "2021-01-05 13:43:27.123", 1, "2021-01-05 13:43:27.123"), ("someInteger", "7", 0, None)],
)
def test_pull_since_state(spark, column, state, rows, new_state):
    pulled = incremental.since(fixtures.numbered(spark), column, state)
    assert pulled.count() == rows
    assert highest(pulled, column) == new_state


@pytest.mark.parametrize("state, limit, ids, new_state", [(None, 2, [1, 2], "2"), ("2", 2, [2, 3], "3")])
def test_limited_pull(spark, state, limit, ids, new_state):
    pulled = incremental.since(fixtures.numbered(spark), "_Weir%d I-D", state)
    pulled = incremental.first_rows(pulled, "_Weir%d I-D", limit)
    assert sorted(r[0] for r in pulled.collect()) == ids
    assert highest(pulled, "_Weir%d I-D") == new_state


@pytest.mark.parametrize("state, rows", [(None, 3), ("0x000000000000000", 3), ("0x7D2", 2), ("0x0000FFFFFFFFFFFF", 0)])
def test_row_version_watermark(spark, state, rows):
    assert incremental.since(fixtures.versioned(spark), "timestamp", state).count() == rows


def test_null_watermarks_come_on_the_first_run_only(spark):
    df = fixtures.nullable(spark)
    assert incremental.since(df, "datetime1", None).count() == 3
    assert incremental.since(df, "datetime1", "2021-01-05 13:43:11.000").count() == 2
    assert incremental.first_rows(df, "datetime1", 1).first()["id"] is None


def test_unfit_watermark_columns_are_told_apart(spark):
    df = fixtures.numbered(spark)
    with pytest.raises(JobError, match='"fakeCol" specified for incremental fetching was not found'):
        incremental.since(df, "fakeCol", None)
    with pytest.raises(JobError, match='"type" specified for incremental fetching is not numeric or datetime'):
        incremental.since(df, "type", "1")


@pytest.mark.parametrize(
    "kind, stored, text",
    [("int", "7", "7"), ("decimal(10,2)", "6.6", "6.60"), ("timestamp_ntz", "2021-01-05 13:43:27.123", None),
     ("timestamp_ntz", "2012-01-10 10:25:00", None), ("timestamp", "2012-01-10 10:25:00.000001", "2012-01-10 10:25:00.000001+00:00"), ("date", "2020-02-01", None),
     ("double", "12345678.5", "1.23456785E7")],
)
def test_state_text_and_back(spark, kind, stored, text):
    df = spark.createDataFrame([(stored,)], "s string").select(F.col("s").cast(kind).alias("w"))
    shown = df.select(incremental.state_text(df.schema["w"], F.col("w"))).first()[0]
    assert shown == (text or stored)
    assert incremental.since(df, "w", shown).count() == 1


def test_state_text_of_row_versions(spark):
    df = fixtures.versioned(spark)
    assert highest(df, "timestamp") == "0x00000000000007D3"


def test_state_never_moves_back(spark):
    fields = {f.name: f for f in fixtures.numbered(spark).schema.fields}
    for column, low, high in (
        ("_Weir%d I-D", "9", "10"), ("datetime", "2021-01-05 13:43:27", "2021-01-05 13:43:27.12"), ("someDecimal", "9.99", "10.00"),
    ):
        assert incremental.next_state(fields[column], high, low) == high
        assert incremental.next_state(fields[column], low, high) == high
        assert incremental.next_state(fields[column], None, low) == low
        assert incremental.next_state(fields[column], low, None) == low
    version = fixtures.versioned(spark).schema["timestamp"]
    assert incremental.next_state(version, "0x7D1", "0x00000000000007D3") == "0x00000000000007D3"
    assert incremental.next_state(version, "0x000000000000000", "0x0000000000000001") == "0x0000000000000001"


def test_empty_table_has_no_watermark(spark):
    assert incremental.watermark_max(fixtures.numbered(spark).where("false"), "datetime").first()[0] is None


def test_full_batch_without_progress_is_an_error():
    with pytest.raises(StuckWatermarkError):
        incremental.check_progress("5", "5", 10, 10)
    incremental.check_progress("5", "5", 9, 10)
    incremental.check_progress(None, "5", 10, 10)


def order_rows(seed, n, hot):
    """Rows of which a third may share one watermark, with NULLs and copies of whole rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        wm = None if rng.random() < 0.05 else 50 if hot and rng.random() < 0.4 else rng.randrange(100)
        rows.append((i, wm, rng.choice("abc")))
    return rows


@pytest.mark.parametrize("n", [1, 7, 150, 333, 399, 400, 1000])
@pytest.mark.parametrize("hot", [False, True])
def test_limit_above_the_heap_gives_the_same_rows(spark, n, hot):
    rows = order_rows(n, 400, hot)
    df = spark.createDataFrame(rows, "id int, wm int, kind string").repartition(5)
    got = incremental.first_rows(df, "wm", n, ["id"], heap_rows=1 if n < 20 else 40)
    wanted = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))[:n]
    assert sorted(tuple(r) for r in got.collect() if r.wm is not None) == sorted(r for r in wanted if r[1] is not None)
    assert got.count() == len(wanted)


def test_limit_above_the_heap_without_a_key(spark):
    rows = [(5, "same")] * 300 + [(i, f"r{i}") for i in range(100)]
    df = spark.createDataFrame(rows, "wm int, t string").repartition(6)
    for n in (3, 120, 305, 350):
        got = [tuple(r) for r in incremental.first_rows(df, "wm", n, heap_rows=2).collect()]
        assert sorted(r[0] for r in got) == sorted(r[0] for r in rows)[:n]
        assert len(got) == n and all(got.count(r) <= rows.count(r) for r in set(got))


def test_newest_per_key_with_a_hot_key(spark):
    rows = [(1 if i % 3 else i, i, f"v{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, wm int, v string").repartition(7)
    got = {r.k: (r.wm, r.v) for r in incremental.newest_per_key(df, ["k"], ["wm"]).collect()}
    assert got == {k: (wm, v) for k, wm, v in rows}


@pytest.mark.parametrize("n", [1, 7, 40, 99, 100, 150])
def test_both_ways_of_a_limit_take_the_same_rows(spark, n):
    rows = [(i % 3 or None, f"v{i % 20}") for i in range(100)] + [(2, "copy")] * 5
    df = spark.createDataFrame(rows, "w int, v string")
    small, large = (incremental.first_rows(df, "w", n, heap_rows=h) for h in (1000, 3))
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect())) and small.count() == min(n, 105)


def test_one_partition_is_no_dead_end(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        df = spark.range(50).selectExpr("id AS w")
        assert sorted(r.w for r in incremental.first_rows(df, "w", 20, ["w"], heap_rows=3).collect()) == list(range(20))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("micros", [1_698_541_200_000_000, 1_698_544_800_000_000, 1_698_544_800_000_001])
def test_instants_mean_the_same_in_every_zone(spark, micros):
    """02:00 and 03:00 in Berlin are one wall time when the clocks go back."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        df = spark.range(1).select(F.timestamp_micros(F.lit(micros)).alias("w"))
        shown = df.select(incremental.state_text(df.schema["w"], F.col("w"))).first()[0]
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        either_side = spark.range(3).select(F.timestamp_micros(F.lit(micros) + F.col("id") - 1).alias("w"))
        kept = incremental.since(either_side, "w", shown).select(F.unix_micros("w")).collect()
        assert sorted(r[0] for r in kept) == [micros, micros + 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_nan_is_no_highest_watermark(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,), (0.5,)], "x double")
    assert incremental.watermark_max(df, "x").collect() == [(1.5,)]
    assert incremental.watermark_max(df.where("isnan(x)"), "x").collect() == [(None,)]
