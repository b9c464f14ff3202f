import random

import pytest
from pyspark.errors import UnsupportedOperationException
from plans import physical
from pyspark.sql import functions as F

from sluicegate.errors import LsnRangeError
from sluicegate.operators import cdc, merge

SCHEMA = "lsn long, seq int, ts timestamp_ntz, op int, id int, name string"


def log_of(spark, changes):
    rows = [(lsn, seq, None, op, key, name) for lsn, seq, op, key, name in changes]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumn("ts", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, lsn)"))
    return cdc.ChangeLog(df, ["id"], sequence=["seq"])


def net(spark, changes, low, high):
    rows = cdc.net_changes(log_of(spark, changes), low, high).collect()
    return {r.id: (r.name, r.is_deleted) for r in rows}


def test_updates_of_a_key_come_out_as_one(spark):
    assert net(spark, [(1, 1, 4, 7, "a"), (2, 1, 4, 7, "b"), (3, 1, 4, 7, "c")], 1, 3) == {7: ("c", 0)}


def test_insert_and_delete_inside_the_range_vanish(spark):
    changes = [(1, 1, 2, 7, "a"), (2, 1, 4, 7, "b"), (3, 1, 1, 7, "b")]
    assert net(spark, changes, 1, 3) == {}
    assert net(spark, changes, 1, 2) == {7: ("b", 0)}
    assert net(spark, changes, 2, 3) == {7: ("b", 1)}


def test_delete_and_insert_count_as_an_update(spark):
    log = log_of(spark, [(1, 1, 1, 7, "a"), (2, 1, 2, 7, "b")])
    row = cdc.net_changes(log, 1, 2, with_log_columns=True).first()
    assert (row.op, row.is_deleted, row.name) == (4, 0, "b")


def test_order_inside_a_transaction_is_by_sequence(spark):
    assert net(spark, [(1, 2, 4, 7, "later"), (1, 1, 4, 7, "sooner")], 1, 1) == {7: ("later", 0)}


def test_row_before_an_update_is_no_change(spark):
    assert net(spark, [(1, 1, 3, 7, "old"), (1, 2, 4, 7, "new"), (2, 1, 3, 7, "new")], 1, 2) == {7: ("new", 0)}


def test_range_ends_are_included(spark):
    changes = [(lsn, 1, 4, lsn, "x") for lsn in range(1, 6)]
    assert sorted(net(spark, changes, 2, 4)) == [2, 3, 4]


def test_binary_positions(spark):
    rows = [(bytearray([0] * 9 + [n]), None, 4, 7, f"v{n}") for n in (1, 200, 90)]
    df = spark.createDataFrame(rows, "lsn binary, ts timestamp_ntz, op int, id int, name string")
    log = cdc.ChangeLog(df, ["id"])
    got = cdc.net_changes(log, bytes([0] * 9 + [1]), bytes([0] * 9 + [255])).collect()
    assert [(r.id, r.name) for r in got] == [(7, "v200")]


def by_hand(changes, low, high):
    last, first = {}, {}
    for lsn, seq, op, key, name in sorted(changes):
        if low <= lsn <= high and op != 3:
            first.setdefault(key, op)
            last[key] = (op, name)
    return {k: (name, int(op == 1)) for k, (op, name) in last.items() if not (first[k] == 2 and op == 1)}


@pytest.mark.parametrize("seed", range(6))
def test_net_changes_equal_a_replay(spark, seed):
    rng = random.Random(seed)
    changes, alive = [], set()
    for lsn in range(1, 200):
        key = 1 if rng.random() < 0.33 else rng.randrange(2, 12)
        if key in alive:
            op = rng.choice([1, 4, 4])
        else:
            op = 2
        alive = alive - {key} if op == 1 else alive | {key}
        if op == 4:
            changes.append((lsn, 1, 3, key, f"old{lsn}"))
        changes.append((lsn, 2, op, key, f"v{lsn}"))
    low, high = sorted(rng.sample(range(1, 200), 2))
    assert net(spark, changes, low, high) == by_hand(changes, low, high)

    def state_at(end):
        rows = {}
        for lsn, _, op, key, name in changes:
            if lsn <= end and op in (2, 4):
                rows[key] = name
            elif lsn <= end and op == 1:
                rows.pop(key, None)
        return rows

    base = spark.createDataFrame(list(state_at(low - 1).items()), "id int, name string")
    applied = merge.apply_changes(base, cdc.net_changes(log_of(spark, changes), low, high), ["id"])
    assert {r.id: r.name for r in applied.collect()} == state_at(high)


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def test_bounds_by_time(spark):
    log = log_of(spark, [(n, 1, 4, n, "x") for n in (10, 20, 30)])
    row = cdc.lsn_bounds(log, at("2024-01-01 00:00:11"), at("2024-01-01 00:00:25")).first()
    assert tuple(row) == (20, 20, 10, 30)
    assert cdc.first_lsn_since(log, at("2024-01-01 00:00:20")).first()[0] == 20
    assert cdc.last_lsn_until(log, at("2024-01-01 00:00:09")).first()[0] is None
    late = at("2024-01-02 00:00:00")
    assert cdc.lsn_bounds(log, late, late).first()[:2] == (10, 30)
    assert cdc.lsn_bounds(log, late, late, "empty").first()[:2] == (None, 30)


@pytest.mark.parametrize(
    "begin, end, bounds",
    [("11", "25", (20, 20)), ("10", "30", (10, 30)), ("25", "15", (30, 10)), ("31", "59", (10, 30)), ("00", "05", (10, None))],
)
def test_range_looks_at_the_recent_part_first(spark, begin, end, bounds):
    log = log_of(spark, [(n, 1, 4, n, "x") for n in (10, 20, 30)])
    begin, end = (at(f"2024-01-01 00:00:{s}") for s in (begin, end))
    assert cdc.range_between(log, begin, end) == bounds
    assert tuple(cdc.lsn_bounds(log, begin, end).first()[:2]) == bounds


def test_range_guard_and_full_load(spark):
    log = log_of(spark, [(n, 1, 4, n, "x") for n in (10, 20, 30)])
    table = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    args = (table, log, "2024-01-01 00:00:25", at("2024-01-01 00:00:15"))
    with pytest.raises(LsnRangeError, match="The end LSN is less than the start LSN."):
        cdc.changes_since(*args)
    loaded = cdc.changes_since(*args, full_load_fallback=True)
    assert sorted(tuple(r) for r in loaded.collect()) == [(1, "a", 0), (2, "b", 0)]


def test_first_load_has_no_flag_unless_asked_for(spark):
    log = log_of(spark, [(10, 1, 4, 1, "x")])
    table = spark.createDataFrame([(1, "a")], "id int, name string")
    assert cdc.changes_since(table, log, None, F.localtimestamp()).columns == ["id", "name"]
    assert cdc.changes_since(table, log, None, F.localtimestamp(), always_flag=True).columns == ["id", "name", "is_deleted"]


def test_state_is_the_time_of_the_last_position(spark):
    log = log_of(spark, [(n, 1, 4, n, "x") for n in (10, 30, 20)])
    assert str(cdc.commit_time(log).first()[0]) == "2024-01-01 00:00:30"
    assert str(cdc.commit_time(log, at("2024-01-01 00:00:20")).first()[0]) == "2024-01-01 00:00:30"
    assert cdc.commit_time(log, at("2024-01-01 00:00:31")).first()[0] is None


def test_positions_kept_beside_the_log(spark):
    log = log_of(spark, [(10, 1, 4, 1, "x")])
    positions = spark.createDataFrame([(10,), (99,)], "lsn long").withColumn("ts", at("2024-01-01 00:00:10"))
    beside = cdc.ChangeLog(log.df, ["id"], sequence=["seq"], positions=positions)
    assert cdc.lsn_bounds(beside, at("2024-01-01 00:00:00"), at("2024-01-02 00:00:00")).first()["max_lsn"] == 99


def test_upsert_replaces_by_key(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    for _ in range(2):  # a second time changes nothing
        base = merge.upsert(base, new, ["id"])
    assert sorted(tuple(r) for r in base.collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_merge_is_resolved_and_only_the_table_format_refuses_it(spark, tmp_path):
    base = spark.range(5).selectExpr("id", "id AS v")
    base.write.option("path", str(tmp_path / "t")).mode("overwrite").saveAsTable("merge_target")
    try:
        net = spark.range(3).selectExpr("id", "id * 10 AS v", "0 AS is_deleted")
        for rows in (net, net.drop("is_deleted")):
            with pytest.raises(UnsupportedOperationException, match="does not support MERGE INTO TABLE"):
                merge.merge_into("merge_target", rows, ["id"])
    finally:
        spark.sql("DROP TABLE IF EXISTS merge_target")


def test_reconcile_counts_both_sides(spark):
    source = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "id int, v string")
    copy = spark.createDataFrame([(1, "a"), (2, None), (4, "d")], "id int, v string")
    got = sorted(tuple(r) for r in merge.reconcile(source, copy).collect())
    assert got == [(1, "a", 2, 1), (3, "c", 1, 0), (4, "d", 0, 1)]


def test_merging_moves_and_reads_each_side_once(spark, tmp_path):
    spark.range(100).selectExpr("id AS k", "'old' AS v").write.parquet(f"{tmp_path}/base")
    spark.range(50, 150).selectExpr("id AS k", "'new' AS v", "int(id % 2) AS is_deleted").write.parquet(f"{tmp_path}/net")
    base, net = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("base", "net"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (merge.upsert(base, net.drop("is_deleted"), ["k"]), merge.apply_changes(base, net, ["k"])):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 2 and plan.count("FileScan") == 2
        rows = {r["k"]: r["v"] for r in merge.apply_changes(base, net, ["k"]).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == {k: "old" if k < 50 else "new" for k in range(150) if k < 50 or k % 2 == 0}


def test_new_rows_without_a_key_fail_the_merge(spark):
    base = spark.createDataFrame([(None, "n"), (1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b")], "k int, v string")
    assert sorted(map(str, merge.upsert(base, new, ["k"]).collect())) == ["Row(k=1, v='b')", "Row(k=None, v='n')"]
    with pytest.raises(Exception, match="NULL in its key"):
        merge.upsert(base, spark.createDataFrame([(None, "n2")], "k int, v string"), ["k"]).collect()


def test_state_of_instants_means_the_same_in_another_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        rows = spark.createDataFrame([(1, 4, 7, "a"), (2, 4, 8, "b"), (3, 4, 9, "c")], "lsn long, op int, id int, name string")
        first = F.lit("2024-01-01T06:00:00+09:00").cast("timestamp")
        df = rows.withColumn("ts", first + F.expr("make_dt_interval(0, 4 * CAST(lsn AS int))"))
        log = cdc.ChangeLog(df, ["id"])
        position, state = cdc.last_position(cdc.ChangeLog(df.where("lsn <= 1"), ["id"]))
        assert (position, state) == (1, "2024-01-01 01:00:00+00:00")
        for zone in ("Asia/Tokyo", "UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            due = log.df.where(F.col("ts") >= cdc.time_literal(log, state)).select("lsn").collect()
            assert sorted(r.lsn for r in due) == [1, 2, 3]
            assert cdc.last_position(log)[1] == "2024-01-01 09:00:00+00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_positions_around_many_times(spark):
    rng = random.Random(4)
    logs, asked = [], []
    for name in ("a", "b", None):
        seconds = sorted(rng.choices(range(0, 400_000, 500), k=60))
        logs += [(name, s, 10 * i) for i, s in enumerate(seconds)]
    asked = [(i, rng.choice(["a", "b", None, "none"]), rng.choice([None, -5, 10**6, *range(0, 400_000, 250)])) for i in range(300)]
    asked += asked[:3]

    def timed(rows, schema):
        df = spark.createDataFrame(rows, schema)
        return df.withColumn("ts", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")).drop("s")

    times = timed(logs, "log string, s int, lsn long")
    found = cdc.positions_at(times, timed(asked, "id int, log string, s int").withColumn("lsn", F.lit("own")), ["log"])
    wanted = []
    for i, log, s in asked:
        own = [(t, p) for n, t, p in logs if n == log and s is not None]
        wanted.append((i, max((p for t, p in own if t <= s), default=None), min((p for t, p in own if t >= s), default=None)))
    assert sorted(((r.id, r.last_until, r.first_since) for r in found.collect()), key=str) == sorted(wanted, key=str)
    assert found.columns == ["id", "log", "ts", "lsn", "last_until", "first_since"]
    none = cdc.positions_at(times.limit(0), timed([(1, "a", 5)], "id int, log string, s int"), ["log"]).collect()
    assert [tuple(r)[3:] for r in none] == [(None, None)]


def test_positions_around_times_compute_no_frame_anew_for_a_row(spark):
    """A frame that ends with its partition is computed anew for every row; 6 million times took beyond any limit."""
    at = F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, int(id))")
    day = spark.range(40).select(F.lit("a").alias("log"), at.alias("ts"), F.col("id").alias("lsn"))
    found = cdc.positions_at(day, day.select("log", "ts"), ["log"])
    assert "unboundedfollowing" not in physical(found)
    assert [(r.last_until, r.first_since) for r in found.orderBy("ts").collect()] == [(i, i) for i in range(40)]
