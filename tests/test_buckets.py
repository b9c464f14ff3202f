import os
import random

import pytest
from pyspark.sql import functions as F

from sluicegate.errors import JobError
from sluicegate.operators.cdc import ChangeLog
from sluicegate.sinks.buckets import BucketedTable
from sluicegate.streaming import pull


def files(path):
    return {os.path.join(d, n) for d, _, names in os.walk(f"{path}/data") for n in names if n.endswith(".parquet")}


def rows_of(table, *buckets):
    return {r.id: r.name for r in table.rows(*buckets).collect()}


@pytest.fixture
def table(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"v{i}") for i in range(200)], "id int, name string")
    return BucketedTable.create(rows, str(tmp_path / "t"), ["id"], 8)


def test_only_touched_buckets_are_written(spark, table):
    before = files(table.path)
    changes = spark.createDataFrame([(3, "new", 0), (5, None, 1), (900, "added", 0), (901, "x", 1)], "id long, name string, is_deleted int")
    touched = table.merge(changes)
    assert 1 <= len(touched) <= 4 and touched == table.touched(changes)
    after = files(table.path)
    assert before <= after  # untouched files keep their names and places
    assert {f.split("bucket=")[1].split("/")[0] for f in after - before} == {str(b) for b in touched}
    wanted = {i: f"v{i}" for i in range(200) if i != 5} | {3: "new", 900: "added"}
    assert rows_of(table) == wanted
    opened = BucketedTable.open(spark, table.path)
    assert (opened.keys, opened.buckets, opened.schema, rows_of(opened)) == (["id"], 8, table.schema, wanted)
    replaced = table.vacuum()
    assert len(replaced) == len(touched) and rows_of(table) == wanted and table.vacuum() == []


def test_buckets_read_are_those_touched(spark, table):
    read = table.rows([2, 5]).inputFiles()
    assert read and all("bucket=2/" in f or "bucket=5/" in f for f in read)
    assert {r[0] for r in table.rows([2]).select(table.bucket()).distinct().collect()} == {2}


def test_pulled_rows_without_a_flag(spark, table):
    table.merge(spark.createDataFrame([(1, "one"), (500, "more")], "id int, name string"))
    assert rows_of(table) == {i: f"v{i}" for i in range(200)} | {1: "one", 500: "more"}


def test_emptied_buckets_and_empty_changes(spark, table):
    gone = spark.createDataFrame([(i, None, 1) for i in range(200)], "id int, name string, is_deleted int")
    assert table.merge(gone.limit(0)) == [] and len(rows_of(table)) == 200
    assert len(table.merge(gone)) == 8 and rows_of(table) == {}
    table.merge(spark.createDataFrame([(7, "back")], "id int, name string"))
    assert rows_of(table) == {7: "back"}


def test_a_run_counts_once_and_a_dead_one_not_at_all(spark, table):
    first = spark.createDataFrame([(1, "first")], "id int, name string")
    # a merge that died after its data was written, before its index
    table._write(spark.createDataFrame([(1, "dead"), (2, "dead")], "id int, name string"), 1)
    assert rows_of(table)[1] == "v1"
    assert table.merge(first, run=1) and rows_of(table)[1] == "first" and rows_of(table)[2] == "v2"
    assert table.merge(spark.createDataFrame([(1, "again")], "id int, name string"), run=1) == []
    assert rows_of(table)[1] == "first"


def test_keys_of_several_columns_and_odd_names(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (None, "c", "z")], "`k 1` long, k2 string, `v.a` string")
    table = BucketedTable.create(rows, str(tmp_path / "t"), ["k 1", "k2"], 4)
    table.merge(spark.createDataFrame([(1, "b", "Y")], "`k 1` int, k2 string, `v.a` string"))
    assert sorted(tuple(r) for r in table.rows().where("`k 1` IS NOT NULL").collect()) == [(1, "a", "x"), (1, "b", "Y")]
    assert table.rows().count() == 3
    with pytest.raises(Exception, match="NULL in its key"):
        table.merge(spark.createDataFrame([(None, "b", "Y")], "`k 1` int, k2 string, `v.a` string"))
    with pytest.raises(JobError, match="already"):
        BucketedTable.create(rows, table.path, ["k2"], 4)
    with pytest.raises(JobError, match="no bucketed table"):
        BucketedTable.open(spark, str(tmp_path / "none"))
    with pytest.raises(JobError, match="of its own"):
        BucketedTable.create(rows.withColumn("bucket", F.lit(1)), str(tmp_path / "u"), ["k2"], 4)


@pytest.mark.parametrize("seed", range(2))
def test_many_merges_equal_a_dictionary(spark, table, seed):
    draw, wanted = random.Random(seed), {i: f"v{i}" for i in range(200)}
    for run in range(3):
        keys = draw.sample(range(260), 40)
        changes = [(k, f"r{run}-{k}", draw.choice([0, 0, 1])) for k in keys]
        table.merge(spark.createDataFrame(changes, "id int, name string, is_deleted int"))
        for k, name, deleted in changes:
            wanted.pop(k, None)
            if not deleted:
                wanted[k] = name
    assert rows_of(table) == wanted


def change_stream(spark, folder, rows, files):
    schema = "lsn long, id int, op int, name string"
    for i in range(files):
        part = spark.createDataFrame(rows[i::files], schema).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
        part.coalesce(1).write.mode("append").parquet(folder)
    full = spark.read.parquet(folder)
    return ChangeLog(full, ["id"]), pull.file_stream(spark, folder, full.schema, files_per_batch=1)


def test_late_changes_do_not_replace_newer_ones(spark, tmp_path):
    """Positions arrive out of order over several batches and two starts; deletes are not undone by older rows."""
    draw, rows = random.Random(8), []
    for lsn in range(90):
        rows.append((lsn, 1 if draw.random() < 0.4 else draw.randrange(8), draw.choice([1, 2, 3, 4, 4]), f"v{lsn}"))
    last = {}
    for lsn, key, op, name in sorted(rows):
        if op != 3:
            last[key] = None if op == 1 else name
    draw.shuffle(rows)
    empty = spark.createDataFrame([], "id int, name string")
    table = BucketedTable.create(empty, str(tmp_path / "t"), ["id"], 4)
    for part in (rows[:60], rows[60:]):
        log, stream = change_stream(spark, str(tmp_path / "in"), part, 2)
        pull.keep_current(stream, log, table, str(tmp_path / "cp")).awaitTermination()
    assert rows_of(table) == {k: v for k, v in last.items() if v is not None}
    assert max(run for run, _ in table.present().values()) == 4


def test_a_replayed_batch_is_not_merged_again(spark, tmp_path):
    table = BucketedTable.create(spark.createDataFrame([], "id int, name string"), str(tmp_path / "t"), ["id"], 4)
    log, stream = change_stream(spark, str(tmp_path / "in"), [(1, 7, 4, "a"), (2, 7, 4, "b"), (3, 8, 1, "c")], 1)
    for attempt in ("one", "two"):  # a lost checkpoint starts again at the first batch
        pull.keep_current(stream, log, table, str(tmp_path / attempt)).awaitTermination()
    assert rows_of(table) == {7: "b"}
    assert {run for run, _ in table.present().values()} <= {0, 1}
    plan = pull.newest_images(stream, log)._jdf.queryExecution().analyzed().toString()
    assert "max_by" in plan and "Python" not in plan
