import os

import pytest
from pyspark.sql import functions as F

from sluicegate.errors import JobError
from sluicegate.plans.job import run_job
from sluicegate.sources import zones
from sluicegate.sources.tables import FolderSource
from sluicegate.spec import JobSpec


def add_file(spark, folder, rows, schema="id long, at double, name string"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folder(spark, tmp_path):
    path = str(tmp_path / "a b%20c" / "t.parquet")  # names that are written otherwise in URIs
    for low in (0, 10, 20, 30):
        add_file(spark, path, [(low + i, float(low + i), f"n{i}") for i in range(10)])
    add_file(spark, path, [(900, float("nan"), "nan"), (901, None, "null")])
    return path


def pull(spark, path, state, zone_path):
    return zones.since(spark, spark.read.parquet(path), path, "at", state, zone_path)


def test_only_files_with_new_rows_are_opened(spark, folder, tmp_path):
    rows = pull(spark, folder, "25", str(tmp_path / "z"))
    assert len(rows.inputFiles()) == 2 and sorted(r.id for r in rows.collect() if r.id < 900) == list(range(25, 40))
    none = pull(spark, folder, "500", str(tmp_path / "z"))
    assert none.inputFiles() == [] and none.count() == 0 and none.columns == ["id", "at", "name"]


def test_new_and_replaced_files_are_measured_once(spark, folder, tmp_path, monkeypatch):
    asked = []
    load = zones._load
    monkeypatch.setattr(zones, "_load", lambda s, t, f, paths: asked.append(len(paths)) or load(s, t, f, paths))
    where = str(tmp_path / "z")
    assert pull(spark, folder, "35", where).count() == 5 and asked == [5, 1]  # all are measured, one is read
    assert pull(spark, folder, "35", where).count() == 5 and asked[2:] == [1]
    add_file(spark, folder, [(50, 50.0, "more")])
    assert pull(spark, folder, "35", where).count() == 6 and asked[3:] == [1, 2]
    found = zones.read_zones(spark, where).where("high = 19").select("file", "rows", "nulls", "low").first()
    assert found["rows"] == 10 and found["nulls"] == 0 and found["low"] == 10
    (path,) = [r.path for r in zones.files_of(spark, folder).where(F.col("file") == found["file"]).collect()]
    local = path.removeprefix("file:")
    spark.createDataFrame([(11, 99.0, "x")], "id long, at double, name string").coalesce(1).write.parquet(f"{tmp_path}/other")
    (new,) = [f for f in os.listdir(f"{tmp_path}/other") if f.endswith(".parquet")]
    with open(f"{tmp_path}/other/{new}", "rb") as source, open(local, "wb") as target:
        target.write(source.read())
    for crc in (os.path.join(os.path.dirname(local), f".{os.path.basename(local)}.crc"),):
        os.path.exists(crc) and os.remove(crc)
    assert pull(spark, folder, "35", where).count() == 7 and asked[5:] == [1, 3]


def test_files_below_folders_of_values(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(40).selectExpr("id", "id % 4 AS part").repartition(4, "part").write.partitionBy("part").parquet(path)
    table = spark.read.parquet(path)
    rows = zones.since(spark, table, path, "id", "38", str(tmp_path / "z"))
    assert sorted(map(tuple, rows.collect())) == [(38, 2), (39, 3)] and len(rows.inputFiles()) == 2
    assert zones.measured(table.select("*", "_metadata"), "id").count() == 4


def test_empty_tables_and_single_files(spark, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/t.parquet")
    empty = spark.read.schema("id long").parquet(f"{tmp_path}/t.parquet")
    assert zones.since(spark, empty, f"{tmp_path}/t.parquet", "id", "3", f"{tmp_path}/z").count() == 0
    one = "/root/testdata/sf0.001/orders.parquet"
    orders = spark.read.parquet(one)
    assert zones.since(spark, orders, one, "o_orderkey", "440", f"{tmp_path}/y").count() == orders.where("o_orderkey >= 440").count()
    with pytest.raises(JobError, match="not found"):
        zones.since(spark, orders, one, "nothing", "1", f"{tmp_path}/x")


def test_jobs_open_only_new_files(spark, folder, tmp_path):
    source = FolderSource(spark, os.path.dirname(folder), zone_maps=True)
    spec = JobSpec("o", table="t", watermark="at", primary_key=["id"])
    assert run_job(spark, spec, source, str(tmp_path / "out")).rows == 42
    add_file(spark, folder, [(60, 60.0, "x"), (61, 39.0, "tie")])
    second = run_job(spark, spec, source, str(tmp_path / "out"))
    got = sorted(r.id for r in spark.read.parquet(second.data_path).collect() if r.id < 900)
    assert got == [39, 60, 61] and second.state.last_fetched_row == "60.0"


@pytest.mark.parametrize("format, limit", [("parquet", None), ("quoted", None), ("parquet", 4)])
def test_each_row_is_written_once(spark, tmp_path, format, limit):
    """Several runs over a table that grows, with ties and copies at the boundary."""
    path, out = str(tmp_path / "t.parquet"), str(tmp_path / "out")
    schema = "id long, `at x` date, name string, tags map<string, int>"
    rows = [(1, "2024-01-01", "a", None), (2, "2024-01-02", "b", {"k": 1}), (2, "2024-01-02", "b", {"k": 1}), (3, "2024-01-02", None, {}),
            (4, "2024-01-02", "late", None), (2, "2024-01-02", "b", {"k": 1}), (5, "2024-01-03", "c", None), (6, "2024-01-03", "c", None),
            (7, "2024-01-03", "late", None), (7, "2024-01-03", "late", None)]
    spec = JobSpec("o", table="t", watermark="at x", exactly_once=True, limit=limit, primary_key=["id"], columns=["id", "at x", "name"])
    source, counts = FolderSource(spark, str(tmp_path)), []
    for begin, end in ((0, 4), (4, 6), (6, 8), (8, 10), (10, 10)):
        if end > begin:
            part = spark.createDataFrame([(i, None, n, t) for i, _, n, t in rows[begin:end]], schema)
            days = F.element_at(F.create_map(*(F.lit(x) for i, d in {i: d for i, d, _, _ in rows}.items() for x in (i, d))), F.col("id").cast("int"))
            part.withColumn("at x", days.cast("date")).select(*part.columns).coalesce(1).write.mode("append").parquet(path)
        for _ in range(2 if limit else 1):
            counts.append(run_job(spark, spec, source, out, format=format).rows)
    assert sum(counts) == len(rows) and counts[-1] == 0
    if format == "parquet":
        written = spark.read.parquet(f"{out}/o/data").drop("run").collect()
        assert sorted((r[0], r[2] or "") for r in written) == sorted((i, n or "") for i, _, n, _ in rows)
    assert not os.listdir(f"{out}/o/pulled") or all(n.startswith(".") for n in os.listdir(f"{out}/o/pulled"))


def test_a_run_that_died_is_repeated_whole(spark, tmp_path, monkeypatch):
    add_file(spark, str(tmp_path / "t.parquet"), [(1, 1.0, "a"), (2, 2.0, "b")])
    source, out = FolderSource(spark, str(tmp_path)), str(tmp_path / "out")
    spec = JobSpec("o", table="t", watermark="at", exactly_once=True)
    with monkeypatch.context() as patch:
        patch.setattr("sluicegate.plans.job.append_state", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_job(spark, spec, source, out)
    assert run_job(spark, spec, source, out).rows == 2 and run_job(spark, spec, source, out).rows == 0
    with pytest.raises(JobError, match="once"):
        JobSpec("o", table="t", watermark="at", exactly_once=True, columns=["id"])
