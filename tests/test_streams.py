import random

from pyspark.sql import functions as F

from sluicegate.operators.cdc import ChangeLog
from sluicegate.registered import QUERIES
from sluicegate.streaming import pull


def test_pull_takes_new_files_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    schema = spark.range(1).schema
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").parquet(source)
        pull.pull_new(pull.file_stream(spark, source, schema), out, checkpoint).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(start + 10))
    pull.pull_new(pull.file_stream(spark, source, schema), out, checkpoint).awaitTermination()
    assert spark.read.parquet(out).count() == 20


def changes_of(seed, n=120):
    rng, rows = random.Random(seed), []
    for lsn in range(n):
        rows.append((lsn, 1 if rng.random() < 0.4 else rng.randrange(8), rng.choice([1, 2, 3, 4, 4]), f"v{lsn}"))
    rng.shuffle(rows)  # positions arrive out of order across batches
    return rows


def test_changes_over_many_batches(spark, tmp_path):
    source, kept, checkpoint = (str(tmp_path / n) for n in ("in", "kept", "checkpoint"))
    rows = changes_of(3)
    schema = "lsn long, id int, op int, name string"
    for i in range(0, len(rows), 30):
        df = spark.createDataFrame(rows[i : i + 30], schema).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(source)
    full = spark.read.parquet(source)
    log = ChangeLog(full, ["id"])
    stream = pull.file_stream(spark, source, full.schema, files_per_batch=1)
    pull.apply_changes(stream, log, kept, checkpoint).awaitTermination()
    images = spark.read.parquet(kept)
    assert images.select("batch").distinct().count() == 4

    last = {}
    for lsn, key, op, name in sorted(rows):
        if op != 3:
            last[key] = None if op == 1 else name
    wanted = {k: v for k, v in last.items() if v is not None}
    assert {r.id: r.name for r in pull.current_rows(images, log).collect()} == wanted

    base = spark.createDataFrame([(1, "old"), (99, "untouched")], "id int, name string")
    with_base = {r.id: r.name for r in pull.current_rows(images, log, base).collect()}
    assert with_base == {**wanted, 99: "untouched"}

    pull.compact(images, log, str(tmp_path / "compacted"))
    compacted = spark.read.parquet(str(tmp_path / "compacted"))
    assert compacted.count() == len(last)
    assert {r.id: r.name for r in pull.current_rows(compacted, log).collect()} == wanted


def test_replayed_batch_counts_once(spark, tmp_path):
    source, kept = str(tmp_path / "in"), str(tmp_path / "kept")
    df = spark.createDataFrame([(1, 7, 4, "a"), (2, 7, 4, "b")], "lsn long, id int, op int, name string")
    df.withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(source)
    full = spark.read.parquet(source)
    log = ChangeLog(full, ["id"])
    for attempt in ("one", "two"):  # a lost checkpoint starts again at the first batch
        stream = pull.file_stream(spark, source, full.schema)
        pull.apply_changes(stream, log, kept, str(tmp_path / attempt)).awaitTermination()
    assert [(r.id, r.name) for r in spark.read.parquet(kept).collect()] == [(7, "b")]


def test_streams_over_tables_in_folders(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(4).write.parquet(f"{tmp_path}/in/events.parquet")
    for name in ("stream_incremental", "stream_cdc"):
        one, many = (sorted(map(str, QUERIES[name](spark, d).collect())) for d in ("/root/testdata/sf0.001", f"{tmp_path}/in"))
        assert one == many
    stream = pull.table_stream(spark, f"{tmp_path}/in/events.parquet", events.schema, files_per_batch=1)
    pull.pull_new(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == events.count()
