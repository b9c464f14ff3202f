import csv
import glob
import json
import random

import fixtures
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluicegate.errors import JobError
from sluicegate.functions.types import with_source_types
from sluicegate.operators import checks
from sluicegate.sinks.columnar import write_parquet
from sluicegate.sinks.lines import lines, write_lines, write_quoted_csv
from sluicegate.sinks.manifest import manifest, read_json, write_json
from sluicegate.sinks.state import State, append_state, read_state
from sluicegate.sources.delimited import misshapen_records, read_records


def shown(df, mode):
    return [r.line for r in lines(df, mode).collect()]


def test_null_in_the_three_line_modes(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "", 'b"c'), (None, None, None)], "a int, b string, c string")
    assert shown(df, "selective") == ['1,"","x"', ',"","b""c"', ',"",""']
    assert shown(df, "quoted") == ['"1","","x"', '"","","b""c"', '"","",""']
    assert shown(df, "null_aware") == ['"1",,"x"', ',"","b""c"', ",,"]


def test_selective_line_of_a_row_of_nulls(spark):
    assert shown(fixtures.nullable(spark).where("id is null"), "selective") == [',"",,,2021-01-05 13:43:14.490']


def test_lines_of_the_numbered_table(spark):
    df = fixtures.numbered(spark).orderBy("`_Weir%d I-D`").limit(1)
    assert shown(df, "selective") == ['1,"mario",1,1.10,"plumber",2012-01-10 10:00:00,2021-01-05 13:43:11.000']
    assert shown(df, "null_aware") == [
        '"1","mario","1","1.10","plumber","2012-01-10 10:00:00","2021-01-05 13:43:11.000"'
    ]


def test_numbers_and_flags_as_text(spark):
    df = spark.createDataFrame([(1,)], "id int").select(
        F.lit(123).alias("int"), F.lit("123").cast("decimal(18,0)").alias("dec"), F.lit(987.0).alias("float"),
        F.lit(True).alias("bit"), F.lit("1.5").cast("decimal(19,4)").alias("money"),
        F.lit("2020-02-01").cast("date").alias("day"),
    )
    assert shown(df, "selective") == ["123,123,987.0,1,1.5000,2020-02-01"]
    assert shown(df, "null_aware") == ['"123","123","987.0","1","1.5000","2020-02-01"']


def test_row_versions_are_bare_hex(spark):
    assert shown(fixtures.versioned(spark).where("id = 1"), "selective") == ["1,0x00000000000007D1"]


def test_nested_values_cannot_be_lines(spark):
    with pytest.raises(TypeError, match="nested type"):
        lines(spark.createDataFrame([([1],)], "a array<int>"), "quoted")
    with pytest.raises(JobError, match="Unknown line mode"):
        lines(spark.range(1), "raw")


def test_special_characters_survive_files(spark, tmp_path):
    df = fixtures.special(spark)
    for mode in ("quoted", "null_aware", "selective"):
        path = str(tmp_path / mode)
        write_lines(df.coalesce(1), path, mode)
        text = "".join(open(f, encoding="utf-8", newline="").read() for f in glob.glob(f"{path}/part-*"))
        wanted = sorted((a, b or "") for a, b in fixtures.SPECIAL)
        assert sorted(tuple(r) for r in csv.reader(text.splitlines(keepends=True), strict=True)) == wanted
        back = sorted((r.c1, r.c2 or "") for r in read_records(spark, path, 2).select("c1", "c2").collect())
        assert back == wanted
        if mode == "null_aware":
            second = {r.c1: r.c2 for r in read_records(spark, path, 2).select("c1", "c2").collect()}
            assert second["first\n\nsecond"] is None and second["unicode žščř"] == ""


def test_any_text_survives_files(spark, tmp_path):
    rng = random.Random(5)
    pieces = ['"', '""', ",", "\n", "\r", "\r\n", "\\", '\\"', "\0", "\u0001", "\t", " ", "a", "ž", "#", "'", "NULL", "\U0001f600"]

    def text():
        return None if rng.random() < 0.15 else "".join(rng.choice(pieces) for _ in range(rng.randrange(6)))

    rows = [(str(i), text(), text(), "end") for i in range(800)]
    df = spark.createDataFrame(rows, "i string, a string, b string, z string")
    write_lines(df.repartition(3), str(tmp_path / "x"), "null_aware", records_per_file=150)
    back = read_records(spark, str(tmp_path / "x"), 4)
    assert sorted(tuple(r)[:4] for r in back.collect()) == sorted(rows)
    assert misshapen_records(spark, str(tmp_path / "x"), 4).count() == 0
    assert checks.misshapen(lines(df, "null_aware"), 4).count() == 0


def test_spark_csv_writer_gives_the_quoted_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, " a "), (None, 'q"'), (3, None), (4, "")], "a int, b string").coalesce(1)
    write_quoted_csv(df, str(tmp_path / "csv"))
    written = "".join(open(f, newline="").read() for f in glob.glob(f"{tmp_path}/csv/part-*"))
    assert written == "".join(line + "\n" for line in shown(df, "quoted"))


def test_files_are_bounded(spark, tmp_path):
    write_lines(spark.range(25).coalesce(1), str(tmp_path / "x"), "quoted", records_per_file=10)
    assert len(glob.glob(f"{tmp_path}/x/part-*")) == 3


def test_misshapen_records_are_found_with_their_numbers(spark, tmp_path):
    rows = ['"a","b"', '"c\nd","e"', '"f","g","h"', '"i","j"', "k"]
    path = str(tmp_path / "bad")
    spark.createDataFrame([(r,) for r in rows], "line string").coalesce(1).write.text(path)
    found = sorted((r.number, r.record) for r in misshapen_records(spark, path, 2).collect())
    assert found == [(3, '"f","g","h"'), (5, "k")]
    lines_df = spark.createDataFrame([(r,) for r in rows], "line string")
    assert sorted(r.line for r in checks.misshapen(lines_df, 2).collect()) == ['"f","g","h"', "k"]


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (2, 1)], "a int, b int")
    assert tuple(checks.key_report(df, ["a", "b"]).first()) == (5, 1, 1)
    assert tuple(checks.key_report(df.where("false"), ["a"]).first()) == (0, 0, 0)
    assert checks.null_keys(df, ["a", "b"]).count() == 1
    assert [tuple(r) for r in checks.repeated_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    assert [f.nullable for f in checks.as_key(df, ["a"]).fields] == [False, True]


def test_parquet_by_partition_keeps_every_row(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("part"))
    write_parquet(df, str(tmp_path / "p"), ["part"])
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == 1000 and back.where("part = 'hot'").count() == 334


def test_partition_column_with_an_odd_name(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("od d.name"))
    write_parquet(df, str(tmp_path / "o"), ["od d.name"])
    assert spark.read.parquet(str(tmp_path / "o")).where("`od d.name` = 1").count() == 5


def test_sorted_files_skip_row_groups(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") * 37 % 2000).alias("wm"), (F.col("id") % 2).alias("p")).coalesce(1)
    write_parquet(df, str(tmp_path / "s"), ["p"], ["wm"])
    for file in glob.glob(f"{tmp_path}/s/p=*/part-*"):
        values = [r.wm for r in spark.read.parquet(file).collect()]
        assert values == sorted(values)


def test_manifest_layouts(spark):
    df = fixtures.numbered(spark)
    table = {"name": "auto Increment Timestamp", "schema": "dbo", "catalog": "test"}
    plain = manifest(df.schema, "out", True, ["_Weir%d I-D"], table)
    assert plain["incremental"] is True and plain["primary_key"] == ["Weir_d_I_D"]
    assert plain["columns"][:3] == ["Weir_d_I_D", "Weir_d_Na_me", "someInteger"]
    assert {"key": "sanitizedName", "value": "auto_Increment_Timestamp"} in plain["metadata"]
    assert plain["column_metadata"]["Weir_d_I_D"] == [
        {"key": "datatype.nullable", "value": False},
        {"key": "datatype.basetype", "value": "INTEGER"},
        {"key": "sourceName", "value": "_Weir%d I-D"},
        {"key": "sanitizedName", "value": "Weir_d_I_D"},
        {"key": "uniqueKey", "value": False},
        {"key": "ordinalPosition", "value": 1},
    ]
    native = manifest(df.schema, "out", False, ["_Weir%d I-D"], table, native_types=True)
    assert native["schema"][0] == {
        "name": "Weir_d_I_D",
        "nullable": False,
        "primary_key": True,
        "data_type": {"base": {"type": "INTEGER"}},
        "metadata": {
            "sourceName": "_Weir%d I-D", "sanitizedName": "Weir_d_I_D", "uniqueKey": False, "ordinalPosition": 1,
        },
    }
    assert [c["data_type"]["base"]["type"] for c in native["schema"]] == [
        "INTEGER", "STRING", "INTEGER", "NUMERIC", "STRING", "TIMESTAMP", "TIMESTAMP",
    ]


def test_manifest_of_a_query_has_no_table_and_its_key_takes_no_null(spark):
    df = with_source_types(spark.createDataFrame([("a", 1)], "sku string, n int"), {"sku": "text"})
    made = manifest(df.schema, "out", primary_key=["sku"])
    assert "metadata" not in made
    assert made["column_metadata"]["sku"][0] == {"key": "datatype.nullable", "value": False}
    assert "ordinalPosition" not in json.dumps(made)
    assert "primary_key" not in manifest(df.schema, "out")


def test_json_documents(spark, tmp_path):
    write_json(spark, {"a": ["ž", None, 1]}, str(tmp_path / "j"))
    assert read_json(spark, str(tmp_path / "j")) == {"a": ["ž", None, 1]}


def test_last_state_counts(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_state(spark, path) == State()
    append_state(spark, path, State(1, "4", None), 3)
    append_state(spark, path, State(2, "6", "2024-01-01 00:00:00"), 1)
    assert read_state(spark, path) == State(2, "6", "2024-01-01 00:00:00")
    with pytest.raises(AnalysisException):
        spark.read.json(str(tmp_path / "none"))


def test_one_null_aware_column_is_refused(spark):
    with pytest.raises(JobError, match="single column"):
        lines(spark.createDataFrame([(None,)], "a string"), "null_aware")
