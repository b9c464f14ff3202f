import csv
import io
import random

import pytest

from sluicegate.sinks.lines import write_lines
from sluicegate.sources import delimited

SETTING = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def small_ranges(spark):
    """Byte ranges far smaller than records may be."""
    before = spark.conf.get(SETTING)
    spark.conf.set(SETTING, "97")
    yield
    spark.conf.set(SETTING, before)


def random_file(seed, n):
    draw, out = random.Random(seed), io.StringIO()
    write = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerow
    rows = []
    for i in range(n):
        text = "".join(draw.choices(["a", "bc", '"', "\n", "\n\n", ",", " ", "é", "x" * 40], k=draw.choice([0, 1, 4, 12, 60])))
        rows.append([str(i), text])
        write(rows[-1])
        if draw.random() < 0.1:
            out.write("\n")  # an empty line is no record
    return rows, out.getvalue()


@pytest.mark.parametrize("seed", range(3))
def test_one_file_is_read_by_many_tasks(spark, small_ranges, tmp_path, seed):
    rows, content = random_file(seed, 150)
    (tmp_path / "one.csv").write_text(content)
    assert delimited._lines(spark, str(tmp_path / "one.csv")).rdd.getNumPartitions() > 20
    found = delimited.parsed_records(spark, str(tmp_path / "one.csv"), 2).orderBy("number").collect()
    assert [r.number for r in found] == list(range(1, 151))
    assert [[r.c1, r.c2] for r in found] == rows and not any(r.misshapen for r in found)
    assert list(csv.reader(io.StringIO("\n".join(r.record for r in found), newline=""))) == rows


def test_each_file_has_numbers_of_its_own(spark, small_ranges, tmp_path):
    wanted = {}
    for name in ("a", "b", "empty"):
        rows, content = random_file(name, 0 if name == "empty" else 40)
        (tmp_path / f"{name}.csv").write_text(content)
        wanted.update({(f"{name}.csv", i + 1): row for i, row in enumerate(rows)})
    found = delimited.parsed_records(spark, str(tmp_path), 2).collect()
    assert {(r.file.rsplit("/", 1)[1], r.number): [r.c1, r.c2] for r in found} == wanted


def test_misshapen_records_have_the_number_of_their_place(spark, small_ranges, tmp_path):
    lines = [f'"{i}","{"l" * (i % 9)}\nm{i}"' + (',"more"' if i % 7 == 3 else "") for i in range(60)]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    bad = delimited.parsed_records(spark, str(tmp_path), 2).where("misshapen").orderBy("number").collect()
    assert [(r.number, r.record) for r in bad] == [(i + 1, x) for i, x in enumerate(lines) if i % 7 == 3]


def test_a_record_longer_than_many_ranges_and_one_that_never_ends(spark, small_ranges, tmp_path):
    long = "\n".join(f"line {i}" for i in range(200))
    (tmp_path / "x.csv").write_text(f'"1","short"\n"2","{long}"\n"3","x"\n"4","open\nto the\n\nend')
    found = delimited.split_records(spark, str(tmp_path / "x.csv")).orderBy("number").collect()
    assert [r.record for r in found] == ['"1","short"', f'"2","{long}"', '"3","x"', '"4","open\nto the\n\nend']


@pytest.mark.parametrize("mode", ["selective", "quoted", "null_aware"])
def test_what_the_library_writes_is_read_back(spark, small_ranges, tmp_path, mode):
    rows = [(i, None if i % 5 == 0 else "q\"u,\no\n\nte" * (i % 4)) for i in range(80)]
    write_lines(spark.createDataFrame(rows, "id long, name string"), str(tmp_path / "out"), mode, records_per_file=30)
    found = delimited.parsed_records(spark, str(tmp_path / "out"), 2).collect()
    shown = [(str(i), None if n is None and mode == "null_aware" else n or "") for i, n in rows]
    assert sorted(((r.c1, r.c2) for r in found), key=str) == sorted(shown, key=str)


def test_lines_are_read_twice_and_moved_once(spark, small_ranges, tmp_path):
    (tmp_path / "x.csv").write_text(random_file(1, 30)[1])
    records = delimited.split_records(spark, str(tmp_path / "x.csv"))
    records.collect()
    plan = records._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == 2 and "Python" not in plan  # for counts of quotes, and for the lines
    assert plan.count("ReusedExchange [file") >= 2
