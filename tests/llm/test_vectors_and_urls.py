import datetime as dt
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import topk, urls

T0 = dt.datetime(2024, 1, 1)


def plain_top(rows, k, asked):
    rows = [(i, np.array(v)) for i, v in rows]
    dims = max((len(v) for _, v in rows), default=0)
    wide = [(i, np.pad(v, (0, dims - len(v)))) for i, v in rows]
    out = []
    for q, v in sorted({i: tuple(v) for i, v in wide if i in asked}.items()):
        best = sorted((-int(np.dot(v, c)), i) for i, c in wide if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return out


def found(spark, rows, k, asked):
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = topk.top_inner_products(vectors.filter(F.col("vec_id").isin(list(asked))), vectors, k).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


def test_top_products_with_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "STEP", 16)
    monkeypatch.setattr(topk, "SEEDS", 8)
    monkeypatch.setattr(topk, "LEAST_TILES", 6)
    draw = np.random.default_rng(3)
    scale = draw.choice([1, 5, 40], 300)
    rows = [(i, [int(x) for x in draw.integers(-3, 4, 6) * s]) for i, s in enumerate(scale)]
    rows += [(400 + i, rows[7][1]) for i in range(60)] + [(500, [0] * 6), (501, [9, -9]), (502, [])]
    asked = {0, 50, 100, 420, 500, 501, 502}
    assert found(spark, rows, 5, asked) == plain_top(rows, 5, asked)


def test_tiles_of_few_bytes_give_the_same(spark, monkeypatch):
    for name, value in (("STEP", 16), ("SEEDS", 8), ("TILE_BYTES", 1_000)):  # of some 70 candidates and queries
        monkeypatch.setattr(topk, name, value)
    draw = np.random.default_rng(5)
    rows = [(i, [int(x) for x in draw.integers(-100, 101, 6)]) for i in range(400)] + [(i, [7, 7]) for i in range(400, 440)]
    asked = {i for i in range(440) if i % 2}
    assert found(spark, rows, 5, asked) == plain_top(rows, 5, asked)


@pytest.mark.parametrize("scale", [1, 10**5, 10**8], ids=["float32", "float64", "int64"])
@pytest.mark.parametrize("sparse", [False, True])
def test_best_of_tile_keeps_little_in_memory(scale, sparse):
    draw = np.random.default_rng(7)
    c = draw.integers(-120, 121, (6_000, 8)) * scale * np.array([1] * 4 + [0 if sparse else 1] * 4)
    c = c[np.argsort(-topk.lengths(c), kind="stable")]
    q, ids, k = c[::2].copy(), np.arange(6_000)[::-1].copy(), 5
    c[50:400] = c[50]  # ties
    floors, turn = np.full(len(q), -np.inf), np.eye(8)
    tracemalloc.start()
    got = topk.best_of_tile(ids[::2], q, floors, ids, c, turn, k)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6
    rows = {}
    for a, b, s in zip(*(x.tolist() for x in got)):
        rows.setdefault(a, []).append((-s, b))
    exact = q[:200] @ c.T
    for i, scores in enumerate(exact):
        own = ids[2 * i]
        best = np.lexsort((ids, -scores))[: k + 1]
        assert sorted(rows[own]) == [(-int(scores[j]), int(ids[j])) for j in best if ids[j] != own][:k]


def test_few_and_large_vectors(spark):
    rows = [(0, [2**26, 3]), (50, [2**27 + 1, -5]), (7, [-(2**26), 1])]
    assert found(spark, rows, 5, {0, 50}) == plain_top(rows, 5, {0, 50})
    assert found(spark, rows[:1], 5, {0}) == [] and found(spark, rows, 2, set()) == [] and found(spark, [], 2, set()) == []


def test_unsound_vectors_take_no_part(spark):
    rows = [(1, [0.5, -0.001]), (2, None), (3, [1.0, None]), (4, [float("nan"), 0.0]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]), (6, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("real", F.lit("own"))
    assert {r["vec_id"]: r["v"] for r in topk.integer_vectors(frame).collect()} == {1: [128, -1], 6: []}


def day(n):
    return T0 + dt.timedelta(days=n)


def judged(spark, captures, entries):
    pages = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").withColumn("action", F.lit("own"))
    listed = spark.createDataFrame(entries, "pattern string, action string, at timestamp")
    rows = urls.judge(pages, listed).collect()
    return sorted(((r["page_id"], r["pattern"], r["blocked"]) for r in rows), key=str)


def test_entries_hold_from_their_day_until_the_next(spark):
    entries = [("bad.org", "block", day(5)), ("bad.org", "remove", day(100)), ("bad.org", "block", day(300)),
               ("sub.bad.org/ok", "allow", day(7)), (None, "block", day(0)), ("x.org", None, day(0)), ("x.org", "block", None)]
    url = "https://user@Sub.BAD.org:8080/ok/page?q#f"
    captures = [(i, url, day(n)) for i, n in enumerate((4, 5, 6, 7, 99))] + [(9, "http://www.bad.org", day(100)), (10, "http://bad.org./", day(299))]
    captures += [(11, "http://bad.org/ok", day(300)), (12, "http://notbad.org", day(6)), (13, "http://x.org/", day(6)), (13, "http://x.org/", day(6))]
    captures += [(14, None, day(6)), (15, "no url", day(6)), (16, url, None), (None, "http://bad.org", day(50))]
    sub = "sub.bad.org/ok"
    assert judged(spark, captures, entries) == sorted([
        (0, None, False), (1, "bad.org", True), (2, "bad.org", True), (3, sub, False), (4, sub, False), (9, None, False),
        (10, None, False), (11, "bad.org", True), (12, None, False), (13, None, False), (13, None, False), (14, None, False),
        (15, None, False), (16, None, False), (None, "bad.org", True),
    ], key=str)


def test_empty_tables(spark):
    assert judged(spark, [], [("a.org", "block", day(1))]) == []
    assert judged(spark, [(1, "http://a.org", day(2))], []) == [(1, None, False)]


def test_same_time_entries_and_patterns(spark):
    entries = [("a.org", "allow", day(1)), ("a.org", "block", day(1)), ("a.org", "block", day(1))]
    assert judged(spark, [(1, "http://a.org/x", day(1))], entries) == [(1, "a.org", True)]
    row = spark.createDataFrame([("http://a.b.co.uk/x//y/z/w",), ("http://host",)], ["u"]).select(urls.patterns_of(F.col("u"))).collect()
    assert row[0][0] == ["a.b.co.uk", "b.co.uk", "co.uk", "a.b.co.uk/x", "a.b.co.uk/x/y", "a.b.co.uk/x/y/z"] and row[1][0] == ["host"]


def test_entries_of_any_depth_decide(spark):
    entries = [("a.org", "block", day(1)), ("a.org/1/2/3/4", "allow", day(1)), ("b.org/1/2/3/4/5/6", "block", day(1))]
    captures = [(1, "http://a.org/1/2/3/4/x", day(2)), (2, "http://a.org/1/2/3", day(2)), (3, "http://b.org/1/2/3/4/5/6", day(2)), (4, "http://b.org/1", day(2))]
    assert judged(spark, captures, entries) == [
        (1, "a.org/1/2/3/4", False), (2, "a.org", True), (3, "b.org/1/2/3/4/5/6", True), (4, None, False)
    ]


def test_patterns_are_compared_as_hosts_are(spark):
    rows = [("Bad.org",), ("www.bad.org",), ("bad.org/",), ("bad.org/x/",), ("WWW.Bad.org.//x/Y",), ("",), (None,)]
    got = spark.createDataFrame(rows, "p string").select(urls.plain_pattern(F.col("p"))).collect()
    assert [r[0] for r in got] == ["bad.org", "bad.org", "bad.org", "bad.org/x", "bad.org/x/Y", "", None]
