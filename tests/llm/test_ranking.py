import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluicegate.llm import ranking

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
CAPITALS = {c: c + 32 for c in range(65, 91)}


def plain_terms(text):
    return TERM.findall((text or "").translate(CAPITALS))


def plain_ranks(docs, items, k=10):
    """Every document scored for every item."""
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    df = Counter(t for _, c in counted for t in c)
    n_docs, all_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in {(i, t) for i, t in items}:
        asked, scores = Counter(plain_terms(text)), []
        for doc_id, held in counted:
            m = 25 + 75 * sum(held.values()) * n_docs // all_terms
            score = sum(r * weight[t] * (10**9 * held[t] // (1000 * held[t] + 8 * m)) for t, r in asked.items() if t in held)
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        best = sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(item_id, rank + 1, d, -s) for rank, (s, _, d) in enumerate(best)]
    return sorted(out, key=str)


def ranks(docs, items, k=10):
    rows = ranking.rank_documents(docs, items, k).collect()
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows), key=str)


def random_rows(seed, n):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.7)) % 400}" for _ in range(4_000)]
    return [(i % 97, " ".join(draw.choices(words, k=draw.choice([0, 1, 3, 20, 60, 300])))) for i in range(n)]


def test_terms():
    assert ranking.terms_of("Éa-B_c 1\x7f2\x80漢 z".encode()) == [t.encode() for t in plain_terms("Éa-B_c 1\x7f2\x80漢 z")]
    assert ranking.terms_of(None) == []


@pytest.mark.parametrize("k", [1, 10, 1_000])
def test_same_ranks_as_scoring_all(spark, k):
    docs, items = random_rows(1, 700), random_rows(2, 25)
    frames = [spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")]
    assert ranks(frames[0].repartition(5), frames[1], k) == plain_ranks(docs, items, k)


def test_blocks_of_queries_give_the_same(spark, monkeypatch):
    docs, items = random_rows(3, 200), random_rows(4, 11)
    monkeypatch.setattr(ranking, "QUERIES_AT_ONCE", 4)
    frames = [spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")]
    assert ranks(*frames) == plain_ranks(docs, items)


@pytest.mark.parametrize("seed", range(6))
def test_pruning_loses_nothing(monkeypatch, seed):
    monkeypatch.setattr(ranking, "BUCKET", 7)
    draw = random.Random(seed)
    queries = ranking.QuerySet.of([(i, " ".join(draw.choices("abcdefghijkl", k=draw.randrange(9))).encode()) for i in range(12)])
    impacts = ranking.Impacts(np.array([0, *(draw.choice([0, 1, 30, 7_000]) for _ in queries.numbers)]), 100, 900)
    rows, n_terms = [], len(queries.numbers)
    for d in range(120):
        held = draw.sample(range(1, n_terms + 1), draw.randrange(n_terms + 1))
        counts = [draw.choice([1, 1, 2, 9]) for _ in held]
        names = np.array(held, "<u4").tobytes(), np.array(counts, "<u4").tobytes()
        rows.append({"doc_id": draw.choice([None, d // 3]), "n": sum(counts) + draw.randrange(5) + 1, "terms": names[0], "counts": names[1]})
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("counts", pa.binary())])
    vectors = ranking._Vectors(pa.RecordBatch.from_pylist(rows, schema), impacts)
    search = ranking._Search(queries, 5, np.ones(12, np.int64))
    search.read(vectors)
    found = search.rows().to_pylist()
    ends = np.cumsum(vectors.sizes)
    for q, (terms, repeats) in enumerate(zip(queries.terms, queries.repeats)):
        asked, wanted = dict(zip(terms.tolist(), repeats.tolist())), []
        for d, row in enumerate(rows):
            own = slice(ends[d] - vectors.sizes[d], ends[d])
            score = sum(asked.get(t, 0) * x for t, x in zip(vectors.terms[own].tolist(), vectors.impacts[own].tolist()))
            if score > 0:
                wanted.append((-score, row["doc_id"] is None, row["doc_id"] or 0))
        got = [(-r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in found if r["query"] == q]
        assert sorted(got) == sorted(wanted)[:5]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    items = [(1, "the quick BROWN fox"), (1, "word5 7 the"), (1, "word5 7 the"), (None, "birds sing"), (2, None), (3, ""), (4, "日本語")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumns({"query": F.lit("x"), "doc_id": F.lit("y")})
    wanted = plain_ranks([(r["doc_id"], r["text"]) for r in odd_docs.collect()], [i for i in items])
    assert ranks(odd_docs, frame) == wanted
    assert ranks(no_docs, frame) == [] and ranks(odd_docs, frame.limit(0)) == []
