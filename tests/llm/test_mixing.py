from collections import Counter, defaultdict

from sluicegate.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing, capping and sharing the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[s] for s in full)
        shared = sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * weight[s] >= cap * sizes[s] * shared}
        if not over:
            return {s: float(cap * sizes[s]) if s in full else rest * weight[s] / shared for s in names}
        full |= over


def test_targets_and_copies(spark, odd_docs):
    rows = mixing.mix_sources(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    sizes = defaultdict(int)
    for r in rows:
        assert r["size"] == len((r["doc"]["text"] or "").encode().split())
        sizes[r["doc"]["source"]] += r["size"]
    wanted = plain_targets(sizes)
    for r in rows:
        source = r["doc"]["source"]
        assert r["source_size"] == sizes[source] and abs(r["target"] - wanted[source]) < 1e-6
        assert r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) and r["copies"] <= 3 and r["taken"] == r["size"] * r["copies"]
    assert abs(sum(wanted.values()) - sum(sizes.values())) < 1e-6


def test_copies_are_emitted_with_all_columns_and_reruns_agree(spark, odd_docs):
    mixed = mixing.mix_sources(odd_docs)
    copies = Counter({i: 0 for i in range(12)})
    for r in mixed.collect():
        copies[r["doc"]["doc_id"]] += r["copies"]
    emitted = mixing.emit_copies(mixed)
    assert emitted.columns == odd_docs.columns
    assert Counter(r["doc_id"] for r in emitted.collect()) == +copies
    assert sorted(map(str, mixing.mix_sources(odd_docs).collect())) == sorted(map(str, mixed.collect()))


def test_taken_words_come_near_the_targets(spark):
    docs = spark.range(20_000).selectExpr(
        "id AS doc_id", "repeat('w ', 1 + int(id % 7)) AS text", "'en' AS lang",
        "IF(id % 3 = 0, 'hot', concat('s', id % 10)) AS source", "0L AS n_chars",
    )
    by_source = mixing.mix_sources(docs).groupBy("doc.source").agg({"taken": "sum", "target": "max"}).collect()
    for r in by_source:
        assert abs(r["sum(taken)"] - r["max(target)"]) < 0.06 * r["max(target)"]


def test_empty_and_wordless(spark, no_docs, odd_docs):
    assert mixing.mix_sources(no_docs).count() == 0
    blank = odd_docs.filter("doc_id IN (4, 5, 6)")
    assert {(r["target"], r["taken"]) for r in mixing.mix_sources(blank).collect()} == {(0.0, 0)}
