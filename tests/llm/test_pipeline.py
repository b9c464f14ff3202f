"""The pipeline's stages against plain versions, each on its own input."""

import corpus_pipeline
from compare import TESTDATA
from test_mixing import plain_targets
from test_simhash import plain_components, plain_fingerprint

SF = f"{TESTDATA}/sf0.001"


def test_stages_one_after_another(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = corpus_pipeline.stored(stage(spark, docs, SF), f"test-{name}")
        seen[name] = before, docs.collect()
        assert name == "token_ids" or docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = seen["quality"]
    kept = {r["doc_id"] for r in after}
    assert len(after) == len(kept) and kept <= {r["doc_id"] for r in before}
    assert sum((i in kept) == bool(q) for i, q in labels.items()) > 0.9 * len(labels)

    before, after = seen["near_duplicates"]
    before = sorted(before, key=lambda r: r["doc_id"])
    prints = sorted({plain_fingerprint(r["text"], 5) for r in before})
    least = dict(zip(prints, plain_components(prints, 4)))
    wanted = {}
    for r in before:
        wanted.setdefault(least[plain_fingerprint(r["text"], 5)], r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(wanted.values())

    before, after = seen["decontamination"]
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaky = {r["doc_id"] for r in before if any(i in " ".join(r["text"].lower().split()) for i in items)}
    assert leaky and {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == leaky

    before, after = seen["mixing"]
    sizes, copies = {}, {}
    for r in before:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].encode().split())
    for r in after:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    rate = {s: t / sizes[s] for s, t in plain_targets(sizes).items()}
    assert all(copies.get(r["doc_id"], 0) in (int(rate[r["source"]]), int(rate[r["source"]]) + 1) for r in before)

    before, after = seen["token_ids"]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)
    start = 0
    for r in sorted(after, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]


def test_stages_on_odd_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.stored(stage(spark, docs, SF), f"odd-{name}")
            assert name == "token_ids" or docs.columns == columns
            docs.count()
