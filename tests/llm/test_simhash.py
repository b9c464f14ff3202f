import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sluicegate.llm import simhash


def plain_fingerprint(text, words):
    tokens = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fingerprints, radius):
    """Least index reachable from each fingerprint, by comparing all pairs."""
    least, changed = list(range(len(fingerprints))), True
    while changed:
        changed = False
        for i, a in enumerate(fingerprints):
            for j, b in enumerate(fingerprints):
                if (a ^ b).bit_count() <= radius and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def unsigned(x):
    return x & (1 << 64) - 1


def test_fingerprints_and_components_on_odd_rows(spark, odd_docs):
    rows = simhash.near_duplicates(odd_docs, words=4).collect()
    texts = odd_docs.select("doc_id", "text").collect()
    assert sorted((str(r["doc_id"]), unsigned(r["fingerprint"])) for r in rows) == sorted(
        (str(t["doc_id"]), plain_fingerprint(t["text"], 4)) for t in texts
    )
    of = {(r["doc_id"], unsigned(r["fingerprint"])): r["component_id"] for r in rows}
    prints = sorted({p for _, p in of})
    least = plain_components(prints, 4)
    for (doc_id, p), component in of.items():
        reached = [i for (i, q) in of if i is not None and least[prints.index(q)] == least[prints.index(p)]]
        assert component == min(reached, default=None)


def test_chains_and_crowds_link_as_all_pairs_do(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(60)}
    for start in list(prints)[:6]:  # chains of steps of one to six bits, and crowds around one point
        here = start
        for _ in range(12):
            for bit in draw.sample(range(64), draw.randint(1, 6)):
                here ^= 1 << bit
            prints.add(here)
        prints |= {start ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(25)}
    prints = sorted(prints, key=lambda p: p - (1 << 64) if p >> 63 else p)
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    marked = spark.createDataFrame(signed, "doc_id long, fingerprint long")
    found = {r["fingerprint"]: r for r in simhash.classes(marked, 4).collect()}
    least = plain_components(prints, 4)
    assert [found[s]["component_id"] for _, s in signed] == least
    assert [found[s]["is_first"] for _, s in signed] == [i == k for i, k in enumerate(least)]


def test_large_buckets_are_halved(monkeypatch):
    draw = np.random.default_rng(1)
    values = np.unique(np.array([(1 << 40) ^ (1 << int(a)) ^ (1 << int(b)) for a, b in draw.integers(0, 64, (80, 2))], np.uint64))
    whole = [*simhash.shared_variants(values, 0, 0, 2)]
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 5_000)
    parts = [*simhash.shared_variants(values, 0, 0, 2)]

    def groups(links):
        label = {int(v): int(v) for v in values}
        for _ in range(len(values)):
            for hi, lo in links:
                for a, b in zip(hi.tolist(), lo.tolist()):
                    label[a] = label[b] = min(label[a], label[b])
        return label

    assert len(parts) > 1 and groups(parts) == groups(whole)


def test_one_of_each_keeps_the_least_id_once(spark, odd_docs, no_docs):
    kept = simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i or 0))
    assert ids.count(1) == 1 and 3 not in ids and 6 not in ids and 5 not in ids  # copies of 1; 4, 5 and 6 have no words
    assert {4, 7, 8, 9, 10} <= set(ids) and len(ids) == len(set(ids))
    assert simhash.one_of_each(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.link_fingerprints(spark.range(2).select(F.col("id").alias("fingerprint")), 3)
