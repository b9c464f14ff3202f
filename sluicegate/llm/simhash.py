"""SimHash near-duplicates by meet-in-the-middle ball hashing, and connected components of what is linked.

Two 64-bit fingerprints differ in at most ``radius`` bits exactly if some value lies within half the radius of both. Every
distinct fingerprint therefore stands for all its variants within half the radius, variants are brought together, and
fingerprints that share one are linked. Variants travel packed: those with the same leading bits go to the same bucket,
so a fingerprint is sent once to each bucket it has variants in, and the bucket spells the variants out. Sharing a
variant proves the distance, so a crowd around one variant needs links to its least member only, never all pairs.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import stored

BITS = 64
#: Variants that a bucket should spell out on average, and those it spells out at once (else it is halved by the next bit).
BUCKET_VARIANTS, VARIANTS_AT_ONCE = 1 << 19, 1 << 22
HASHES_AT_ONCE = 1 << 16


def fingerprint_of(text: bytes | None, words: int, seed: int) -> int:
    """Signed 64-bit fingerprint: a bit is set if it is in over half of the shingles' hashes; no words give zero."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(joined)]))
    size = min(words, len(tokens))
    spans = zip(starts[: len(starts) - size + 1].tolist(), ends[size - 1 :].tolist())
    hash_of, ones, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), 0
    while part := [hash_of(joined[a:b], seed) for a, b in itertools.islice(spans, HASHES_AT_ONCE)]:
        bits = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        total += len(part)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little", signed=True)


def fingerprint(text: Column, words: int, seed: int = 42) -> Column:
    """Fingerprint of a text's shingles of ``words`` words; A-Z are lower-cased, words are split at ASCII white space."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(x, words, seed) for x in texts], dtype="int64")

    return of(text.cast("binary"))


@lru_cache(maxsize=None)
def flips(bits: int, most: int) -> np.ndarray:
    """All masks over the lowest ``bits`` bits with at most ``most`` of them set."""
    chosen = itertools.chain.from_iterable(itertools.combinations(range(bits), k) for k in range(min(most, bits) + 1))
    return np.array([sum(1 << i for i in c) for c in chosen], dtype=np.uint64)


def prefix_of(values: np.ndarray, prefix_bits: int) -> np.ndarray:
    return values >> np.uint64(BITS - prefix_bits) if prefix_bits else np.zeros_like(values)


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def shared_variants(values: np.ndarray, bucket: int, prefix_bits: int, half: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(higher, lower) links among a bucket's fingerprints that share a variant with the bucket's prefix."""
    rest = BITS - prefix_bits
    spent = distance(prefix_of(values, prefix_bits), np.uint64(bucket))
    masks = [flips(rest, half - s) for s in range(half + 1)]
    if sum(int((spent == s).sum()) * len(masks[s]) for s in range(half + 1)) > VARIANTS_AT_ONCE and rest > half:
        for bit in (0, 1):
            narrower = bucket << 1 | bit
            near = distance(prefix_of(values, prefix_bits + 1), np.uint64(narrower)) <= half
            yield from shared_variants(values[near], narrower, prefix_bits + 1, half)
        return
    low = np.uint64((1 << rest) - 1)
    variants, owners = [], []
    for s in range(half + 1):
        at = np.flatnonzero(spent == s)
        variants.append(((values[at] & low)[:, None] ^ masks[s]).ravel())
        owners.append(np.repeat(at, len(masks[s])))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    ordered = np.sort(variant)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    place = np.minimum(np.searchsorted(twice, variant), len(twice) - 1)
    met = twice[place] == variant
    place, owner = place[met], owner[met]
    label = np.arange(len(values))
    while True:  # least member reachable within the bucket
        least = np.full(len(twice), len(values))
        np.minimum.at(least, place, label[owner])
        lower = label.copy()
        np.minimum.at(lower, owner, least[place])
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    joined = np.flatnonzero(label != np.arange(len(values)))
    yield values[joined], values[label[joined]]


def link_fingerprints(fingerprints: DataFrame, radius: int) -> DataFrame:
    """Links (``hi``, ``lo``) that connect every two of the distinct ``fingerprint`` within ``radius`` bits.

    Within a bucket the links form a forest, so n fingerprints have fewer than n links there, however close they are.
    """
    if radius % 2 or not 0 <= radius <= 8:
        raise ValueError("the radius has to be an even number of at most 8 bits")
    half = radius // 2
    ball = sum(math.comb(BITS, k) for k in range(half + 1))
    wanted = fingerprints.count() * ball / BUCKET_VARIANTS
    prefix_bits = min(40, max(4, math.ceil(math.log2(max(wanted, 1)))))
    turned = flips(prefix_bits, half)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part in np.array_split(values, len(values) // 4096 + 1):
                buckets = (prefix_of(part, prefix_bits)[:, None] ^ turned).ravel()
                columns = [pa.array(x.view(np.int64)) for x in (buckets, np.repeat(part, len(turned)))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "fingerprint"])

    def meet(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        values = np.sort(rows.column("fingerprint").to_numpy()).view(np.uint64)
        found = [*shared_variants(values, key[0].as_py(), prefix_bits, half)]
        hi, lo = (np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.uint64) for i in (0, 1))
        return pa.table({"hi": hi.view(np.int64), "lo": lo.view(np.int64)})

    sent = fingerprints.select("fingerprint").mapInArrow(send, "bucket long, fingerprint long")
    return sent.groupBy("bucket").applyInArrow(meet, "hi long, lo long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(``node``, ``root``) of all linked nodes, ``root`` being the least node that can be reached.

    First every node keeps its least parent and passes the others on to that one, until each has one parent; then the
    trees are flattened by doubling. Each round is stored, so neither plan nor lineage grows.
    """
    forest = stored(links, "links")
    while True:
        least = F.min("lo").over(Window.partitionBy("hi")).alias("root")
        kept = forest.select("hi", "lo", least)
        pairs = F.expr("IF(lo = root, array(struct(hi, root)), array(struct(hi, root), struct(lo AS hi, root)))")
        passed = kept.select(F.inline(pairs)).withColumnRenamed("root", "lo").distinct()
        if forest.groupBy("hi").count().filter("count > 1").isEmpty():
            break
        forest = stored(passed, "links")
    while True:
        above = forest.select(F.col("hi").alias("middle"), F.col("lo").alias("top"))
        raised = forest.join(above, forest["lo"] == above["middle"], "left")
        forest = stored(raised.select("hi", F.coalesce("top", "lo").alias("lo"), F.expr("top IS NOT NULL AS moved")), "links")
        if forest.filter("moved").isEmpty():
            break
    roots = forest.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return forest.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(roots)


def classes(marked: DataFrame, radius: int) -> DataFrame:
    """Per distinct ``fingerprint`` of ``marked`` (doc_id, fingerprint): ``component_id`` and ``is_first``.

    ``component_id`` is the least id of all documents that can be reached (NULL if none has an id); ``is_first`` marks the
    fingerprint which has that document. Copies meet in a partial aggregation, so they cost one row a task.
    """
    groups = stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    linked = components(link_fingerprints(groups, radius))
    placed = stored(
        groups.join(linked, groups["fingerprint"] == linked["node"], "left")
        .select("fingerprint", "first_id", F.coalesce("root", "fingerprint").alias("root")), "placed"
    )
    order = F.struct(F.col("first_id").isNull(), "first_id", "fingerprint")
    best = placed.groupBy("root").agg(F.min(order).alias("best"))
    return stored(
        placed.join(best, "root").select(
            "fingerprint", F.col("best.first_id").alias("component_id"),
            (F.col("fingerprint") == F.col("best.fingerprint")).alias("is_first"),
        ), "classes"
    )


def near_duplicates(docs: DataFrame, words: int = 5, radius: int = 4, seed: int = 42) -> DataFrame:
    """Per document: ``doc_id``, ``fingerprint`` and ``component_id``, the least id it is linked to (its own included).

    NULL or empty text: fingerprint zero, linked like any other. NULL id: takes part, and has the component's id like the
    rest (NULL if no document there has one). Repeated rows: one row each. Empty table: no rows. Other columns are not read.
    """
    marked = stored(docs.select("doc_id", fingerprint(docs["text"], words, seed).alias("fingerprint")), "marked")
    found = classes(marked, radius)
    return marked.join(found, "fingerprint").select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, radius: int = 4, seed: int = 42) -> DataFrame:
    """``docs`` with one document of each component: the one of least id (NULL last), once if it is repeated.

    Copies of a text are reduced to one on the map side, and texts move once.
    """
    first = F.min_by(
        F.col("doc"), F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.xxhash64("doc"))
    )
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    marked = docs.select(whole, fingerprint(docs["text"], words, seed).alias("fingerprint"))
    found = classes(stored(marked.select("doc.doc_id", "fingerprint"), "marked"), radius)
    lost = found.filter("NOT is_first").select("fingerprint")
    return marked.groupBy("fingerprint").agg(first.alias("doc")).join(lost, "fingerprint", "left_anti").select("doc.*")
