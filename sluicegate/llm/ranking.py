"""Ranked lexical search in buckets of impact vectors by falling length, after LEMP.

A document's impact vector holds, for each term of the query set, what an occurrence of the term in a query adds to its
score. Tasks order the vectors they hold by length and cut them into buckets. For a query, a bucket is passed over if its
longest vector cannot reach the query's tenth score (Cauchy-Schwarz). Inside, the query's coordinates are taken by their
largest value in the bucket until documents without any of them are out; of the documents that have one, those whose sum so
far and whose largest possible rest reach the tenth score are scored exactly, in integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .base import stored

#: Queries, and bytes of their texts, that are answered in one go.
QUERIES_AT_ONCE, QUERY_BYTES = 2_000, 16 << 20
#: Vectors, and entries of them, that a task orders at once; vectors of a bucket; vectors that set the first thresholds.
CHUNK, CHUNK_ENTRIES, BUCKET, SEEDS = 16_384, 2_000_000, 2_048, 1_024
#: Groups of an item's partial ranks before the last step.
RANK_GROUPS = 64
#: Room for the rounding of lengths, which are floating point; scores are not.
ROOM = 1 + 1e-9

#: Bytes that end a term (ASCII signs and white space), and capitals, as one table; all other bytes stay.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))

VECTORS = "doc_id long, n long, terms binary, counts binary"


def terms_of(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, with A-Z lower-cased."""
    return (text or b"").translate(FOLDED).split()


@dataclass
class QuerySet:
    """Queries as terms by number (from 1) and how often each holds them."""

    keys: list[int]
    numbers: dict[bytes, int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[int, bytes | None]]) -> QuerySet:
        numbers: dict[bytes, int] = {}
        keys, terms, repeats = [], [], []
        for key, text in rows:
            held = Counter(numbers.setdefault(t, len(numbers) + 1) for t in terms_of(text))
            keys.append(key)
            terms.append(np.fromiter(held.keys(), np.int64, len(held)))
            repeats.append(np.fromiter(held.values(), np.int64, len(held)))
        return cls(keys, numbers, terms, repeats)


@dataclass
class Impacts:
    """What vectors are made of once the corpus is counted."""

    weights: np.ndarray
    documents: int
    all_terms: int

    def __call__(self, n: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """What one occurrence in a query adds, for entries of documents with ``n`` terms (one for each entry)."""
        m = 25 + (75 * n * self.documents) // max(self.all_terms, 1)
        return self.weights[terms] * ((1_000_000_000 * counts) // (1_000 * counts + 8 * m))


class _Vectors:
    """Some documents' vectors, entry by entry in order of documents."""

    def __init__(self, batch: pa.RecordBatch, impacts: Impacts):
        ids = batch.column("doc_id")
        self.unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        self.doc_ids = ids.fill_null(0).to_numpy()
        terms = [np.frombuffer(x, "<u4") for x in batch.column("terms").to_pylist()]
        self.sizes = np.array([len(x) for x in terms], np.int64)
        self.terms = np.concatenate([*terms, np.empty(0, "<u4")]).astype(np.int64)
        counts = np.concatenate([*(np.frombuffer(x, "<u4") for x in batch.column("counts").to_pylist()), np.empty(0, "<u4")])
        self.impacts = impacts(np.repeat(batch.column("n").to_numpy(), self.sizes), self.terms, counts.astype(np.int64))
        owner = np.repeat(np.arange(len(terms)), self.sizes)
        self.lengths = np.sqrt(np.bincount(owner, self.impacts.astype(float) ** 2, len(terms)))

    def buckets(self) -> Iterator[_Bucket]:
        """Vectors by falling length, some at a time."""
        order = np.argsort(-self.lengths, kind="stable")
        starts = np.cumsum(self.sizes) - self.sizes
        for begin in range(0, len(order), BUCKET):
            rows = order[begin : begin + BUCKET]
            sizes = self.sizes[rows]
            at = np.repeat(starts[rows] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            yield _Bucket(self, rows, np.repeat(np.arange(len(rows)), sizes), self.terms[at], self.impacts[at])


class _Bucket:
    """Vectors of similar length, entry by entry in order of terms."""

    def __init__(self, vectors: _Vectors, rows: np.ndarray, owners: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        order = np.argsort(terms, kind="stable")
        self.doc_ids, self.unnamed, self.lengths = vectors.doc_ids[rows], vectors.unnamed[rows], vectors.lengths[rows]
        self.owners, self.impacts = owners[order], impacts[order]
        self.held, starts = np.unique(terms[order], return_index=True)
        self.bounds = np.append(starts, len(terms))
        self.largest = np.maximum.reduceat(self.impacts, starts) if len(starts) else np.empty(0, np.int64)

    def above(self, terms: np.ndarray, repeats: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows that reach a score, and their scores; ``least`` is 1 or more."""
        none = np.empty(0, np.int64)
        if not len(self.held) or math.sqrt(float(repeats @ repeats)) * self.lengths[0] * ROOM < least:
            return none, none
        at = np.searchsorted(self.held, terms).clip(max=len(self.held) - 1)
        there = self.held[at] == terms
        at, repeats = at[there], repeats[there]
        order = np.argsort(-(repeats * self.largest[at]), kind="stable")
        at, repeats = at[order], repeats[order]
        # what the coordinates from a place on can add at most: their largest values, or Cauchy-Schwarz
        by_value = np.append(np.cumsum((repeats * self.largest[at])[::-1])[::-1], 0)
        by_length = np.append(np.sqrt(np.cumsum((repeats * repeats)[::-1])[::-1]), 0.0)
        rest = np.minimum(by_value, by_length * self.lengths[0] * ROOM)
        focus = int(np.argmax(rest < least))  # the last is 0
        scores, seen = np.zeros(len(self.lengths), np.int64), np.zeros(len(self.lengths))
        for a, r in zip(at[:focus].tolist(), repeats[:focus].tolist()):
            own, values = self._of(a)
            scores[own] += r * values
            seen[own] += values.astype(float) ** 2
        open_length = np.sqrt(np.maximum(self.lengths**2 * ROOM - seen, 0))
        possible = scores + np.minimum(by_value[focus], by_length[focus] * open_length * ROOM)
        left = (scores > 0) & (possible * ROOM >= least)
        if left.any():
            for a, r in zip(at[focus:].tolist(), repeats[focus:].tolist()):
                own, values = self._of(a)
                scores[own] += r * values
        rows = np.flatnonzero(left & (scores >= least))
        return rows, scores[rows]

    def _of(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        entries = slice(self.bounds[place], self.bounds[place + 1])
        return self.owners[entries], self.impacts[entries]


def _best(k: int, scores: np.ndarray, unnamed: np.ndarray, doc_ids: np.ndarray) -> np.ndarray:
    """Places of the ``k`` highest scores; equal ones by doc_id, without one last."""
    return np.lexsort((doc_ids, unnamed, -scores))[:k]


class _Search:
    """The best documents of every query so far."""

    def __init__(self, queries: QuerySet, k: int, least: np.ndarray):
        self.queries, self.k, self.least = queries, k, least.copy()
        empty = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)
        self.best = [empty] * len(queries.keys)

    def read(self, vectors: _Vectors) -> None:
        for bucket in vectors.buckets():
            for q, (terms, repeats) in enumerate(zip(self.queries.terms, self.queries.repeats)):
                rows, scores = bucket.above(terms, repeats, int(self.least[q]))
                if len(rows):
                    new = scores, bucket.unnamed[rows], bucket.doc_ids[rows]
                    held = [np.concatenate(x) for x in zip(self.best[q], new)]
                    first = _best(self.k, *held)
                    self.best[q] = tuple(x[first] for x in held)
                    if len(first) == self.k:
                        self.least[q] = max(self.least[q], held[0][first[-1]])

    def rows(self) -> pa.RecordBatch:
        keys = np.repeat(np.array(self.queries.keys, np.int64), [len(b[0]) for b in self.best])
        scores, unnamed, doc_ids = (np.concatenate(x) for x in zip(*self.best)) if self.best else (np.empty(0),) * 3
        columns = [pa.array(keys), pa.array(doc_ids, pa.int64(), mask=unnamed.astype(bool)), pa.array(scores, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["query", "doc_id", "score"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of several batches together, as long as they are few and short."""
    held: list[pa.RecordBatch] = []

    def whole() -> pa.RecordBatch:
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        for begin in range(0, batch.num_rows, 2_048):
            part = batch.slice(begin, 2_048)
            entries = sum(p.column("terms").get_total_buffer_size() for p in held)
            if held and (sum(p.num_rows for p in held) + part.num_rows > CHUNK or entries > 4 * CHUNK_ENTRIES):
                yield whole()
                held.clear()
            held.append(pa.RecordBatch.from_pydict({n: pa.concat_arrays([part.column(n)]) for n in part.schema.names}))
    if held:
        yield whole()


def term_vectors(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Number of terms of every document that has one, and which of the given terms it holds how often."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value.get
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if words := terms_of(text):
                    held = Counter(filter(None, map(number, words)))
                    terms, counts = (np.fromiter(x, "<u4", len(held)).tobytes() for x in (held.keys(), held.values()))
                    rows.append((doc_id, len(words), terms, counts))
            types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 4, types)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(vectors, VECTORS)


def _impacts(vectors: DataFrame, n_terms: int) -> Impacts:
    """Weights of the terms, from how many documents hold each; the driver sees a number a term."""

    def holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms + 1, np.int64)
        for batch in batches:
            for held in batch.column("terms").to_pylist():
                counts[np.frombuffer(held, "<u4")] += 1
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], ["term", "n"])

    documents, all_terms = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    summed = vectors.select("terms").mapInArrow(holders, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    weights = np.zeros(n_terms + 1, np.int64)
    for row in summed.collect():
        weights[row["term"]] = math.floor(1000 * math.log((2 * documents + 2) / (2 * row["n"] + 1)))
    return Impacts(weights, documents, all_terms)


def _thresholds(vectors: DataFrame, queries: QuerySet, impacts: Impacts, k: int) -> np.ndarray:
    """A score of each query that ``k`` documents reach: that of the longest vectors of all."""

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _chunks(batches):
            length = _Vectors(batch, impacts).lengths
            longest = np.argsort(-length, kind="stable")[:SEEDS]
            yield batch.take(pa.array(longest)).append_column("length", pa.array(length[longest]))

    seeds = vectors.mapInArrow(lengths, f"{VECTORS}, length double").orderBy(F.desc("length")).limit(SEEDS).drop("length")
    search = _Search(queries, k, np.ones(len(queries.keys), np.int64))
    for batch in seeds.toArrow().combine_chunks().to_batches():
        search.read(_Vectors(batch, impacts))
    return search.least


def _first_k(ranked: DataFrame, k: int, *groups: Column) -> DataFrame:
    window = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return ranked.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each item (``item_id``, ``text``): ``item_id``, ``rank``, ``doc_id`` and ``score``.

    Items are answered in blocks of a bounded size, each against all documents; a block's terms and thresholds are sent to
    all tasks, and a task returns at most ``k`` rows an item.

    NULL or empty texts: no terms, so not counted and never found; an item without terms finds nothing. NULL doc_id: ranked
    after others of equal score. Repeated documents: each is ranked. Repeated items: one; an id with several texts is
    ranked for each. Empty tables: no rows. Other columns are not read.
    """
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).distinct()
    count, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-count // QUERIES_AT_ONCE), -(-size // QUERY_BYTES), 1)
    asked = stored(asked.withColumn("query", F.monotonically_increasing_id()), "ranking-items")
    answers = [_answer(docs, asked.where(F.pmod("query", F.lit(blocks)) == b), k) for b in range(blocks)]
    found = answers[0]
    for more in answers[1:]:
        found = found.unionByName(more)
    nearly = _first_k(found, k, F.col("query"), F.pmod(F.xxhash64("doc_id"), F.lit(RANK_GROUPS))).drop("rank")
    best = _first_k(nearly, k, F.col("query"))
    return best.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def _answer(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Each task's best documents of one block of queries."""
    rows = asked.select("query", F.col("text").cast("binary").alias("text")).collect()
    queries = QuerySet.of([(r["query"], None if r["text"] is None else bytes(r["text"])) for r in rows])
    vectors = stored(term_vectors(docs, queries.numbers), "ranking-vectors")
    impacts = _impacts(vectors, len(queries.numbers))
    least = _thresholds(vectors, queries, impacts, k)
    shared = docs.sparkSession.sparkContext.broadcast((queries, impacts, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, impacts, least = shared.value
        search = _Search(queries, k, least)
        for batch in _chunks(batches):
            search.read(_Vectors(batch, impacts))
        yield search.rows()

    return vectors.mapInArrow(search, "query long, doc_id long, score long")
