"""Token counts by map-side lookup in two tiers: a broadcast table of frequent pre-tokens' lengths, then worker caches.

A pre-token is what stands between ASCII white space. The tokenizer never forms a token across white space, so a text's
count is the sum over its pre-tokens. Texts stay where they are read; only short lists of frequent pre-tokens move.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Pre-tokens of the broadcast table, and of the list that each task proposes for it; longer ones are not proposed.
FREQUENT, PROPOSED, LONGEST = 50_000, 50_000, 64
#: Pre-tokens a task counts before it drops the rare ones, and those a worker remembers besides the frequent.
COUNTED, REMEMBERED = 1_000_000, 1_000_000
TEXTS_AT_ONCE = 256


class FrequentTable:
    """Pre-tokens and their lengths in tokens, packed into three arrays; at most ``FREQUENT`` * ``LONGEST`` bytes of words."""

    def __init__(self, words: list[bytes], lengths: list[int]):
        self.blob = b"".join(words)
        self.sizes = np.array([len(w) for w in words], np.uint8)
        self.lengths = np.array(lengths, np.uint16)

    def as_dict(self) -> dict[bytes, int]:
        ends = np.cumsum(self.sizes, dtype=np.int64).tolist()
        return {self.blob[a:b]: n for a, b, n in zip([0, *ends], ends, self.lengths.tolist())}


class Lengths:
    """Counts the tokens of pre-tokens, each encoded once by the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()

    def __call__(self, words: list[bytes]) -> list[int]:
        texts = [w.decode("utf-8", "replace") for w in words]
        return [len(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_lengths: dict[str, Lengths] = {}
_caches: dict[str, dict[bytes, int]] = {}


def lengths_of(path: str) -> Lengths:
    """The worker's counter under a tokenizer file."""
    if path not in _lengths:
        _lengths[path] = Lengths(path)
    return _lengths[path]


def frequent_words(texts: DataFrame) -> list[bytes]:
    """The pre-tokens that are frequent in ``texts`` (one column of text), over all of it.

    Each task counts what it reads, letting rare ones go when its table is full, and proposes a bounded list; the lists
    are summed and the largest sums are kept. What is missed costs time later, never a wrong count.
    """

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    counts.update(text.split())
                if len(counts) > COUNTED:
                    counts = Counter(dict(counts.most_common(COUNTED // 4)))
        best = [(w, n) for w, n in counts.most_common(PROPOSED) if n > 1 and len(w) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in best], pa.binary()), pa.array([n for _, n in best], pa.int64())], ["word", "n"]
        )

    proposed = texts.select(F.col(texts.columns[0]).cast("binary").alias("text")).mapInArrow(propose, "word binary, n long")
    summed = proposed.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(FREQUENT)
    return [bytes(r.word) for r in summed.collect()]


def token_count(texts: DataFrame, path: str) -> Callable[[Column], Column]:
    """A counter for columns of text as bytes, after the frequent pre-tokens of ``texts`` have been found and sent out."""
    words = frequent_words(texts)
    table = FrequentTable(words, lengths_of(path)(words))
    shared = texts.sparkSession.sparkContext.broadcast(table)
    name = uuid.uuid4().hex

    @F.pandas_udf("long")
    def count(bodies: pd.Series) -> pd.Series:
        encode, found = lengths_of(path), []
        if name not in _caches:
            _caches.clear()
            _caches[name] = shared.value.as_dict()
        frequent = len(shared.value.sizes)
        for begin in range(0, len(bodies), TEXTS_AT_ONCE):
            split = [(t or b"").split() for t in bodies[begin : begin + TEXTS_AT_ONCE]]
            distinct, known = set().union(*split), _caches[name]
            missing = [w for w in distinct if w not in known]
            if len(known) + len(missing) > frequent + REMEMBERED:
                known = _caches[name] = shared.value.as_dict()
                missing = [w for w in distinct if w not in known]
            known.update(zip(missing, encode(missing)))
            found += [sum(map(known.__getitem__, words)) for words in split]
        return pd.Series(found, dtype="int64")

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row of ``docs`` under a tokenizers file.

    NULL or empty text: 0 bytes and tokens. NULL id: kept. Repeated rows: each counted. Empty table: no rows. Other
    columns are not read.
    """
    count = token_count(docs.select("text"), path)
    counted = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        count(docs["text"].cast("binary")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
