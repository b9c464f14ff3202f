"""Quality classifier: a regularised quadratic discriminant over transformed statistics of a document's text.

Each class is a Gaussian with a shrinkage covariance; a score is the difference of the two log densities, from Mahalanobis
distances through Cholesky factors that are computed once and sent with the model. Sums for means and covariances come
from one pass over all labelled rows, reduced in each task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .base import stored

#: Classes of bytes: 0 other, 1 lower case, 2 upper case, 3 digit, 4 white space, 5 sentence marks, 6 other ASCII symbols, 7 above ASCII.
BYTE_CLASS = np.zeros(256, np.uint8)
BYTE_CLASS[33:127] = 6
BYTE_CLASS[97:123], BYTE_CLASS[65:91], BYTE_CLASS[48:58] = 1, 2, 3
BYTE_CLASS[[9, 10, 11, 12, 13, 32]] = 4
BYTE_CLASS[[ord(c) for c in ".,;:?'\"-"]] = 5
BYTE_CLASS[128:] = 7

FEATURES = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digits", "space", "sentence_marks", "symbols",
    "above_ascii", "lines_per_word", "distinct_words", "repeated_lines", "symbol_words", "upper_words", "longest_word",
)
#: Share of a class covariance that is replaced by the covariance within classes, and of that by its diagonal.
TOWARDS_POOLED, TOWARDS_DIAGONAL = 0.1, 0.1


def statistics(text: bytes | None) -> np.ndarray:
    """Transformed statistics of a whole text: logarithms of counts, and logits of shares smoothed by the text's length."""
    body = text or b""
    n = len(body)
    classes = BYTE_CLASS[np.frombuffer(body, np.uint8)]
    share = np.bincount(classes, minlength=8)
    words = body.split()
    lines = [line for line in body.split(b"\n") if line.strip()]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    symbol = np.flatnonzero(classes == 6)
    gaps = np.cumsum(classes == 4)
    with_symbol = len(np.unique(gaps[symbol])) if len(symbol) else 0
    upper = sum(map(bytes.isupper, words))

    def logit(part: float, whole: float) -> float:
        return float(np.log((part + 0.5) / (whole - part + 0.5)))

    return np.array([
        np.log1p(n), np.log1p(len(words)), np.log1p(lengths.mean()), np.log1p(lengths.std()), logit(share[2], n),
        logit(share[3], n), logit(share[4], n), logit(share[5], n), logit(share[6], n), logit(share[7], n),
        logit(min(len(lines), len(words)), len(words)), logit(len(set(words)), len(words)),
        logit(len(lines) - len(set(lines)), len(lines)), logit(min(with_symbol, len(words)), len(words)),
        logit(upper, len(words)), np.log1p(lengths.max()),
    ])


@dataclass(frozen=True)
class Discriminant:
    """Two Gaussians (rows: class 0, class 1) with the factors needed to score; without both classes a constant score."""

    constant: float
    means: np.ndarray | None = None
    inverse_factors: np.ndarray | None = None
    offsets: np.ndarray | None = None
    scale: float = 1.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for each row of statistics."""
        if self.means is None:
            return np.full(len(x), self.constant)
        density = [
            self.offsets[k] - 0.5 * np.square((x - self.means[k]) @ self.inverse_factors[k].T).sum(axis=1) for k in (0, 1)
        ]
        return 1 / (1 + np.exp(-np.clip(self.scale * (density[1] - density[0]), -500, 500)))


def discriminant(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant:
    """Model from each class's number of rows, sum of statistics and sum of their outer products."""
    total = counts.sum()
    if not counts.all():
        return Discriminant(constant=float(counts[1] / total) if total else 0.5)
    means = sums / counts[:, None]
    own = squares / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.tensordot(counts / total, own, 1)
    diagonal = np.diag(np.diag(pooled) + 1e-4)
    pooled = (1 - TOWARDS_DIAGONAL) * pooled + TOWARDS_DIAGONAL * diagonal
    # The smaller a class, the less its own covariance counts.
    trust = (1 - TOWARDS_POOLED) * counts / (counts + 2 * sums.shape[1])
    shrunk = trust[:, None, None] * own + (1 - trust)[:, None, None] * pooled
    factors = np.linalg.cholesky(shrunk)
    offsets = np.log(counts / total) - np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    # Statistics of one text depend on each other beyond what a Gaussian tells, so densities are tempered.
    return Discriminant(0.5, means, np.linalg.inv(factors), offsets, scale=0.5)


def document_statistics(text: Column) -> Column:
    """The statistics of a text as an array, in the order of ``FEATURES``."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return of(text.cast("binary"))


def fit(labelled: DataFrame) -> Discriminant:
    """Model of the rows ``x`` (statistics) and ``y`` (0 or 1; others are left out). Tasks send sums, never rows."""
    d = len(FEATURES)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))]
        for batch in batches:
            x = np.array(batch.column("x").to_pylist()).reshape(-1, d)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[y == k]
                for part, more in zip(parts, (len(own), own.sum(axis=0), own.T @ own)):
                    part[k] += more
        yield pa.RecordBatch.from_pydict({"sums": [np.concatenate([p.ravel() for p in parts])]})

    rows = labelled.filter("y IN (0, 1) AND x IS NOT NULL").select("x", F.col("y").cast("int"))
    summed = rows.mapInArrow(reduce, "sums array<double>").select(F.posexplode("sums").alias("at", "v"))
    by_place = {r["at"]: r["v"] for r in summed.groupBy("at").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([by_place.get(i, 0.0) for i in range(2 + 2 * d + 2 * d * d)])
    return discriminant(flat[:2], flat[2 : 2 + 2 * d].reshape(2, d), flat[2 + 2 * d :].reshape(2, d, d))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from. A NULL id is not held out, and finds no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(statistics: DataFrame, labels: DataFrame) -> DataFrame:
    """(``x``, ``y``) of the rows (doc_id, x) whose labels may be learned."""
    learned = labels.filter(~held_out(labels["doc_id"])).select(F.col("doc_id").alias("labelled_id"), F.col("quality").alias("y"))
    return statistics.join(learned, statistics["doc_id"] == learned["labelled_id"]).select("x", "y")


def score(model: Discriminant, x: Column) -> Column:
    """Probability of good quality from an array of statistics."""

    @F.pandas_udf("double")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(rows.to_numpy())) if len(rows) else [], dtype="float64")

    return of(x)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    NULL and empty texts have statistics and a score like any other. NULL or other labels are not learned; several labels
    of a document are learned each. With no label of one class the score is the other's share, with none it is 0.5.
    NULL id: scored, not held out. Repeated rows: each scored. Empty table: no rows.
    """
    rows = stored(docs.select("doc_id", document_statistics(docs["text"]).alias("x")), "statistics")
    model = fit(labelled(rows, labels))
    scored = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without those that score below the threshold; columns and order of columns as in ``docs``.

    Statistics are worked out once and stored beside the documents. NULL and empty texts, labels, ids, repeated rows and
    empty tables as in ``classify``; extra columns are kept.
    """
    name = "x"
    while name in docs.columns:
        name += "_"
    rows = stored(docs.withColumn(name, document_statistics(docs["text"])), "quality")
    model = fit(labelled(rows.select("doc_id", F.col(name).alias("x")), labels))
    return rows.filter(score(model, F.col(name)) >= threshold).select(*docs.columns)
