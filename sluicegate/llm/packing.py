"""Packing of token ids into sequences by multiway differencing, after Karmarkar and Karp.

Documents are encoded where they are read and packed there, some hundred sequences at a time: texts and ids never move.
Whole sequences are cut off long documents. What is left of the documents starts as one partition each, with all of its
ids in one window; the two partitions of the largest imbalance are merged, the fullest window of one with the emptiest of
the other, until one is left, whose windows are nearly equal. If the fullest is above the capacity, there is one window more.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .pieces import as_texts, word_ids

#: Ids that are packed together.
GROUP = 1 << 19
#: One in so many ids of a group lies in short pieces, cut from its longest documents: they even out what the others leave.
SHORT_IN, SHORT = 50, 64

PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_PIECE = pa.schema([(n, pa.binary() if n == "ids" else pa.int64()) for n in (c.split()[0] for c in PIECE.split(", "))])


def differencing(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """Deals sizes out to a number of windows: the window of each, and the windows' sums."""
    rows = [np.array([s, *[0] * (windows - 1)], np.int64) for s in sizes.tolist()]
    heap = [(-s, i) for i, s in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        met = rows[a] + rows[b][::-1]
        order = np.argsort(-met, kind="stable")
        merged = met[order]
        rows[a] = rows[b] = None
        rows.append(merged)
        merges.append((a, b, order))
        heapq.heappush(heap, (int(merged[-1] - merged[0]), len(rows) - 1))
    sums = rows[-1]
    slots: dict[int, np.ndarray] = {len(rows) - 1: np.arange(windows)}
    for node in range(len(rows) - 1, len(sizes) - 1, -1):
        a, b, order = merges[node - len(sizes)]
        at = np.empty(windows, np.int64)
        at[order] = slots.pop(node)
        slots[a], slots[b] = at, at[::-1]
    return np.array([slots[i][0] for i in range(len(sizes))], np.int64), sums


def deal(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The window of each size and the number of windows, the least for which differencing keeps to the capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        at, sums = differencing(sizes, windows)
        if sums.max() <= capacity:
            return at, windows
        windows += 1


def cut(lengths: list[int], capacity: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Pieces (document, start, length) of a group: those that fill a sequence each, and those to be dealt out."""
    whole = [(d, s, capacity) for d, n in enumerate(lengths) for s in range(0, n - n % capacity, capacity)]
    rest = [(d, n - n % capacity, n % capacity) for d, n in enumerate(lengths) if n % capacity]
    rest.sort(key=lambda p: (-p[2], p[0]))
    wanted, short, used = sum(p[2] for p in rest) // SHORT_IN, [], 0
    while rest[used:] and sum(p[2] for p in rest[:used]) < wanted:
        d, s, n = rest[used]
        short += [(d, s + x, min(SHORT, n - x)) for x in range(0, n, SHORT)]
        used += 1
    return whole, rest[used:] + short


class _Group:
    """Documents that are packed together."""

    def __init__(self, capacity: int):
        self.capacity, self.names, self.ids, self.open = capacity, [], [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.names.append(doc_id)
        self.ids.append(ids)
        self.open += len(ids) % self.capacity

    def pieces(self, first: int) -> tuple[int, Iterator[pa.RecordBatch]]:
        """How many sequences there are, and their pieces; sequences are numbered from ``first``."""
        whole, dealt = cut([len(x) for x in self.ids], self.capacity)
        at, windows = deal(np.array([p[2] for p in dealt], np.int64), self.capacity) if dealt else (np.empty(0, np.int64), 0)
        filled = np.zeros(windows, np.int64)
        rows = [(p, first + i, 0) for i, p in enumerate(whole)]
        for p, w in zip(dealt, at.tolist()):
            rows.append((p, first + len(whole) + w, int(filled[w])))
            filled[w] += p[2]
        return len(whole) + windows, (self._batch(rows[i : i + 1_000]) for i in range(0, len(rows), 1_000))

    def _batch(self, rows: list) -> pa.RecordBatch:
        columns = [
            [self.names[d] for (d, _, _), _, _ in rows], [s for (_, s, _), _, _ in rows], [n for (_, _, n), _, _ in rows],
            [self.ids[d][s : s + n].astype("<u4").tobytes() for (d, s, n), _, _ in rows],
            [len(self.ids[d]) for (d, _, _), _, _ in rows], [w for _, w, _ in rows], [o for _, _, o in rows],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECE)], schema=_PIECE)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all ``docs`` in sequences of at most ``capacity`` ids under a tokenizers file.

    Per piece ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids`` (little-endian unsigned 32-bit),
    ``doc_tokens`` (with the end id), ``sequence_id`` and ``offset`` in the sequence, without gaps. A sequence lies in the
    partition its documents were read in, so a task that is repeated makes whole sequences again.

    NULL or empty text: only the end id. NULL id: kept. Repeated rows: each packed. Empty table: no rows. Other columns
    are not read.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(tokenizer)
        next_id, group = TaskContext.get().partitionId() << 40, _Group(capacity)
        end = np.array([end_id], encode.dtype)
        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(as_texts(batch.column("text")))):
                group.add(doc_id, np.concatenate((ids, end)))
                if group.open >= GROUP or len(group.names) >= GROUP // 64:
                    made, pieces = group.pieces(next_id)
                    yield from pieces
                    next_id, group = next_id + made, _Group(capacity)
        yield from group.pieces(next_id)[1]

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(packed, PIECE)


def sequences(pieces: DataFrame) -> DataFrame:
    """(``sequence_id``, ``length``, ``ids``) of the sequences that ``pack``'s pieces make up, without padding.

    A sequence is one group and bounded by the capacity. No pieces: no rows.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda held, part: F.concat(held, part["ids"]))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
