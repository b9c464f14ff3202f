"""Language-model scoring by cross-entropy difference: a target and a background n-gram model over one shared vocabulary.

The vocabulary is every word of either side, and one more for words of neither. Words are runs of ASCII letters, digits and
two-byte characters, with A-Z lower-cased; other characters but white space stand alone, those of three and more bytes too, so
scripts without white space come as characters. Models of bytes (all 256, and a sign for a text's begin) are kept as well.

Texts are encoded once, block by block. A block sends each of its n-grams once, with its counts, to the bucket of the n-gram's
hash; there the counts of all blocks are added and go back to the blocks that hold documents to score. So both tables of counts
are Spark's, grow with the texts, and nothing of them reaches the driver; a frequent n-gram is one entry of each block. Both
models have the same order, vocabulary and smoothing, and the background counts are scaled to the target's number of tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .alignment import pack, unpack
from .base import stored

#: Tokens of the longest n-grams, unless said otherwise.
ORDER = 4
#: Weight, in tokens, of the model of next lower order in the estimate of a higher one.
PRIOR = 5.0
#: Bytes of text that are cut into words together, tokens and texts of a block, tokens whose n-grams meet in one bucket.
BYTES_AT_ONCE, BLOCK_TOKENS, BLOCK_DOCS, BUCKET_TOKENS = 1 << 20, 1_500_000, 65_536, 2_000_000
#: Roles of texts; those that are scored and are the background too have both.
SCORED, BACKGROUND, TARGET = 1, 2, 4


def _symbols() -> np.ndarray:
    """Symbol of each byte; 0 begins a text."""
    return np.arange(1, 257, dtype=np.uint16)


SYMBOL_OF = _symbols()
SYMBOLS = len(SYMBOL_OF) + 1

SPACE, IN_WORD, ALONE, FOLLOWS = range(4)


def _kinds() -> np.ndarray:
    """Of each byte: white space, part of words, begin of a character that stands alone, or what follows in a character."""
    of = np.full(256, ALONE, np.uint8)
    of[[32, *range(9, 14)]] = SPACE
    of[48:58] = of[65:91] = of[97:123] = of[192:224] = IN_WORD
    of[128:192] = FOLLOWS
    return of


KIND_OF = _kinds()
#: Random weights of bytes in hashes of words, the same for A-Z as for a-z, and the base of the powers of their places.
WEIGHT_OF = np.random.default_rng(20).integers(1, 1 << 64, 256, np.uint64, endpoint=False)
WEIGHT_OF[65:91] = WEIGHT_OF[97:123]
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number's bits spread over all 64, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_ids(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the bytes of texts, and how many each text has."""
    return SYMBOL_OF[np.frombuffer(b"".join(bodies), np.uint8)].astype(np.uint64), np.array([len(b) for b in bodies], np.int64)


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of bytes begin, and their hashes. The first and last byte are white space."""
    kind = KIND_OF[data]
    stray = np.flatnonzero((kind[1:] == FOLLOWS) & (data[:-1] < 128)) + 1  # follows no character: stands alone
    kind[stray] = ALONE
    chars = np.flatnonzero(kind != FOLLOWS)
    kind = kind[chars]
    begins = kind == ALONE
    begins[1:] |= (kind[1:] == IN_WORD) & (kind[:-1] != IN_WORD)
    edges = np.flatnonzero(begins | (kind == SPACE))
    is_word = np.flatnonzero(begins[edges])
    edges = chars[edges]
    lengths = np.diff(edges, append=len(data))
    places = np.arange(len(data)) - np.repeat(edges, lengths)
    powers = np.cumprod(np.full(int(lengths.max()), BASE, np.uint64))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(WEIGHT_OF[data] * powers[places], dtype=np.uint64)))
    starts, ends = edges[is_word], edges[is_word] + lengths[is_word]
    ids = mixed(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))
    return starts, np.where(ids == 0, np.uint64(1), ids)  # 0 begins a text


def _cuts(body: bytes) -> Iterator[bytes]:
    """A long text in pieces that no word spans."""
    at, size = 0, BYTES_AT_ONCE
    while len(body) - at > size:
        kind = KIND_OF[np.frombuffer(body, np.uint8, size, at)]
        breaks = np.flatnonzero((kind == SPACE) | (kind == ALONE))
        if len(breaks) and breaks[-1]:
            yield body[at : at + int(breaks[-1])]
            at, size = at + int(breaks[-1]), BYTES_AT_ONCE
        else:
            size *= 2
    yield body[at:]


def word_ids(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts, and how many each text has."""
    found, counts = [np.zeros(0, np.uint64)], np.zeros(len(bodies), np.int64)
    pieces = [(i, piece) for i, body in enumerate(bodies) for piece in _cuts(body)]
    sizes = np.cumsum([len(piece) for _, piece in pieces])
    for part in np.split(np.arange(len(pieces)), np.flatnonzero(np.diff(sizes // BYTES_AT_ONCE)) + 1):
        some = [pieces[k][1] for k in part]
        starts, ids = _words(np.frombuffer(b" ".join([b"", *some, b""]), np.uint8))
        ends = np.cumsum([len(piece) + 1 for piece in some])
        np.add.at(counts, [pieces[k][0] for k in part], np.diff(np.searchsorted(starts, ends), prepend=0))
        found.append(ids)
    return np.concatenate(found), counts


def encoded(texts: DataFrame, doc_id: Column, role: int, of_words: bool) -> DataFrame:
    """Blocks of whole texts, the first column of ``texts``: ids of their rows, numbers of tokens, and all tokens, packed as a
    list of the block's different tokens and places in it."""
    ids_of, most, most_docs = word_ids if of_words else byte_ids, BLOCK_TOKENS, BLOCK_DOCS
    rows = texts.select(F.col(texts.columns[0]).cast("binary").alias("text"), doc_id.alias("doc_id"))
    schema = f"block long, role int, doc_ids array<{rows.schema['doc_id'].dataType.simpleString()}>, counts array<long>, n long, tokens binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = (role << 56) + (TaskContext.get().partitionId() << 32)
        docs, counts, ids, n, kind = [], [], [], 0, pa.null()

        def row() -> pa.RecordBatch:
            nonlocal block, n
            known, at = np.unique(np.concatenate(ids), return_inverse=True)
            values = [block, role, docs, np.concatenate(counts).tolist(), n, pack(np.diff(known, prepend=np.uint64(0)), at)]
            types = [pa.int64(), pa.int32(), pa.list_(kind), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            made = [pa.array([v], t) for v, t in zip(values, types)]
            for held in (docs, counts, ids):
                held.clear()
            block, n = block + 1, 0
            return pa.RecordBatch.from_arrays(made, ["block", "role", "doc_ids", "counts", "n", "tokens"])

        for batch in batches:
            kind = batch.schema.field("doc_id").type
            bodies = [b or b"" for b in batch.column("text").to_pylist()]
            of_part, doc_ids = np.cumsum([len(b) for b in bodies]) // BYTES_AT_ONCE, batch.column("doc_id").to_pylist()
            for part in np.split(np.arange(len(bodies)), np.flatnonzero(np.diff(of_part)) + 1):
                found = ids_of([bodies[i] for i in part])
                docs += [doc_ids[i] for i in part]
                ids.append(found[0])
                counts.append(found[1])
                n += len(found[0])
                if n >= most or len(docs) >= most_docs:
                    yield row()
        if docs:
            yield row()

    return rows.mapInArrow(encode, schema)


class Opened:
    """A block's texts in rows: one where a text with tokens begins, then one for each of its tokens."""

    def __init__(self, tokens: bytes, counts: list[int]):
        steps, at = unpack(tokens, 2)
        self.counts = np.array(counts, np.int64)
        lengths = self.counts[self.counts > 0]
        ends = np.cumsum(lengths + 1)
        self.begins = ends - lengths - 1
        self.is_token = np.ones(len(at) + len(lengths), bool)
        self.is_token[self.begins] = False
        self.is_followed = np.ones(len(self.is_token), bool)
        self.is_followed[ends - 1] = False
        self.ids = np.zeros(len(self.is_token), np.uint64)
        self.ids[self.is_token] = np.cumsum(steps, dtype=np.uint64)[at.astype(np.int64)]

    def before(self, of_rows: np.ndarray) -> np.ndarray:
        """What the rows before have; of no meaning where a text begins."""
        return np.roll(of_rows, 1)

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order up to ``order``, the ascending hashes of the n-grams that end in the rows, and each row's place."""
        hashes, begin = np.zeros(len(self.ids), np.uint64), np.uint64(0)
        for k in range(1, order + 1):
            hashes = self.before(hashes)
            hashes[self.begins] = begin
            hashes = mixed(hashes * BASE + self.ids + np.uint64(k))
            begin = hashes[0] if len(hashes) else begin
            yield np.unique(hashes, return_inverse=True)


def sent_grams(blocks: DataFrame, orders: range, bits: int) -> DataFrame:
    """A block's n-grams, a row for each order and bucket (the ``bits`` first bits of the hash): hashes as differences, how
    often each occurs, and how much more often than a token follows it."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.zeros(1, np.uint64)
        for batch in batches:
            for row in batch.to_pylist():
                opened = Opened(row["tokens"], row["counts"])
                for order, (known, at) in enumerate(opened.grams(orders[-1]), 1):
                    if order not in orders:
                        continue
                    counts = [np.bincount(at[of], minlength=len(known)) for of in (opened.is_token, opened.is_followed)]
                    columns = counts[0], counts[0] - counts[1]
                    edges = [*np.searchsorted(known, firsts), len(known)]
                    made = [
                        (bucket, pack(np.diff(known[a:b], prepend=np.uint64(0)), *(c[a:b] for c in columns)))
                        for bucket, (a, b) in enumerate(zip(edges, edges[1:])) if a < b
                    ]
                    buckets, frames = zip(*made) if made else ((), ())
                    n = len(made)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([order] * n, pa.int32()), pa.array(buckets, pa.int64()), pa.array([row["block"]] * n, pa.int64()),
                         pa.array([row["role"]] * n, pa.int32()), pa.array(frames, pa.binary())],
                        ["order", "bucket", "block", "role", "frame"],
                    )

    needed = blocks.select("block", "role", "counts", "tokens")
    return needed.mapInArrow(send, "order int, bucket long, block long, role int, frame binary")


class Bucket:
    """The n-grams of a bucket from all blocks: places of the blocks' n-grams among them, and both counts of either side."""

    def __init__(self, rows: pa.Table):
        parts = [unpack(f, 3) for f in rows.column("frame").to_pylist()]
        self.roles = rows.column("role").to_pylist()
        self.edges = np.cumsum([0, *(len(p[0]) for p in parts)]).tolist()
        _, self.at = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
        self.counts = [np.zeros(int(self.at.max()) + 1, np.int64) for _ in range(4)]
        for role, part, a, b in zip(self.roles, parts, self.edges, self.edges[1:]):
            for k, side in enumerate((TARGET, BACKGROUND)):
                if role & side:
                    for count, own in zip(self.counts[2 * k :], part[1:]):
                        count[self.at[a:b]] += own.astype(np.int64)  # a block has an n-gram once


def words_known(rows: pa.Table) -> pa.Table:
    """How many words of a bucket occur on either side."""
    of_target, _, of_background, _ = Bucket(rows).counts
    return pa.table({"n": pa.array([np.count_nonzero(of_target + of_background)], pa.int64())})


def added_counts(rows: pa.Table) -> pa.Table:
    """For each block with documents to score, the whole corpus' counts of the n-grams it has sent to a bucket."""
    bucket, found = Bucket(rows), []
    for i, (a, b) in enumerate(zip(bucket.edges, bucket.edges[1:])):
        if bucket.roles[i] & SCORED:
            found.append((i, pack(*(count[bucket.at[a:b]] for count in bucket.counts))))
    kept = rows.select(["block", "order", "bucket"]).take(pa.array([i for i, _ in found], pa.int64()))
    return kept.append_column("frame", pa.array([f for _, f in found], pa.binary()))


def block_losses(block: dict, frames: list[tuple[int, int, bytes]], order: int, sizes: tuple[int, int, int]) -> np.ndarray:
    """Mean losses of a block's documents, a row for each model, smoothed from order to order down to a common base."""
    of_vocabulary, *totals = sizes
    scales = [1.0, totals[0] / totals[1] if all(totals) else 1.0]
    opened, losses = Opened(block["tokens"], block["counts"]), np.zeros((2, len(block["counts"])))
    chances, contexts = [], totals
    for k, (_, at) in enumerate(opened.grams(order if len(opened.ids) else 0), 1):
        parts = [unpack(f, 4) for of, _, f in sorted(frames) if of == k]
        own = [np.concatenate(c).astype(np.int64)[at] for c in zip(*parts)]
        if k == 1:
            chances = [(own[0] + own[2] + 1) / (sum(totals) + of_vocabulary)] * 2
        chances = [
            (scale * n + PRIOR * chance) / (scale * seen + PRIOR)
            for scale, n, seen, chance in zip(scales, own[::2], contexts, chances)
        ]
        contexts = [opened.before(n - more) for n, more in zip(own[::2], own[1::2])]
    lengths = opened.counts[opened.counts > 0]
    for loss, chance in zip(losses, chances):
        loss[opened.counts > 0] = np.add.reduceat(-np.log(chance[opened.is_token]), np.cumsum(lengths) - lengths) / lengths
    return losses


def score_documents(docs: DataFrame, target: DataFrame, background: DataFrame, of_words: bool = False, order: int = ORDER) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_tokens``, ``target_loss``, ``background_loss`` and ``score``.

    Losses are means in nats over the text's tokens; ``score`` is their difference, target less background, so the lower
    the more a text is like the target. ``target`` and ``background`` have one column of texts each. Tokens are bytes, or
    words with ``of_words``; n-grams have up to ``order``. If the background is the text of ``docs`` itself, it is read once.

    NULL or empty text, or one without words: no tokens, losses and score 0. NULL id: kept. Repeated rows: each scored. Empty
    ``target`` or ``background``: the common base stands in. Empty ``docs``: no rows. Other columns are not read.
    """
    texts, nobody = docs.select("text"), F.lit(None).cast(docs.schema["doc_id"].dataType)
    is_own = texts.sameSemantics(background.select(background.columns[0]))
    blocks = encoded(docs.select("text", "doc_id"), F.col("doc_id"), SCORED | BACKGROUND if is_own else SCORED, of_words)
    blocks = blocks.unionByName(encoded(target, nobody, TARGET, of_words))
    blocks = stored(blocks if is_own else blocks.unionByName(encoded(background, nobody, BACKGROUND, of_words)), "token-blocks")

    totals = {r["role"]: r["n"] for r in blocks.groupBy("role").agg(F.sum("n").alias("n")).collect()}  # three roles
    bits = max(0, (sum(totals.values()) // BUCKET_TOKENS).bit_length())
    of_sides = [sum(n for role, n in totals.items() if role & side) for side in (TARGET, BACKGROUND)]
    if of_words:
        words = sent_grams(blocks, range(1, 2), bits).groupBy("order", "bucket").applyInArrow(words_known, "n long")
        of_vocabulary = (words.agg(F.sum("n")).first()[0] or 0) + 1
    else:
        of_vocabulary = SYMBOLS
    sizes = (of_vocabulary, *of_sides)

    def score(block: pa.Table, added: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        frames = list(zip(*(added.column(c).to_pylist() for c in ("order", "bucket", "frame"))))
        losses = block_losses(row, frames, order, sizes)
        doc_ids = pa.array(row["doc_ids"], block.schema.field("doc_ids").type.value_type)
        return pa.table([doc_ids, pa.array(row["counts"], pa.int64()), *map(pa.array, losses)], ["doc_id", "n_tokens", "target_loss", "background_loss"])

    grams = sent_grams(blocks, range(1, order + 1), bits).groupBy("order", "bucket")
    added = grams.applyInArrow(added_counts, "block long, order int, bucket long, frame binary")
    scored = blocks.where(F.col("role").bitwiseAND(SCORED) > 0).select("block", "doc_ids", "counts", "tokens")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = scored.groupBy("block").cogroup(added.groupBy("block")).applyInArrow(score, f"doc_id {kind}, n_tokens long, target_loss double, background_loss double")
    return found.withColumn("score", F.col("target_loss") - F.col("background_loss"))
