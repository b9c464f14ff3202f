"""Alignment of two tokenizers' tokens over the same bytes, with counts of linked id pairs over all documents.

Counting is external. Tasks align their documents block by block, sort a block's (pair, document) records by pair, deal
them out by the low bits of the first side's id and keep each part as a run of zstandard frames in the shared folder. Runs
are merged some at a time through a heap of frames until there is one for each part: the number of documents that hold
each pair. As pairs come in order of the first side, its ids' highest counts come with them. Last, every block's runs meet
the counts of their part, and what they add to each document goes back to the block.
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .base import stored
from .pieces import Remembered, as_texts, byte_signs

#: Parts (low bits of the first side's id), bits of an id and of a document's place in its block.
RADIX_BITS, ID_BITS, PLACE_BITS = 4, 20, 20
#: Links and documents of a block, pairs of a frame, runs that are merged or read at once, segments that are looked up at once.
BLOCK_LINKS, BLOCK_DOCS, FRAME, FAN, SEGMENTS_AT_ONCE = 2_000_000, 8_192, 16_384, 16, 300_000
#: A space and what follows it up to white space, a line's end alone, other white space with what follows. No token of either
#: tokenizer spans two of these.
SEGMENT = re.compile(r" [^ \n]+|\n(?=[^ \n])|[ \n]*[^ \n]+|[ \n]+")
#: White space of other kinds, on which the two tokenizers may see segments differently; such texts are one segment.
ODD_SPACE = re.compile("[^\\S \n]|[\x1c-\x1f\x85᠎​▁﻿]")
#: A word of letters and signs after it, each one pre-token of the first tokenizer. The apostrophe is left out, as it may join
#: what follows.
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")

#: Bytes of a generation of remembered segments; what ends an A token's, an A side's, a group's and a text's part of the text.
REMEMBERED_BYTES, SEPARATORS = 144 << 20, np.array([",", "|", ";", "\n"], object)

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"
_MADE = (
    "block long, radix int, frames array<binary>, holders array<binary>, "
    "place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string"
)
_MADE_SCHEMA = pa.schema([
    ("block", pa.int64()), ("radix", pa.int32()), ("frames", pa.list_(pa.binary())), ("holders", pa.list_(pa.binary())),
    ("place", pa.int64()), ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")),
    ("groups", pa.string()),
])


def pack(*columns: np.ndarray) -> bytes:
    """Columns of unsigned 64-bit integers in a zstandard frame, bytes of equal weight side by side."""
    sizes = struct.pack(f"<{len(columns)}Q", *map(len, columns))
    shuffled = [np.ascontiguousarray(c, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([sizes, *shuffled]))


def unpack(frame: bytes, n: int) -> list[np.ndarray]:
    """The ``n`` columns of a frame."""
    content = zstandard.ZstdDecompressor().decompress(frame)
    at, columns = 8 * n, []
    for size in struct.unpack_from(f"<{n}Q", content):
        rows = np.frombuffer(content, np.uint8, 8 * size, at).reshape(8, size).T
        columns.append(np.ascontiguousarray(rows).view("<u8").ravel())
        at += 8 * size
    return columns


def pair_frames(pairs: np.ndarray, *columns: np.ndarray) -> list[bytes]:
    """A run: frames of ascending pairs, as differences, with further columns."""
    run = []
    for a in range(0, len(pairs), FRAME):
        own = slice(a, a + FRAME)
        run.append(pack(np.diff(pairs[own], prepend=np.uint64(0)), *(c[own] for c in columns)))
    return run


def read_frame(frame: bytes, columns: int = 2) -> list[np.ndarray]:
    pairs, *more = unpack(frame, columns)
    return [np.cumsum(pairs, dtype=np.uint64), *more]


def merge_runs(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending pairs with their summed counts, from runs of (pair, count) frames, one frame of each run at a time.

    The heap holds the last pair of every run's frame: up to the least of them all frames at hand are whole.
    """
    left = [iter(run) for run in runs]
    open_: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def advance(i: int) -> None:
        for frame in left[i]:
            pairs, counts = read_frame(frame)
            open_[i] = pairs, counts
            heapq.heappush(heap, (int(pairs[-1]), i))
            return
        open_.pop(i, None)

    for i in range(len(runs)):
        advance(i)
    while heap:
        end, ended, taken = heap[0][0], [], []
        while heap and heap[0][0] == end:
            ended.append(heapq.heappop(heap)[1])
        for i, (pairs, counts) in list(open_.items()):
            n = int(np.searchsorted(pairs, np.uint64(end), "right"))
            if n:
                taken.append((pairs[:n], counts[:n]))
                open_[i] = pairs[n:], counts[n:]
        for i in ended:
            advance(i)
        pairs, counts = (np.concatenate(c) for c in zip(*taken))
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        first = np.flatnonzero(np.diff(pairs, prepend=pairs[:1] + np.uint64(1)))
        yield pairs[first], np.add.reduceat(counts, first)


def merge(runs: list[list[bytes]]) -> list[bytes]:
    """One run out of several."""
    merged, held, size = [], [], 0
    for part in merge_runs(runs):
        held.append(part)
        size += len(part[0])
        if size >= FRAME:
            merged += pair_frames(*(np.concatenate(c) for c in zip(*held)))
            held, size = [], 0
    return merged + (pair_frames(*(np.concatenate(c) for c in zip(*held))) if held else [])


class Aligner:
    """Tokens of a byte-level ``tokenizers`` file (A) and of a ``sentencepiece`` model (B) over the same bytes."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.model_a, self.signs = self.a.model, byte_signs()
        back = {ord(s): b for b, s in self.signs.items()}
        vocabulary = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        shown = [vocabulary.get(i, "") for i in range(max(vocabulary) + 1)]
        self.bytes_a = [bytes(back.get(ord(c), ord(c) & 0xFF) for c in t) for t in shown]
        content = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as f:
            content.ParseFromString(f.read())
        content.normalizer_spec.add_dummy_prefix = False  # the space before a text is written out
        self.b = SentencePieceProcessor(model_proto=content.SerializeToString())
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << ID_BITS:
            raise ValueError(f"ids of more than {ID_BITS} bits")
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        kept_apart = all(" " not in t.lstrip(b" ").decode("latin-1") and b"\n" not in t[1:] + t[:-1] for t in self.bytes_b)
        probes = ("Word", " word", " naïve...", "É###", " x_&&", "a,", " (", " A!)")
        matched = [(m.groups(), p) for p in probes if (m := PLAIN.fullmatch(p))]
        self.plain = all(self._part(x) + self._part(y) == self._whole(p) for (x, y), p in matched)
        self.cuts = kept_apart and self._whole("a b\nc") == [i for s in ("a", " b", "\n", "c") for i in self._whole(s)]
        self.shown_ids = np.array([str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))], object)
        self.segments = Remembered(self.align, REMEMBERED_BYTES)

    def _whole(self, text: str) -> list[int]:
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _part(self, part: str) -> list[int]:
        """Ids of one pre-token of A."""
        if not part:
            return []
        shown = part.replace(" ", self.signs[32]) if part.isascii() else part.encode().decode("latin-1").translate(self.signs)
        return [t.id for t in self.model_a.tokenize(shown)]

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        plain = [PLAIN.fullmatch(t) if self.plain else None for t in texts]
        others = iter(self.a.encode_batch_fast([t for t, m in zip(texts, plain) if not m], add_special_tokens=False))
        return [self._part(m[1]) + self._part(m[2]) if m else next(others).ids for m in plain]

    def align(self, texts: list[str]) -> list[bytes]:
        """For each text four 32-bit numbers (of A's tokens, B's tokens, groups and links), the links' pairs and the groups as
        text. The numbers are 0 for a text whose bytes either side's tokens do not give back.
        """
        sides = self._ids_a(texts), self.b.encode(texts, num_threads=1)
        bodies = [t.encode() for t in texts]
        whole, sizes = b"".join(bodies), np.array([len(t) for t in bodies], np.int64)
        good = np.ones(len(texts), bool)
        for ids, names in zip(sides, (self.bytes_a, self.bytes_b)):
            joined = [b"".join(map(names.__getitem__, own)) for own in ids]
            if b"".join(joined) != whole or (np.array([len(t) for t in joined], np.int64) != sizes).any():
                good &= [x == y for x, y in zip(joined, bodies)]
        good &= sizes > 0
        found = [bytes(16)] * len(texts)
        if good.any():
            kept = np.flatnonzero(good).tolist()
            for i, result in zip(kept, self._linked(*([ids[i] for i in kept] for ids in sides))):
                found[i] = result
        return found

    def _linked(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> Iterator[bytes]:
        """The same for texts that both sides give back, laid end to end."""
        sides = []
        for ids, sizes in ((ids_a, self.sizes_a), (ids_b, self.sizes_b)):
            numbers = np.array([len(x) for x in ids], np.int64)
            tokens = np.array([x for own in ids for x in own], np.int64)
            ends = np.cumsum(sizes[tokens])
            sides.append((numbers, tokens, ends, ends - sizes[tokens]))
        (n_a, a, ends_a, starts_a), (n_b, b, ends_b, starts_b) = sides
        common = np.intersect1d(ends_a, ends_b)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        first, last = np.searchsorted(ends_b, starts_a, "right"), np.searchsorted(starts_b, ends_a, "left")
        n = last - first
        other = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        pairs = pair_of(np.repeat(a, n), b[other])
        text_ends = ends_a[np.cumsum(n_a) - 1]
        up_to_group = np.searchsorted(common, text_ends, "right")
        n_groups = np.diff(up_to_group, prepend=0)
        up_to_link = np.cumsum(n)[np.cumsum(n_a) - 1]
        shown = self._shown(a, group_a, b, group_b, up_to_group - 1)
        counts = np.stack((n_a, n_b, n_groups, np.diff(up_to_link, prepend=0)), 1).astype("<u4").tobytes()
        linked, begin = pairs.tobytes(), 0
        for i, (end, text) in enumerate(zip((8 * up_to_link).tolist(), shown)):
            yield counts[16 * i : 16 * i + 16] + linked[begin:end] + text.encode()
            begin = end

    def _shown(self, a, group_a, b, group_b, last: np.ndarray) -> list[str]:
        """Groups as text, ``a1,a2|b1;a3|b2``, for texts that end with the given groups."""
        order = np.argsort(np.concatenate((2 * group_a, 2 * group_b + 1)), kind="stable")
        ids, groups = np.concatenate((a, b))[order], np.concatenate((group_a, group_b))[order]
        of_b = order >= len(a)
        ends = np.append((groups[1:] != groups[:-1]) | (of_b[1:] != of_b[:-1]), True)
        ends_text = np.zeros(int(groups.max()) + 1, bool)
        ends_text[last] = True
        sign = np.where(ends, np.where(of_b, np.where(ends_text[groups], 3, 2), 1), 0)
        parts = [""] * (2 * len(ids))
        parts[::2], parts[1::2] = self.shown_ids[ids].tolist(), SEPARATORS[sign].tolist()
        return "".join(parts).split("\n")[:-1]

    def __call__(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        """(the four numbers; the links' pairs; the groups as text) of each document."""
        held, size = [], 0
        for text in texts:
            cuts = self.cuts and not ODD_SPACE.search(text)
            held.append((SEGMENT.findall(f" {text}") if cuts else [f" {text}"]) if text else [])
            size += len(held[-1])
            if size >= SEGMENTS_AT_ONCE:
                yield from self._of_segments(held)
                held, size = [], 0
        yield from self._of_segments(held)

    def _of_segments(self, texts: list[list[str]]) -> Iterator[tuple[np.ndarray, np.ndarray, str]]:
        coded = pa.array([s for own in texts for s in own], pa.large_string()).dictionary_encode()
        found, places = self.segments(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), coded.indices.to_numpy()
        counts = np.frombuffer(b"".join(f[:16] for f in found), "<u4").reshape(-1, 4).astype(np.int64)
        ends = (16 + 8 * counts[:, 3]).tolist()
        pairs = np.frombuffer(b"".join(f[16:e] for f, e in zip(found, ends)), "<u8")
        shown = [f[e:].decode() for f, e in zip(found, ends)]
        links = counts[:, 3]
        starts, begin = np.cumsum(links) - links, 0
        for own in texts:
            at = places[begin : begin + len(own)]
            begin += len(own)
            if not len(at) or not counts[at, 0].all():
                yield np.zeros(4, np.int64), np.empty(0, "<u8"), ""
                continue
            sizes = links[at]
            gathered = np.repeat(starts[at] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
            yield counts[at].sum(0), pairs[gathered], ";".join(map(shown.__getitem__, at.tolist()))


def pair_of(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs as numbers: the part of the first side's id, the rest of it, the second side's id."""
    a, b = a.astype("<u8"), b.astype("<u8")
    part = a & np.uint64((1 << RADIX_BITS) - 1)
    return (part << np.uint64(2 * ID_BITS - RADIX_BITS)) | ((a >> np.uint64(RADIX_BITS)) << np.uint64(ID_BITS)) | b


class _Block:
    """Documents whose records are sorted together."""

    def __init__(self):
        self.docs, self.keys, self.links = [], [], 0

    def add(self, doc_id: int | None, numbers: np.ndarray, pairs: np.ndarray, groups: str | None) -> None:
        self.keys.append((pairs << np.uint64(PLACE_BITS)) | np.uint64(len(self.docs)))
        self.docs.append((doc_id, *numbers.tolist(), groups))
        self.links += len(pairs)

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """A row for each document, and one for the run of each part."""
        names = ("place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
        docs = [dict(zip(names, (i, *d)), block=block) for i, d in enumerate(self.docs)]
        for begin in range(0, len(docs), 1_000):
            yield pa.RecordBatch.from_pylist(docs[begin : begin + 1_000], _MADE_SCHEMA)
        keys, times = np.unique(np.concatenate([*self.keys, np.empty(0, np.uint64)]), return_counts=True)
        pairs, places = keys >> np.uint64(PLACE_BITS), keys & np.uint64((1 << PLACE_BITS) - 1)
        first = np.flatnonzero(np.diff(pairs, prepend=np.uint64(1 << 63)))
        holders = np.diff(np.append(first, len(pairs)))
        parts = (pairs[first] >> np.uint64(2 * ID_BITS - RADIX_BITS)).astype(np.int64)
        bounds = np.searchsorted(parts, np.arange((1 << RADIX_BITS) + 1))
        for part, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if a == b:
                continue
            held = []
            for f in range(a, b, FRAME):
                own = slice(first[f], first[min(f + FRAME, b)] if min(f + FRAME, b) < len(first) else len(pairs))
                held.append(pack(places[own], times[own]))
            row = {"block": block, "radix": part, "frames": pair_frames(pairs[first[a:b]], holders[a:b]), "holders": held}
            yield pa.RecordBatch.from_pylist([row], _MADE_SCHEMA)


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two files."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


def _records(docs: DataFrame, path_a: str, path_b: str, kept: Callable[[str], str]) -> DataFrame:
    """Documents' numbers, and runs of their records."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, block, number = aligner(path_a, path_b), _Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = as_texts(batch.column("text"))
            whole = [t.as_py() if t.as_buffer() is not None else "" for t in texts]
            raw = batch.column("text").to_pylist()
            # bytes that are no text cannot be given back
            whole = [t if r is None or t.encode() == r else "" for t, r in zip(whole, raw)]
            for doc_id, (numbers, pairs, groups) in zip(batch.column("doc_id").to_pylist(), align(whole)):
                block.add(doc_id, numbers, pairs, kept(groups) if numbers[0] else "")
                if block.links >= BLOCK_LINKS or len(block.docs) >= BLOCK_DOCS:
                    yield from block.rows(number)
                    block, number = _Block(), number + 1
        if block.docs:
            yield from block.rows(number)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(made, _MADE)


def _counted(runs: DataFrame, blocks: int) -> DataFrame:
    """One run of (pair, documents) for each part, merged ``FAN`` runs at a time."""

    def merged(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        radix, part = (k.as_py() for k in key)
        run = merge(rows.column("frames").to_pylist())
        return pa.table({"radix": pa.array([radix], pa.int32()), "part": pa.array([part], pa.int64()),
                         "frames": pa.array([run], pa.list_(pa.binary()))})

    parts, named = -(-blocks // FAN), F.xxhash64("block")
    while True:
        runs = runs.select("radix", F.pmod(named, F.lit(parts).cast("long")).alias("part"), "frames")
        runs = runs.groupBy("radix", "part").applyInArrow(merged, "radix int, part long, frames array<binary>")
        if parts == 1:
            return runs.select("radix", "frames")
        parts, named = -(-parts // FAN), F.col("part")


def _contributions(runs: DataFrame, counted: DataFrame, blocks: int) -> DataFrame:
    """What each run adds to its block's documents: (``block``, ``added``)."""
    parts = -(-blocks // FAN)

    def read(left: pa.Table, right: pa.Table) -> pa.Table:
        totals = [read_frame(f) for run in right.column("frames").to_pylist() for f in run]
        out = []
        if left.num_rows and totals:
            known, counts = (np.concatenate(c) for c in zip(*totals))
            ids = known >> np.uint64(ID_BITS)
            first = np.flatnonzero(np.diff(ids, prepend=ids[:1] + np.uint64(1)))
            highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(ids))))
            is_best = (counts == highest).astype(np.int64)
            counts = counts.astype(np.int64)
            for row in range(left.num_rows):
                best, total = np.zeros(1 << PLACE_BITS, np.int64), np.zeros(1 << PLACE_BITS, np.int64)
                last = 0
                for frame, held in zip(left.column("frames")[row].as_py(), left.column("holders")[row].as_py()):
                    pairs, n = read_frame(frame)
                    places, times = (c.astype(np.int64) for c in unpack(held, 2))
                    at = np.repeat(np.searchsorted(known, pairs), n.astype(np.int64))
                    np.add.at(best, places, is_best[at] * times)
                    np.add.at(total, places, counts[at] * times)
                    last = max(last, int(places.max()) + 1)
                out.append({"block": left.column("block")[row].as_py(), "added": pack(best[:last], total[:last])})
        return pa.Table.from_pylist(out, pa.schema([("block", pa.int64()), ("added", pa.binary())]))

    placed = runs.select("radix", F.pmod(F.xxhash64("block"), F.lit(parts).cast("long")).alias("part"), "block", "frames", "holders")
    spread = counted.select("radix", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), "frames")
    return placed.groupBy("radix", "part").cogroup(spread.groupBy("radix", "part")).applyInArrow(read, "block long, added binary")


def align(docs: DataFrame, path_a: str, path_b: str, kept: Callable[[str], str] = str) -> DataFrame:
    """Alignment of every text of ``docs`` (with a space before it) under a byte-level ``tokenizers`` file A and a
    ``sentencepiece`` model B, without special tokens.

    Offsets at which tokens of both end cut a text into groups; tokens that overlap are linked. Per row of ``docs``:
    ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose pair of ids is in as many documents as
    any pair of its A id), ``count_sum`` (documents that hold the pair, summed over links) and ``groups``, ids as
    ``a1,a2|b1;a3|b2``, or what ``kept`` makes of that text.

    NULL or empty texts, and such that either side's tokens do not give back: no tokens, zeros and ``''``. NULL id: kept.
    Repeated rows: each is a document. Empty table: no rows. Other columns are not read.
    """
    made = stored(_records(docs, path_a, path_b, kept), "alignment")
    runs = made.where("radix IS NOT NULL").select("radix", "block", "frames", "holders")
    blocks = max(1, made.agg(F.count_if(F.col("place") == 0)).first()[0])
    counted = stored(_counted(runs.select("radix", "block", "frames"), blocks), "alignment-counts")
    added = _contributions(runs, counted, blocks)

    def complete(left: pa.Table, right: pa.Table) -> pa.Table:
        best, total = np.zeros(left.num_rows, np.int64), np.zeros(left.num_rows, np.int64)
        for frame in right.column("added").to_pylist():
            for held, more in zip((best, total), unpack(frame, 2)):
                held[: len(more)] += more.astype(np.int64)
        places = left.column("place").to_numpy()
        found = {"n_best": pa.array(best[places], pa.int64()), "count_sum": pa.array(total[places], pa.int64())}
        names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
        return pa.table({n: found[n] if n in found else left.column(n) for n in names})

    documents = made.where("radix IS NULL").select("block", "place", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
    return documents.groupBy("block").cogroup(added.groupBy("block")).applyInArrow(complete, ALIGNED)
