"""Token ids in binary shards: one independent zstandard frame a document, and a seek table at the end.

A shard is a valid stream of zstandard's seekable format: frames, then skippable frames that plain decoders pass over.

    frame*                    a document's ids as little-endian unsigned 32-bit integers
    skippable 0x184D2A50      the documents' ids: n bytes (1 if there is an id) and n signed 64-bit integers
    skippable 0x184D2A5E      n entries (compressed size, size, low 32 bits of the content's XXH64), then n,
                              a descriptor byte and the magic number 0x8F92EAB1, so that readers start at the end

A reader fetches the two tables and then only the byte ranges of the documents it wants, checking each by its checksum.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .pieces import GENERATION_BYTES, as_texts, byte_ids

#: Fixed values of the seekable format.
SKIPPABLE_IDS, SKIPPABLE_SEEK, SEEKABLE_MAGIC, HAS_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
FOOTER = struct.Struct("<IBI")
SEEK_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])


def write_shard(sink, documents: Iterator[tuple[int | None, bytes]], level: int = 3) -> tuple[int, int]:
    """Writes (doc_id, ids) in their order to an open file; number of documents and of ids."""
    pack = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
    entries, names, total = [], [], 0
    for doc_id, ids in documents:
        frame = pack(ids)
        sink.write(frame)
        entries.append((len(frame), len(ids), xxhash.xxh64_intdigest(ids) & 0xFFFFFFFF))
        names.append(doc_id)
        total += len(ids) // 4
    there = np.array([x is not None for x in names], np.uint8)
    known = np.array([x or 0 for x in names], "<i8")
    table = there.tobytes() + known.tobytes()
    sink.write(struct.pack("<II", SKIPPABLE_IDS, len(table)) + table)
    seek = np.array(entries, SEEK_ENTRY).tobytes() + FOOTER.pack(len(entries), HAS_CHECKSUMS, SEEKABLE_MAGIC)
    sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek)
    return len(entries), total


class ShardReader:
    """Random access to a shard through an open, seekable file."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2)
        n, descriptor, magic = FOOTER.unpack(self._read(end - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE_MAGIC or descriptor != HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the shard")
        seek_at = end - FOOTER.size - n * SEEK_ENTRY.itemsize
        self.entries = np.frombuffer(self._read(seek_at, n * SEEK_ENTRY.itemsize), SEEK_ENTRY)
        self.offsets = np.concatenate(([0], np.cumsum(self.entries["packed"], dtype=np.int64)))
        names = self._read(int(self.offsets[-1]) + 8, n * 9)
        there, known = np.frombuffer(names[:n], np.uint8), np.frombuffer(names[n:], "<i8")
        self.doc_ids = [int(k) if t else None for t, k in zip(there, known)]

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def __len__(self) -> int:
        return len(self.entries)

    def ids(self, index: int) -> np.ndarray:
        """Ids of the document at a place; no other frame is read."""
        entry = self.entries[index]
        frame = self._read(int(self.offsets[index]), int(entry["packed"]))
        content = zstandard.ZstdDecompressor().decompress(frame, max_output_size=int(entry["size"])) if entry["size"] else b""
        if len(content) != entry["size"] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != entry["check"]:
            raise ValueError(f"document {index} of the shard is damaged")
        return np.frombuffer(content, "<u4")


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder as a URI, in the store that Spark itself would write it to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def store_at(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder given as URI or as local path."""
    return fs.FileSystem.from_uri(folder) if ":/" in folder else (fs.LocalFileSystem(), folder)


def write_token_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = 0, keep: bool = True) -> DataFrame:
    """Writes the ids of all ``docs`` in ascending order of doc_id, a shard per range of ids; its manifest.

    The manifest has ``shard`` (in order), ``path``, ``n_docs``, ``n_tokens`` and ``start``, the ids in all shards before;
    it is collected, a row a shard. A shard is written under a name of its attempt and then renamed, so lost or doubled
    tasks leave whole shards only.

    NULL or empty text: only the end id. NULL id: first in order, marked as without id. Repeated rows: each is written;
    equal ids are ordered by a hash of their text. Empty table: no shard. Other columns are not read. Without ``keep`` a
    worker remembers the ids of fewer pieces, and none after a shard.
    """

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        encode, end = byte_ids(tokenizer), b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        encode.bound(GENERATION_BYTES if keep else GENERATION_BYTES // 4)

        def documents() -> Iterator[tuple[int | None, bytes]]:
            for batch in batches:
                for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(as_texts(batch.column("text")))):
                    yield doc_id, ids.astype("<u4").tobytes() + end

        rows = documents()
        first = next(rows, None)
        if first is None:
            return
        system, base = store_at(folder)
        system.create_dir(base, recursive=True)
        number = context.partitionId()
        path, attempt = f"{base}/shard-{number:06d}.ids.zst", f"{base}/_attempt-{number:06d}-{uuid.uuid4().hex}"
        with system.open_output_stream(attempt) as sink:
            counts = write_shard(sink, (x for part in ((first,), rows) for x in part))
        system.move(attempt, path)
        if not keep:
            encode.forget()
        name = path.rsplit("/", 1)[1]
        yield pa.RecordBatch.from_pylist([{"shard": number, "name": name, "n_docs": counts[0], "n_tokens": counts[1]}])

    spark, mark = docs.sparkSession, F.xxhash64("text")
    folder = qualified(spark, folder)
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).repartitionByRange("doc_id", mark)
    ordered = ordered.sortWithinPartitions("doc_id", mark)
    written = ordered.mapInArrow(shard, "shard long, name string, n_docs long, n_tokens long").collect()
    manifest, start = [], 0
    for row in sorted(written, key=lambda r: r.shard):
        manifest.append((row.shard, f"{folder}/{row.name}", row.n_docs, row.n_tokens, start))
        start += row.n_tokens
    return spark.createDataFrame(manifest, "shard long, path string, n_docs long, n_tokens long, start long")


def scan_shards(manifest: DataFrame, of_document: Callable[[np.ndarray], int]) -> DataFrame:
    """(``doc_id``, ``start``, ``n_tokens``, ``value``) of every document, read back from the shards.

    ``start`` counts the ids of all documents before it and ``value`` is ``of_document(ids)``. One task reads a shard, a
    frame at a time.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            system, path = store_at(row["path"])
            with system.open_input_file(path) as source:
                shard, at = ShardReader(source), row["start"]
                for begin in range(0, len(shard), 10_000):
                    places = range(begin, min(begin + 10_000, len(shard)))
                    out: list[tuple[int, int, int]] = []
                    for i in places:
                        ids = shard.ids(i)
                        out.append((at, len(ids), of_document(ids)))
                        at += len(ids)
                    columns = [pa.array(shard.doc_ids[places.start : places.stop], pa.int64())]
                    columns += [pa.array(list(x), pa.int64()) for x in zip(*out)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "value"])

    shards = manifest.select("path", "start").coalesce(1).repartition(max(1, manifest.count()))
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, value long")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.tobytes())


def read_documents(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """(``doc_id``, ``ids``) of the documents named in ``wanted``, decompressing only their frames.

    ``wanted`` has ``path`` and ``doc_id`` (paths as in the manifest); each path is opened by one task.
    """

    def read(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        asked = set(rows.column("doc_id").to_pylist())
        system, path = store_at(key[0].as_py())
        with system.open_input_file(path) as source:
            shard = ShardReader(source)
            found = [(d, shard.ids(i).astype(np.int64).tolist()) for i, d in enumerate(shard.doc_ids) if d in asked]
        return pa.table({"doc_id": pa.array([d for d, _ in found], pa.int64()),
                         "ids": pa.array([x for _, x in found], pa.list_(pa.int64()))})

    return wanted.select("path", "doc_id").groupBy("path").applyInArrow(read, "doc_id long, ids array<long>")
