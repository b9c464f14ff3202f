import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings, strategies as st
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluicegate.llm import frames, pieces, tokens

WORDS, BYTES = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "  a", "a  b", "x \n\n y", "\ttab\t", "a <|endoftext|> b", "a  <|endoftext|>\n", "\x1ca b", "\xa0 x y", "it's 'll don't",
       "1,234.5%%%", "​q", "é ñ 日本語", "\U0001f642\U0001f642 ok", "\r\n\r\n x", "a\x85b", "'s s'", "İİ",
       "<|startoftext|>x", "ΣΣ Σ", "Å", "יִ"]
PIECES = st.text(st.sampled_from(" \n\t\r\xa0\x1c\x85abAB1'.,<|>é́\U0001f642"), max_size=40)


@pytest.fixture(scope="module")
def byte_level():
    return pieces.ByteIds(BYTES), Tokenizer.from_file(BYTES)


@settings(max_examples=300, deadline=None)
@given(text=PIECES)
def test_pieces_encode_as_whole_texts(byte_level, text):
    encoder, library = byte_level
    assert next(iter(encoder(pa.array([text])))).tolist() == library.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(byte_level, monkeypatch):
    _, library = byte_level
    monkeypatch.setattr(pieces.ByteIds, "PIECES_AT_ONCE", 20)
    encoder = pieces.ByteIds(BYTES)
    encoder.known.generation_bytes = 2_000
    draw = random.Random(2)
    words = ["one", "two,", "(three)", "four's", "5.5", "été", "w" * 400, "a\nb", "a\n", "É!!", *(f"x{i}" for i in range(50))]
    texts = ODD + [" ".join(draw.choices(words, k=30)) for _ in range(60)]
    assert encoder.splits
    assert [x.tolist() for x in encoder(pa.array(texts))] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert all(len(r.young) + len(r.young.old) < 200 for r in (encoder.known, encoder.parts, encoder.others, encoder.tails))


def test_folders_are_those_of_sparks_own_store(spark, tmp_path):
    assert frames.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert frames.store_at(frames.qualified(spark, "/ckpt/x")) == (fs.LocalFileSystem(), "/ckpt/x")
    hadoop = spark._jsc.hadoopConfiguration()
    before = hadoop.get("fs.defaultFS")
    hadoop.set("fs.defaultFS", "hdfs://127.0.0.1:9/")
    try:
        assert frames.qualified(spark, "/ckpt/x") == "hdfs://127.0.0.1:9/ckpt/x"
    finally:
        hadoop.set("fs.defaultFS", before)


def test_counts_are_the_librarys(spark, odd_docs, no_docs, monkeypatch):
    library = Tokenizer.from_file(WORDS)
    more = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = odd_docs.select("doc_id", "text").union(more)
    for frequent in (tokens.FREQUENT, 3):
        monkeypatch.setattr(tokens, "FREQUENT", frequent)
        got = sorted(map(str, tokens.count_tokens(docs, WORDS, 50).collect()))
        wanted = []
        for r in docs.collect():
            n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
            size = len((r["text"] or "").encode())
            wanted.append(f"Row(doc_id={r['doc_id']}, n_bytes={size}, n_tokens={n}, over_limit={n > 50})")
        assert got == sorted(wanted)
    assert tokens.count_tokens(no_docs, WORDS).count() == 0


def test_frequent_words_are_found_when_tables_overflow(spark, monkeypatch):
    monkeypatch.setattr(tokens, "COUNTED", 50)
    texts = spark.range(400).selectExpr("concat('common also ', id, ' common ', id * 7)").toDF("text")
    assert tokens.frequent_words(texts)[:2] == [b"common", b"also"]


def test_shards_round_trip(spark, odd_docs, no_docs, tmp_path):
    library = Tokenizer.from_file(BYTES)
    manifest = frames.write_token_ids(odd_docs, str(tmp_path / "shards"), BYTES)
    got = frames.scan_shards(manifest, frames.crc32).orderBy("start").collect()
    rows = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in rows]
    start, of = 0, {}
    for r in rows:
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        of.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
    for r in got:
        assert r["start"] == start and (r["n_tokens"], r["value"]) in of[r["doc_id"]]
        start += r["n_tokens"]
    assert sum(r["n_docs"] for r in manifest.collect()) == len(rows)
    assert not [p for p in (tmp_path / "shards").iterdir() if p.name.startswith("_attempt")]
    paths = manifest.select("path").crossJoin(spark.createDataFrame([(7,), (5,)], "doc_id long"))
    some = {r["doc_id"]: r["ids"] for r in frames.read_documents(spark, "", paths).collect()}
    assert some == {5: [0], 7: [*library.encode("one", add_special_tokens=False).ids, 0]}
    empty = frames.write_token_ids(no_docs, str(tmp_path / "none"), BYTES)
    assert empty.count() == 0 and frames.scan_shards(empty, frames.crc32).count() == 0


class Watched:
    """An open file that notes the ranges it is asked for."""

    def __init__(self, content):
        self.content, self.at, self.ranges = content, 0, []

    def seek(self, at, whence=0):
        self.at = at if whence == 0 else len(self.content) + at
        return self.at

    def read(self, size):
        self.ranges.append((self.at, size))
        return self.content[self.at : self.at + size]


def test_readers_touch_only_what_they_need_and_see_damage(tmp_path):
    ids = [np.arange(i * 50, dtype="<u4").tobytes() for i in range(20)]
    with open(tmp_path / "s", "wb") as sink:
        assert frames.write_shard(sink, iter([(i or None, x) for i, x in enumerate(ids)])) == (20, sum(map(len, ids)) // 4)
    content = (tmp_path / "s").read_bytes()
    source = Watched(content)
    shard = frames.ShardReader(source)
    source.ranges.clear()
    assert shard.ids(7).tobytes() == ids[7] and source.ranges == [(shard.offsets[7], shard.entries["packed"][7])]
    assert shard.doc_ids == [None, *range(1, 20)]
    plain = zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True).read()
    assert plain == b"".join(ids)  # any decoder reads the frames and skips the tables
    broken = bytearray(content)
    broken[int(shard.offsets[7]) + 12] ^= 1
    hurt = frames.ShardReader(Watched(bytes(broken)))
    assert hurt.ids(8).tobytes() == ids[8]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        hurt.ids(7)
    with pytest.raises(ValueError):
        frames.ShardReader(Watched(content[:-1]))
