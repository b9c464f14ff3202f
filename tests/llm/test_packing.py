import random

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sluicegate.llm import packing, pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
SIGNS = "aB \n\t.,'!<|>éßÀñ1½ ́̇İΣσς漢\x01\x00x#&-sS\x85\x1cǅſK`^~​"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(SIGNS) | st.characters(codec="utf-8"), max_size=30), min_size=1, max_size=5))
def test_ids_are_the_librarys(library, texts):
    got = [x.tolist() for x in pieces.word_ids(PATH)(pa.array(texts, pa.string()))]
    assert got == [ids_of(library, t) for t in texts]


def test_special_strings_and_forgotten_pieces(library):
    encode = pieces.WordIds(PATH)
    encode.parts.generation_bytes = encode.others.generation_bytes = 2_000
    draw = random.Random(1)
    words = ["one", "Two,", "(three)", "four's", "5.5", "été", "x" * 400, "<|endoftext|>", "a<|ENDOFTEXT|>b", "<|startoftext|>c"]
    for _ in range(20):
        texts = [" ".join(draw.choices(words + [f"w{draw.randrange(500)}" for _ in range(9)], k=40)) for _ in range(10)]
        assert [x.tolist() for x in encode(pa.array(texts))] == [ids_of(library, t) for t in texts]
        assert all(len(r.young) + len(r.young.old) < 200 for r in (encode.parts, encode.others))


def test_bytes_that_are_no_text_are_replaced():
    assert pieces.as_texts(pa.array([b"a\xff", None, b"\xc3\xa9"], pa.binary())).to_pylist() == ["a�", "", "é"]


def test_differencing_of_a_known_case():
    at, sums = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)  # the method's own example: a difference of 2
    assert sorted(sums.tolist()) == [14, 16]
    assert sorted(np.bincount(at, [8, 7, 6, 5, 4]).tolist()) == [14, 16]


@settings(max_examples=100, deadline=None)
@given(sizes=st.lists(st.integers(1, 64), min_size=1, max_size=60), windows=st.integers(1, 9))
def test_sums_are_those_of_the_windows(sizes, windows):
    at, sums = packing.differencing(np.array(sizes), windows)
    assert sorted(np.bincount(at, sizes, windows).tolist()) == sorted(sums.tolist())
    at, windows = packing.deal(np.array(sizes), 64)
    assert np.bincount(at, sizes, windows).max() <= 64


def check(rows, texts, library, capacity):
    """Pieces hold every id once, in place, and sequences have no gaps."""
    by_text: dict = {}
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.doc_tokens, r.start)):
        assert r.length > 0 and len(r.ids) == 4 * r.length
        by_text.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, np.frombuffer(r.ids, "<u4").tolist()))
    wanted: dict = {}
    for doc_id, text in texts:
        ids = [*ids_of(library, text), 2]
        wanted.setdefault((doc_id, len(ids)), []).append(ids)
    assert by_text.keys() == wanted.keys()
    for key, whole in wanted.items():
        parts = sorted(by_text[key])
        assert sorted(x for _, ids in parts for x in ids) == sorted(x for ids in whole for x in ids)
        if len(whole) == 1:
            assert [x for _, ids in parts for x in ids] == whole[0]
            assert [s for s, _ in parts] == np.cumsum([0, *(len(i) for _, i in parts)])[:-1].tolist()
    windows: dict = {}
    for r in rows:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return windows


@pytest.mark.parametrize("capacity", [32, 4096])
def test_odd_documents_are_packed_whole(spark, odd_docs, no_docs, library, capacity):
    texts = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    rows = packing.pack(odd_docs.coalesce(2), PATH, capacity).collect()
    check(rows, texts, library, capacity)
    assert packing.pack(no_docs, PATH).count() == 0


def test_little_is_padded(spark, library):
    draw = random.Random(3)
    texts = [(i, " ".join(f"w{draw.randrange(300)}" for _ in range(int(draw.lognormvariate(4.5, 1.2)) + 1))) for i in range(3_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, PATH, 1024).collect()
    windows = check(rows, texts, library, 1024)
    padded = sum(1024 - n for n in (sum(x for _, x in p) for p in windows.values()) if n & (n - 1))
    assert padded < 0.02 * sum(r.length for r in rows)


def test_sequences_are_put_together(spark, odd_docs):
    made = packing.pack(odd_docs.coalesce(1), PATH, 64)
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(made).collect()}
    for r in made.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == np.frombuffer(r.ids, "<u4").tolist()
