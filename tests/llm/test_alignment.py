import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from sluicegate.llm import alignment, pieces

A, B = (public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = ["  a", "a  b", "x \n\n y", "\n", "a\n b \n", "\ttab\t x", "a <|endoftext|> b", "<s>x</s>", "\x1ca b", "\xa0 x y", "it's 'll don't",
       "1,234.5%%%", "​q", "é ñ 日本語", "\U0001f642\U0001f642 ok", "\r\n\r\n x", "a\x85b", "İİ", "▁a b", "a▁", "<0x41>", "\x00 x", "Å",
       "naïve### A!)", "word,word", "   ", " "]


class Plain:
    """The contract, token by token."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        self.back = {s: b for b, s in pieces.byte_signs().items()}

    def tokens(self, text):
        side_a = [(t.id, bytes(self.back[c] for c in self.a.id_to_token(t.id)))
                  for t in map(Token, self.a.encode(" " + text, add_special_tokens=False).ids)]
        side_b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            side_b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        return side_a, side_b

    def align(self, text):
        """Links with their numbers, and the groups."""
        if not text:
            return 0, 0, [], ""
        sides = self.tokens(text)
        if any(b"".join(x for _, x in side) != (" " + text).encode() for side in sides):
            return 0, 0, [], ""
        spans = []
        for side in sides:
            at, own = 0, []
            for i, x in side:
                own.append((i, at, at + len(x)))
                at += len(x)
            spans.append(own)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        common = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, begin = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in spans))
            begin = end
        return len(spans[0]), len(spans[1]), links, ";".join(groups)


class Token:
    def __init__(self, i):
        self.id = i


@pytest.fixture(scope="module")
def plain():
    return Plain()


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


def pairs_of(links):
    a, b = (np.array(x, np.int64) for x in (list(zip(*links)) or [(), ()]))
    return sorted(alignment.pair_of(a, b).tolist())


def check(plain, aligner, texts):
    for text, (numbers, pairs, groups) in zip(texts, aligner(texts), strict=True):
        n_a, n_b, links, shown = plain.align(text)
        assert numbers.tolist() == [n_a, n_b, shown.count("|"), len(links)], repr(text)
        assert groups == shown and sorted(pairs.tolist()) == pairs_of(links)


def test_odd_texts(plain, aligner):
    assert aligner.plain and aligner.cuts
    check(plain, aligner, ["", *ODD, " ".join(ODD), "one two\nthree four"])


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.text(st.sampled_from(" \n\tabAB1'.,<|>é▁́\U0001f642s#") | st.characters(codec="utf-8"), max_size=25), max_size=4))
def test_segments_align_as_whole_texts(plain, aligner, texts):
    check(plain, aligner, texts)


def test_forgetting_changes_nothing(plain, monkeypatch):
    small = alignment.Aligner(A, B)
    small.segments.generation_bytes = 3_000
    monkeypatch.setattr(alignment, "SEGMENTS_AT_ONCE", 50)
    draw = random.Random(2)
    words = ["one", "two,", "(three)", "four's", "été", "x" * 300, *(f"W{i}" for i in range(40))]
    check(plain, small, [" ".join(draw.choices(words, k=30)) for _ in range(30)])


@settings(max_examples=100, deadline=None)
@given(runs=st.lists(st.dictionaries(st.integers(0, (1 << 40) - 1) | st.integers(0, 40), st.integers(1, 1 << 40)), max_size=7))
def test_merging_runs_adds_counts(runs):
    frame, alignment.FRAME = alignment.FRAME, 3
    try:
        packed = [alignment.pair_frames(*(np.array(x, np.uint64) for x in zip(*sorted(r.items())))) for r in runs if r]
        merged = [alignment.read_frame(f) for f in alignment.merge(packed)]
    finally:
        alignment.FRAME = frame
    wanted = Counter()
    for r in runs:
        wanted.update(r)
    assert [p for pairs, _ in merged for p in pairs.tolist()] == sorted(wanted)
    assert {p: n for pairs, counts in merged for p, n in zip(pairs.tolist(), counts.tolist())} == wanted


def wanted_rows(plain, docs):
    found = [(d, *plain.align(t)) for d, t in docs]
    counts = Counter(p for _, _, _, links, _ in found for p in set(links))
    highest = Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    rows = []
    for doc_id, n_a, n_b, links, groups in found:
        best = sum(counts[p] == highest[p[0]] for p in links)
        rows.append((doc_id, n_a, n_b, groups.count("|"), len(links), best, sum(counts[p] for p in links), groups))
    return sorted(rows, key=str)


@pytest.mark.parametrize("blocks", [1, 40])
def test_same_rows_as_counting_in_memory(spark, plain, odd_docs, no_docs, blocks):
    draw = random.Random(5)
    words = [f"{draw.choice(['re', 'un', 'X', ''])}{w}{draw.choice(['ing', ',', '', 's'])}" for w in "the of walk house über 漢字 tree".split()] * 3
    rows = [(i % 50, " ".join(draw.choices(words, k=draw.randrange(30)))) for i in range(120)] + [(900 + i, t) for i, t in enumerate(ODD)]
    rows += [(r["doc_id"], r["text"]) for r in odd_docs.collect() if r["doc_id"] != 9]  # the plain version is quadratic
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"block": F.lit(1), "radix": F.lit("x")})
    got = alignment.align(docs.repartition(blocks), A, B)
    assert sorted(map(tuple, got.collect()), key=str) == wanted_rows(plain, rows)
    assert got.schema.simpleString() == "struct<" + alignment.ALIGNED.replace(" long", ":bigint").replace(" string", ":string").replace(", ", ",") + ">"


def test_very_long_and_empty(spark, odd_docs, no_docs):
    (row,) = alignment.align(odd_docs.where("doc_id = 9"), A, B, kept=lambda g: str(g.count("|"))).collect()
    assert int(row["groups"]) == row["n_groups"] > 100_000 and row["n_best"] > 0
    assert row["count_sum"] == row["n_links"]
    assert alignment.align(no_docs, A, B).count() == 0
    nothing = alignment.align(odd_docs.where("text IS NULL OR text = ''"), A, B).collect()
    assert len(nothing) == 3 and all(tuple(r)[1:] == (0,) * 6 + ("",) for r in nothing)
