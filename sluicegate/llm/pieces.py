"""What workers remember of pieces of text: two generations of results, bounded in bytes."""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that one generation may hold, what an entry takes besides its content, and the longest piece that is remembered.
GENERATION_BYTES, ENTRY_BYTES, LONGEST = 96 << 20, 200, 256
#: Pieces that go to a library in one call.
PIECES_AT_ONCE = 2_000


class _Young(dict):
    """Results at hand; what is asked for in vain is taken over from the older generation or noted."""

    def __init__(self, old: dict):
        super().__init__()
        self.old, self.missed, self.size = old, set(), 0

    def __missing__(self, piece: Hashable) -> Any:
        found = self.old.get(piece)
        if found is None:
            self.missed.add(piece)
        else:
            self.keep(piece, found)
        return found

    def keep(self, piece: Hashable, result: Any) -> None:
        self[piece] = result
        self.size += ENTRY_BYTES + len(piece) + len(result)


class Remembered:
    """Results of a function of pieces, worked out many at a time, each once while it is remembered.

    When a generation is full it becomes the older one and the one before is dropped, so pieces in use stay. Results are
    bytes or strings, never None. Long pieces are worked out each time.
    """

    def __init__(self, work: Callable[[list], list], generation_bytes: int = GENERATION_BYTES):
        self.work, self.generation_bytes, self.young = work, generation_bytes, _Young({})

    def forget(self) -> None:
        self.young = _Young({})

    def __call__(self, pieces: list) -> list:
        """The result for every piece, in their order."""
        young = self.young
        found = list(map(young.__getitem__, pieces))
        if young.missed:
            missed, young.missed, long = list(young.missed), set(), {}
            for begin in range(0, len(missed), PIECES_AT_ONCE):
                part = missed[begin : begin + PIECES_AT_ONCE]
                for piece, result in zip(part, self.work(part), strict=True):
                    if len(piece) > LONGEST:
                        long[piece] = result
                    else:
                        young.keep(piece, result)
            for i, result in enumerate(found):
                if result is None:
                    found[i] = long[pieces[i]] if pieces[i] in long else young[pieces[i]]
        if young.size > self.generation_bytes:
            young.old = {}
            self.young = _Young(young)
        return found


def byte_signs() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable ones as themselves, the others from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def as_texts(column: pa.Array) -> pa.Array:
    """A column of bytes as texts, NULL as an empty one; bytes that are no UTF-8 are replaced."""
    column = column.fill_null(b"")
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([b.decode("utf-8", "replace") for b in column.to_pylist()], pa.string())


def _listed(column: pa.Array) -> list:
    """Values without NULLs, several times faster than ``to_pylist``."""
    return column.to_numpy(zero_copy_only=False).tolist()


class _Words:
    """Lookup of distinct words as a head, which is remembered among ``parts``, and signs after it.

    Other words, or all if words are not to be split, are remembered among ``others``.
    """

    SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

    splits: bool
    dtype: np.dtype
    parts: Remembered
    others: Remembered
    tails: Remembered

    def _of_words(self, words: pa.Array, plain_head: str, letters: str) -> tuple[list[bytes], np.ndarray]:
        """Packed ids of parts, and the two parts (a row each) that distinct words are made of."""
        if not self.splits:
            return [*self.others(_listed(words)), b""], np.stack((np.arange(len(words)), np.full(len(words), len(words))), 1)
        heads = pc.utf8_rtrim(words, characters=self.SIGNS)
        plain = pc.match_substring_regex(heads, plain_head)
        heads = pc.if_else(plain, heads, words).dictionary_encode()
        tails = pc.if_else(plain, pc.utf8_ltrim(words, characters=letters), "").dictionary_encode()
        is_part = pc.is_in(heads.dictionary, pc.unique(heads.dictionary.take(heads.indices.filter(plain))))
        is_part, names = _listed(is_part), _listed(heads.dictionary)
        parts = iter(self.parts([h for h, p in zip(names, is_part) if p]))
        others = iter(self.others([h for h, p in zip(names, is_part) if not p]))
        found = [next(parts) if p else next(others) for p in is_part] + self.tails(_listed(tails.dictionary))
        return found, np.stack((heads.indices.to_numpy(), tails.indices.to_numpy() + len(names)), 1)

    def _gathered(self, split: pa.Array, plain_head: str, letters: str) -> Iterator[np.ndarray]:
        """The ids of every list of words."""
        ends = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)))
        coded = pc.list_flatten(split).dictionary_encode()
        found, parts = self._of_words(coded.dictionary, plain_head, letters)
        ids, sizes = np.frombuffer(b"".join(found), self.dtype), np.fromiter(map(len, found), np.int64, len(found))
        sizes //= self.dtype.itemsize
        starts, places = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
            own = parts[places[a:b]].ravel()
            lengths = sizes[own]
            before = np.cumsum(lengths) - lengths
            yield ids[np.repeat(starts[own] - before, lengths) + np.arange(int(lengths.sum()))]


class WordIds(_Words):
    """Ids of texts under a tokenizers file whose tokens never span white space.

    The distinct words of many texts are looked up, and what is not remembered is encoded. A word of plain letters and signs
    after it is two pre-tokens, which the library's model takes as they are; other words go to the library as one text with
    a sign between them that has one id of its own. Texts that hold a special token's string go to the library whole.
    """

    SIGN = "\x01"
    #: Letters that stay the same however a text is normalised. The apostrophe is no sign here, as it may join what follows.
    LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff"
    letters = "".join(map(chr, [*range(0x61, 0x7B), *range(0xDF, 0xF7), *range(0xF8, 0x100)]))
    PROBES = ("Word", "\u00df\u00e9\u00f6\u00ff", "a.", "THE!)", "na\u00efve###", "x_&&")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.signs = self.tokenizer.model, byte_signs()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.parts = Remembered(lambda parts: list(map(self._part, parts)))
        self.tails, self.others = self.parts, Remembered(self._others, GENERATION_BYTES // 2)
        sign = self._ids(self.SIGN)
        apart = [*self._ids("a"), *sign, *self._ids("b")]
        if len(sign) != 1 or any(self._ids(f"a{s}{self.SIGN}{s}b") != apart for s in (" ", " \n", "\t")):
            raise ValueError("this tokenizer does not keep words between white space apart")
        self.sign = sign[0]
        self.folds = all(self._ids(x.lower()) == self._ids(x) for x in (*self.PROBES, "A", "QZ"))
        split = [(w.lower().rstrip(self.SIGNS), w) for w in self.PROBES]
        self.splits = self.folds and all(self._part(h) + self._part(w[len(h) :]) == self._packed(w) for h, w in split)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _packed(self, text: str) -> bytes:
        return np.array(self._ids(text), self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token."""
        if not part:
            return b""
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.signs)
        ids = [t.id for t in self.model.tokenize(shown)]
        return struct.pack(f"<{len(ids)}{'H' if self.dtype.itemsize == 2 else 'I'}", *ids)

    def _others(self, words: list[str]) -> list[bytes]:
        plain = [w for w in words if self.SIGN not in w]
        ids = np.array(self._ids("".join(f"{w} {self.SIGN} " for w in plain)), self.dtype)
        ends = np.flatnonzero(ids == self.sign).tolist()
        if len(ends) != len(plain):
            raise ValueError("this tokenizer does not keep words between white space apart")
        packed = iter([ids[a:b].tobytes() for a, b in zip([0, *(e + 1 for e in ends)], ends)])
        return [self._packed(w) if self.SIGN in w else next(packed) for w in words]

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (no NULL)."""
        lowered = pc.ascii_lower(texts)
        special = np.zeros(len(texts), bool)
        for token in self.special:
            special |= pc.match_substring(lowered, token).to_numpy(zero_copy_only=False)
        split = pc.ascii_split_whitespace(lowered if self.folds else texts)
        for i, ids in enumerate(self._gathered(split, f"^[{self.LETTERS}]+$", self.letters)):
            yield np.array(self._ids(texts[i].as_py()), self.dtype) if special[i] else ids


#: White space of which Python and the library's patterns may have different notions; such texts are encoded whole.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\u180e\u200b\ufeff]")
#: Text around one space and a word, or white space; byte-level tokenizers never join characters across these.
PIECES = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: Letters after at most one space and signs after them, each one pre-token. The apostrophe is left out, as it may join what
#: follows.
PLAIN = re.compile("( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\\[-`{-~]*)")


class ByteIds(_Words):
    """Ids of texts under a byte-level tokenizers file.

    Texts without runs of white space are split at single spaces and before line ends by Arrow, and their distinct words
    are looked up; pieces of other texts are found by a pattern. What is not remembered is encoded. Texts that hold a
    special token's string or odd white space go to the library whole.
    """

    PIECES_AT_ONCE = 300_000
    #: What a word that begins its text or line is written with, as all others have a space before them.
    FIRST, LINE = "\x00", "\n"
    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    letters = "\x00\n" + "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
    RUNS = "[ \n][ \n]|[\t-\t\v-\r\x00\x1c-\x1f\u0085\u00a0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        if self.tokenizer.normalizer is not None:
            raise ValueError("pieces of a text are encoded as they are, so the tokenizer must not normalise")
        self.model, self.signs = self.tokenizer.model, byte_signs()
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        probes = [(m.groups(), p) for p in ("Word", " word", " na\u00efve...", "\u00c9###", " x_&&") if (m := PLAIN.fullmatch(p))]
        self.splits = all(self._part(x) + self._part(y) == self._ids(p) for (x, y), p in probes)
        self.known, self.tails = Remembered(self._encoded), Remembered(self._encoded)
        self.parts, self.others = (Remembered(lambda words: self._encoded(list(map(self._piece, words)))) for _ in range(2))
        self.bound(GENERATION_BYTES)

    def bound(self, generation_bytes: int) -> None:
        """Bounds what is remembered, words foremost."""
        self.parts.generation_bytes = generation_bytes
        self.known.generation_bytes = self.others.generation_bytes = generation_bytes // 2
        self.tails.generation_bytes = generation_bytes // 4

    def forget(self) -> None:
        """Gives back what is remembered, for applications whose workers go on to other work."""
        for remembered in (self.known, self.parts, self.others, self.tails):
            remembered.forget()
        pa.default_memory_pool().release_unused()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _part(self, part: str) -> list[int]:
        """Ids of one pre-token."""
        if not part:
            return []
        shown = part.replace(" ", self.signs[32]) if part.isascii() else part.encode().decode("latin-1").translate(self.signs)
        return [t.id for t in self.model.tokenize(shown)]

    def _piece(self, word: str) -> str:
        return word[1:] if word[:1] == self.FIRST else word if word[:1] == self.LINE else f" {word}"

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        plain = [PLAIN.fullmatch(p) if self.splits else None for p in pieces]
        others = iter(self.tokenizer.encode_batch_fast([p for p, m in zip(pieces, plain) if not m], add_special_tokens=False))
        ids = [self._part(m[1]) + self._part(m[2]) if m else next(others).ids for m in plain]
        sign = "H" if self.dtype.itemsize == 2 else "I"
        return [struct.pack(f"<{len(x)}{sign}", *x) for x in ids]

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (no NULL)."""
        special = np.zeros(len(texts), bool)
        for token in self.special:
            special |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        runs = pc.match_substring_regex(texts, self.RUNS).to_numpy(zero_copy_only=False) | special
        marked = pc.binary_join_element_wise(self.FIRST, pc.replace_substring(texts.filter(pa.array(~runs)), "\n", " \n"), "")
        simple = self._gathered(pc.split_pattern(marked, " "), f"^[\n\x00]?[{self.LETTERS}]+$", self.letters)
        others = self._by_pieces(texts.filter(pa.array(runs)).to_pylist())
        for has_runs in runs.tolist():
            yield next(others) if has_runs else next(simple)

    def _by_pieces(self, texts: list[str]) -> Iterator[np.ndarray]:
        held, size = [], 0
        for text in texts:
            whole = ODD_SPACE.search(text) or any(s in text for s in self.special)
            held.append(text if whole else PIECES.findall(text))
            size += len(held[-1])
            if size >= self.PIECES_AT_ONCE:
                yield from self._of_pieces(held)
                held, size = [], 0
        yield from self._of_pieces(held)

    def _of_pieces(self, texts: list[str | list[str]]) -> Iterator[np.ndarray]:
        split = pa.array([p for own in texts if isinstance(own, list) for p in own], pa.large_string()).dictionary_encode()
        found, places, begin = self.known(_listed(split.dictionary)), split.indices.to_numpy(), 0
        for own in texts:
            if isinstance(own, str):
                yield np.array(self._ids(own), self.dtype)
            else:
                yield np.frombuffer(b"".join(map(found.__getitem__, places[begin : begin + len(own)].tolist())), self.dtype)
                begin += len(own)


_words: dict[str, WordIds] = {}
_bytes: dict[str, ByteIds] = {}


def byte_ids(path: str) -> ByteIds:
    """The worker's encoder of a byte-level tokenizer file."""
    if path not in _bytes:
        _bytes[path] = ByteIds(path)
    return _bytes[path]


def word_ids(path: str) -> WordIds:
    """The worker's encoder of a tokenizer file."""
    if path not in _words:
        _words[path] = WordIds(path)
    return _words[path]
