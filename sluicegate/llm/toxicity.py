"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

The network is trained in numpy on a bounded sample of labelled documents. A text is scored by all its overlapping windows,
half a window apart, and is as toxic as its most toxic window. What has no white space for long counts as overlapping
pieces, each a word of its own. A word enters with a vector of its own, if the sample knew
it, and with the mean of the vectors of its character n-grams.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .base import stored

#: Words of a window and from one window's start to the next.
WINDOW, STEP = 48, 24
#: Sizes: a word's own vector, the vector of its characters, hidden units of a direction, attention.
WORD_DIMS, CHAR_DIMS, HIDDEN, ATTENTION = 10, 6, 8, 8
#: Hashed n-grams of 3 to 5 bytes, word ends included.
CHAR_BUCKETS, CHAR_SIZES = 1 << 15, (3, 4, 5)
#: Documents that are learned from, of either label, at most (chosen by a hash of their id), and words known by name.
SAMPLE, KNOWN_WORDS, LEAST_DOCS = 2_500, 30_000, 3
ROUNDS, MOST_ROUNDS, LEAST_STEPS, BATCH, RATE = 5, 40, 240, 64, 0.01
#: Words whose inputs a worker remembers, windows scored together, and words prepared together in training.
REMEMBERED, WINDOWS_AT_ONCE, WORDS_AT_ONCE = 500_000, 2_048, 20_000
#: Characters up to which a chunk of text between white space is one word; longer ones (scripts without white space, markup)
#: are cut into pieces of so many characters, so far apart, and overlap by more than the longest n-gram.
LONGEST_WORD, PIECE, PIECE_STEP = 48, 16, 11
EDGES = re.compile(r"^[^\w]+|[^\w]+$")


def chunks_of(text: str) -> list[str]:
    """Chunks of a text that take places of their own in its windows; together they hold all of it but white space."""
    chunks = text.split()
    if all(len(c) <= LONGEST_WORD for c in chunks):
        return chunks
    return [p for c in chunks for p in ([c] if len(c) <= LONGEST_WORD else _pieces(c))]


def _pieces(chunk: str) -> list[str]:
    return [chunk[k : k + PIECE] for k in range(0, len(chunk) - PIECE + PIECE_STEP, PIECE_STEP)]


def word_of(chunk: str) -> str:
    """What counts as the word in a chunk of text: lower case, without signs at its ends."""
    return EDGES.sub("", chunk.lower())


def n_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words' character n-grams, and the place of the word that each belongs to."""
    encoded = [b"\x02" + w.encode() + b"\x03" for w in words]
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    flat = np.frombuffer(b"".join(encoded), np.uint8).astype(np.uint64)
    owner, ends = np.repeat(np.arange(len(words)), sizes), np.repeat(np.cumsum(sizes), sizes)
    buckets, owners = [], []
    for k in CHAR_SIZES:
        at = np.flatnonzero(np.arange(len(flat)) + k <= ends)
        h = np.full(len(at), k, np.uint64)
        for i in range(k):
            h = (h ^ flat[at + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        buckets.append(h % np.uint64(CHAR_BUCKETS))
        owners.append(owner[at])
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def window_places(n_words: int) -> np.ndarray:
    """Places of the words of each window of a text, -1 beyond its end; a text without words has one empty window."""
    count = 1 if n_words <= WINDOW else math.ceil((n_words - WINDOW) / STEP) + 1
    places = np.arange(count)[:, None] * STEP + np.arange(WINDOW)[None, :]
    return np.where(places < n_words, places, -1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


class Network:
    """Weights by name. Inputs come as [steps, windows, dims] with a mask [steps, windows]."""

    def __init__(self, seed: int = 7):
        draw, dims = np.random.default_rng(seed), WORD_DIMS + CHAR_DIMS
        self.w: dict[str, np.ndarray] = {}
        for way in "fb":
            self.w[f"x{way}"] = draw.normal(0, dims**-0.5, (dims, 3 * HIDDEN))
            self.w[f"h{way}"] = draw.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN))
            self.w[f"c{way}"] = np.zeros(3 * HIDDEN)
        self.w["a"] = draw.normal(0, (2 * HIDDEN) ** -0.5, (2 * HIDDEN, ATTENTION))
        self.w["u"] = draw.normal(0, ATTENTION**-0.5, ATTENTION)
        self.w["o"] = draw.normal(0, (2 * HIDDEN) ** -0.5, 2 * HIDDEN)
        self.w["o0"] = np.zeros(1)
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}

    def _run(self, x: np.ndarray, mask: np.ndarray, way: str, keep: bool):
        w, steps = self.w, range(len(x)) if way == "f" else range(len(x) - 1, -1, -1)
        gx = (x.reshape(-1, x.shape[2]) @ w[f"x{way}"] + w[f"c{way}"]).reshape(*x.shape[:2], -1)
        h, states, trace = np.zeros((x.shape[1], HIDDEN), np.float32), np.empty((*x.shape[:2], HIDDEN), np.float32), {}
        for t in steps:
            gh = h @ w[f"h{way}"]
            gates = sigmoid(gx[t, :, : 2 * HIDDEN] + gh[:, : 2 * HIDDEN])
            z, r, cand = gates[:, :HIDDEN], gates[:, HIDDEN:], gh[:, 2 * HIDDEN :]
            n = np.tanh(gx[t, :, 2 * HIDDEN :] + r * cand)
            moved = (1 - z) * (n - h) * mask[t, :, None]
            if keep:
                trace[t] = (h, z, r, n, cand)
            h = h + moved
            states[t] = h
        return states, trace

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Log odds of each window, and what ``backward`` needs."""
        (hf, tf), (hb, tb) = self._run(x, mask, "f", keep), self._run(x, mask, "b", keep)
        h = np.concatenate((hf, hb), axis=2)
        a = np.tanh(h @ self.w["a"])
        e = np.where(mask > 0, a @ self.w["u"], np.float32(-30))
        weight = np.exp(e - e.max(axis=0)) * mask
        weight /= np.maximum(weight.sum(axis=0), 1e-9)
        pooled = (weight[:, :, None] * h).sum(axis=0)
        return pooled @ self.w["o"] + self.w["o0"], (x, mask, h, a, weight, pooled, tf, tb)

    def backward(self, d_out: np.ndarray, saved) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights and of the inputs for gradients of the windows' log odds."""
        x, mask, h, a, weight, pooled, tf, tb = saved
        g = {"o": pooled.T @ d_out, "o0": d_out.sum(keepdims=True)}
        d_pooled = d_out[:, None] * self.w["o"]
        d_weight = (d_pooled[None] * h).sum(axis=2)
        d_e = weight * (d_weight - (weight * d_weight).sum(axis=0))
        d_pre = d_e[:, :, None] * self.w["u"] * (1 - a * a)
        g["u"] = (d_e[:, :, None] * a).sum(axis=(0, 1))
        g["a"] = h.reshape(-1, h.shape[2]).T @ d_pre.reshape(-1, ATTENTION)
        d_h = weight[:, :, None] * d_pooled[None] + d_pre @ self.w["a"].T
        d_x = np.zeros_like(x)
        for way, trace, part in (("f", tf, d_h[:, :, :HIDDEN]), ("b", tb, d_h[:, :, HIDDEN:])):
            wh, d_gx = self.w[f"h{way}"], np.zeros((*x.shape[:2], 3 * HIDDEN), np.float32)
            g[f"h{way}"], carry = np.zeros_like(wh), np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in reversed(list(trace)):
                before, z, r, n, cand = trace[t]
                carry = carry + part[t]
                m = mask[t, :, None]
                d_n = carry * (1 - z) * m * (1 - n * n)
                d_z = carry * (before - n) * m * z * (1 - z)
                d_r = d_n * cand * r * (1 - r)
                d_gh = np.concatenate((d_z, d_r, d_n * r), axis=1)
                d_gx[t] = np.concatenate((d_z, d_r, d_n), axis=1)
                g[f"h{way}"] += before.T @ d_gh
                carry = carry * (1 - (1 - z) * m) + d_gh @ wh.T
            flat = d_gx.reshape(-1, 3 * HIDDEN)
            g[f"x{way}"], g[f"c{way}"] = x.reshape(-1, x.shape[2]).T @ flat, flat.sum(axis=0)
            d_x += d_gx @ self.w[f"x{way}"].T
        return g, d_x


class Adam:
    def __init__(self, rate: float):
        self.rate, self.moments, self.steps = rate, {}, Counter()

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        m, v = self.moments.setdefault(name, (np.zeros_like(value), np.zeros_like(value)))
        self.steps[name] += 1
        t = self.steps[name]
        m += 0.1 * (gradient - m)
        v += 0.001 * (gradient * gradient - v)
        value -= self.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-6)


class Toxicity:
    """A trained network with its words' and n-grams' vectors; scores texts."""

    def __init__(self, constant: float = 0.5):
        self.constant = constant
        self.network: Network | None = None
        self.place: dict[str, int] = {}
        self.words = self.chars = np.zeros((0, 0), np.float32)
        self._forget()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "inputs", "used")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.inputs, self.used = np.zeros((1024, WORD_DIMS + CHAR_DIMS), np.float32), 0

    def _inputs_of(self, chunks: list[str]) -> np.ndarray:
        words = [word_of(c) for c in chunks]
        own = self.words[[self.place.get(w, 0) for w in words]]
        buckets, owner = n_grams(words)
        # Every word has at least one n-gram place: its ends count as bytes, and the shortest has size 3 or none.
        total = np.zeros((len(words), CHAR_DIMS), np.float32)
        np.add.at(total, owner, self.chars[buckets])
        counts = np.maximum(np.bincount(owner, minlength=len(words)), 1)
        return np.concatenate((own, total / counts[:, None].astype(np.float32)), axis=1)

    def _look_up(self, texts: list[list[str]]) -> list[np.ndarray]:
        missing = [c for c in set().union(*texts) if c not in self.rows]
        if len(self.rows) + len(missing) > REMEMBERED:
            self._forget()
            missing = list(set().union(*texts))
        if missing:
            while len(self.inputs) < self.used + len(missing):
                self.inputs = np.concatenate((self.inputs, np.zeros_like(self.inputs)))
            self.inputs[self.used : self.used + len(missing)] = self._inputs_of(missing)
            self.rows.update(zip(missing, range(self.used, self.used + len(missing))))
            self.used += len(missing)
        return [np.fromiter(map(self.rows.__getitem__, t), np.int64, len(t)) for t in texts]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Largest probability over each text's windows."""
        if self.network is None:
            return np.full(len(texts), self.constant)
        out = np.zeros(len(texts))
        for begin in range(0, len(texts), 256):
            rows = self._look_up([chunks_of(t or "") for t in texts[begin : begin + 256]])
            best = np.full(len(rows), -np.inf)
            for owner, places in _windows(rows):
                x = self.inputs[np.maximum(places, 0)].transpose(1, 0, 2)
                odds, _ = self.network.forward(np.ascontiguousarray(x), (places >= 0).T.astype(np.float32))
                np.maximum.at(best, owner, odds)
            out[begin : begin + len(rows)] = sigmoid(best)
        return out


def _windows(rows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, rows of its words) of all windows of some texts, at most ``WINDOWS_AT_ONCE`` together."""
    held, size = [], 0
    for i, own in enumerate(rows):
        places = window_places(len(own))
        for part in np.array_split(places, len(places) // WINDOWS_AT_ONCE + 1):
            filled = np.where(part >= 0, own[part] if len(own) else 0, -1)
            held.append((np.full(len(part), i), filled))
            size += len(part)
            if size >= WINDOWS_AT_ONCE:
                yield tuple(np.concatenate(c) for c in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.concatenate(c) for c in zip(*held))


def train(texts: list[str], labels: np.ndarray, seed: int = 7, shift: float = 0.0) -> Toxicity:
    """Network from labelled texts. A document's loss is that of its most toxic window, chosen anew in each round; the
    first choice, and the start of the words' vectors, come from the words' log odds in toxic documents. ``shift`` is
    added to the log odds of all texts in the end: by how much those of being toxic are higher where texts come from."""
    n1 = int(labels.sum())
    model = Toxicity(constant=n1 / len(labels) if len(labels) else 0.5)
    if not 0 < n1 < len(labels):
        return model
    at: dict[str, int] = {}
    of_chunk: dict[str, int] = {}
    rows: list[np.ndarray] = []
    for text in texts:
        chunks = chunks_of(text)
        of_chunk.update((c, at.setdefault(word_of(c), len(at))) for c in chunks if c not in of_chunk)
        rows.append(np.fromiter(map(of_chunk.__getitem__, chunks), np.int32, len(chunks)))
    del of_chunk
    distinct = list(at)
    seen, toxic = np.zeros(len(at)), np.zeros(len(at))
    for own, y in zip(rows, labels):
        met = np.unique(own)
        seen[met] += 1
        toxic[met] += y
    known = np.flatnonzero(seen >= LEAST_DOCS)
    known = known[np.argsort(-seen[known], kind="stable")][:KNOWN_WORDS]
    draw = np.random.default_rng(seed)
    model.place = {distinct[w]: i for i, w in enumerate(known.tolist(), 1)}
    odds = np.log((toxic + 0.5) / (n1 + 1)) - np.log((seen - toxic + 0.5) / (len(labels) - n1 + 1))
    model.words = draw.normal(0, 0.05, (len(known) + 1, WORD_DIMS)).astype(np.float32)
    model.words[1:, 0], model.words[0, 0] = np.clip(odds[known], -2, 4), 0
    model.chars = draw.normal(0, 0.05, (CHAR_BUCKETS, CHAR_DIMS)).astype(np.float32)
    model.network, adam = Network(seed), Adam(RATE)

    word_place = np.zeros(len(distinct), np.int32)
    word_place[known] = np.arange(1, len(known) + 1)
    parts, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for begin in range(0, len(distinct), WORDS_AT_ONCE):
        part = distinct[begin : begin + WORDS_AT_ONCE]
        grams, owner = n_grams(part)
        parts.append(grams[np.argsort(owner, kind="stable")].astype(np.int32))
        sizes.append(np.bincount(owner, minlength=len(part)))
    buckets, first = np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
    places = [window_places(len(r)).astype(np.int32) for r in rows]
    prior = model.words[word_place, 0]

    def inputs(used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        sizes = first[used + 1] - first[used]
        own = np.repeat(np.arange(len(used)), sizes)
        grams = buckets[np.repeat(first[used] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())]
        total = np.zeros((len(used), CHAR_DIMS), np.float32)
        np.add.at(total, own, model.chars[grams])
        share = (1 / np.maximum(sizes, 1)).astype(np.float32)
        return np.concatenate((model.words[word_place[used]], total * share[:, None]), axis=1), own, grams, share

    def words_in(i: int, window: int) -> np.ndarray:
        p = places[i][window]
        return np.where(p >= 0, rows[i][p] if len(rows[i]) else 0, -1)

    chosen = [int(np.argmax([np.maximum(prior[r[r >= 0]], 0).sum() for r in (words_in(i, k) for k in range(len(p)))])) for i, p in enumerate(places)]
    rounds = min(MOST_ROUNDS, max(ROUNDS, math.ceil(LEAST_STEPS * BATCH / len(rows))))
    for turn in range(rounds):
        if turn:
            every = (np.arange(k, min(k + WORDS_AT_ONCE, len(distinct))) for k in range(0, len(distinct), WORDS_AT_ONCE))
            _choose(model, rows, np.concatenate([inputs(part)[0] for part in every]), chosen)
        adam.rate = RATE * 0.1 ** (turn / rounds)
        shuffled = draw.permutation(len(rows))
        for begin in range(0, len(rows), BATCH):
            batch = shuffled[begin : begin + BATCH]
            own_words = np.stack([words_in(i, chosen[i]) for i in batch])
            used, back = np.unique(np.maximum(own_words, 0), return_inverse=True)
            back = back.reshape(own_words.shape)
            table, owner_of, grams, share = inputs(used)
            mask = (own_words >= 0).T.astype(np.float32)
            out, saved = model.network.forward(np.ascontiguousarray(table[back].transpose(1, 0, 2)), mask, keep=True)
            d_out = ((sigmoid(out) - labels[batch]) / len(batch)).astype(np.float32)
            gradients, d_x = model.network.backward(d_out, saved)
            for name, value in model.network.w.items():
                adam.step(name, value, np.clip(gradients[name], -1, 1).astype(np.float32))
            d_rows = np.zeros_like(table)
            np.add.at(d_rows, back.ravel(), (d_x * mask[:, :, None]).transpose(1, 0, 2).reshape(-1, table.shape[1]))
            np.add.at(model.words, word_place[used], -10 * adam.rate * d_rows[:, :WORD_DIMS])
            np.add.at(model.chars, grams, (-10 * adam.rate * d_rows[:, WORD_DIMS:] * share[:, None])[owner_of])
    model.network.w["o0"] += np.float32(shift)
    return model


def _choose(model: Toxicity, rows: list[np.ndarray], table: np.ndarray, chosen: list[int]) -> None:
    """Sets each text's most toxic window under the model as it is; ``table`` has the inputs of each word."""
    best = np.full(len(rows), -np.inf)
    seen = np.zeros(len(rows), np.int64)
    for owner, places in _windows(rows):
        x = np.ascontiguousarray(table[np.maximum(places, 0)].transpose(1, 0, 2))
        odds, _ = model.network.forward(x, (places >= 0).T.astype(np.float32))
        for i, o in zip(owner.tolist(), odds.tolist()):
            if o > best[i]:
                best[i], chosen[i] = o, int(seen[i])
            seen[i] += 1


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from. A NULL id is not held out, and finds no label either."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels of at most ``size`` documents of either label that may be learned from, chosen by hash of the id,
    and what the log odds of being toxic have lost by the choice, from the counts of all labels that may be learned from."""
    sound = labels.filter(~held_out(labels["doc_id"]) & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    eligible = sound.select("doc_id", F.col("toxic").cast("int").alias("y")).distinct()
    counts = {r["y"]: r["count"] for r in eligible.groupBy("y").count().collect()}
    each = [eligible.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for y in (0, 1)]
    picked = stored(each[0].union(each[1]).withColumnRenamed("doc_id", "picked_id"), "toxic-sample")
    texts = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(picked), F.col("doc_id") == F.col("picked_id"))
    one = texts.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    rows = sorted(one.collect(), key=lambda r: (r["doc_id"], r["y"]))
    left_out = [math.log(counts[y] / min(counts[y], size)) if y in counts else 0.0 for y in (0, 1)]
    return [r["text"] for r in rows], np.array([r["y"] for r in rows], np.int64), left_out[1] - left_out[0]


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, size: int = SAMPLE) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row of ``docs``.

    Scores are probabilities at the share of toxic labels among all that may be learned from, however few (``size``) of
    either label the network sees.

    NULL and empty texts have one window without words and the score the network gives it. NULL or other labels are not
    learned. With no label of one class the score is the other's share, with none it is 0.5. NULL id: scored, not held
    out. Repeated rows: each scored; learned once. Empty table: no rows. Other columns are not read.
    """
    texts, known, shift = sample(docs, labels, size)
    model = docs.sparkSession.sparkContext.broadcast(train(texts, known, shift=shift))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.value.scores(texts.tolist()), dtype="float64")

    scored = docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), score(docs["text"].cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
