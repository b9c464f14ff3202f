import math
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import TESTDATA
from pyspark.sql import functions as F

from sluicegate.llm import lm, quality, toxicity

SF = f"{TESTDATA}/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def check_scores(rows, n, remainder, of, threshold):
    assert len(rows) == n
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= threshold)
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % of == remainder)


def test_quality_of_held_out_documents(documents):
    docs, labels = documents
    rows = quality.classify(docs, labels).collect()
    check_scores(rows, 1000, 1, 3, 0.5)
    label = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [r["predicted"] == label[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in label]
    assert len(held) > 80 and sum(held) / len(held) > 0.95


def test_scores_do_not_depend_on_held_out_labels_or_other_columns(documents):
    docs, labels = documents
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")})
    scores = [{r["doc_id"]: round(r["score"], 9) for r in quality.classify(*x).collect()} for x in ((docs, labels), (other, turned))]
    assert scores[0] == scores[1]


def test_discriminant_is_the_log_density_difference():
    draw = np.random.default_rng(0)
    d = len(quality.FEATURES)
    xs = [draw.normal(k, 1 + k, (200 + 50 * k, d)) for k in (0, 1)]
    model = quality.discriminant(
        np.array([float(len(x)) for x in xs]), np.array([x.sum(axis=0) for x in xs]), np.array([x.T @ x for x in xs])
    )
    point = draw.normal(0.5, 1, d)
    logs = []
    for k in (0, 1):
        covariance = np.linalg.inv(model.inverse_factors[k].T @ model.inverse_factors[k])
        away = point - xs[k].mean(axis=0)
        logs.append(math.log(len(xs[k]) / 450) - 0.5 * (np.linalg.slogdet(covariance)[1] + away @ np.linalg.solve(covariance, away)))
    assert model.scores(point[None])[0] == pytest.approx(1 / (1 + math.exp(-model.scale * (logs[1] - logs[0]))), rel=1e-9)


@pytest.mark.parametrize("module, label, keys", [(quality, "quality", (1, 3, 0.5)), (toxicity, "toxic", (2, 4, 0.3))])
def test_odd_rows_and_labels(spark, odd_docs, no_docs, module, label, keys):
    schema = f"doc_id long, {label} int, score string"
    labels = spark.createDataFrame(
        [(i, i % 2, "own") for i in range(1, 12)] + [(None, 1, ""), (1, None, ""), (3, 7, ""), (2, 0, ""), (99, 1, "")], schema
    )
    check_scores(module.classify(odd_docs, labels).collect(), odd_docs.count(), *keys)
    check_scores(module.classify(odd_docs, labels.filter(f"{label} = 1")).collect(), odd_docs.count(), *keys)
    assert {r["score"] for r in module.classify(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert module.classify(no_docs, labels).count() == 0


def test_good_documents_keep_rows_as_they_are(spark, odd_docs, no_docs, documents):
    docs, labels = documents
    kept = quality.good_documents(docs, labels)
    wanted = {r["doc_id"] for r in quality.classify(docs, labels).collect() if r["predicted"]}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == wanted
    odd = quality.good_documents(odd_docs, labels)
    assert odd.columns == odd_docs.columns and odd.count() <= odd_docs.count()
    assert quality.good_documents(odd_docs, labels.limit(0)).count() == odd_docs.count()
    assert quality.good_documents(no_docs, labels).count() == 0


def test_toxicity_of_held_out_documents(documents):
    docs, labels = documents
    rows = toxicity.classify(docs, labels).collect()
    check_scores(rows, 1000, 2, 4, 0.3)
    label = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(r["score"], label[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in label]
    good, bad = ([s for s, y in held if y == k] for k in (0, 1))
    ahead = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert len(held) > 60 and ahead > 0.65 and np.mean([(s >= 0.3) == y for s, y in held]) > 0.85


def test_gradients_are_those_of_differences():
    draw, net = np.random.default_rng(0), toxicity.Network(3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, mask = draw.normal(size=(5, 3, toxicity.WORD_DIMS + toxicity.CHAR_DIMS)), np.ones((5, 3))
    mask[3:, 1] = 0
    gradients, d_x = net.backward(np.ones(3), net.forward(x, mask, keep=True)[1])
    for name, value in [*net.w.items(), ("inputs", x)]:
        for _ in range(4):
            at = tuple(draw.integers(0, n) for n in value.shape)
            kept, step, sides = value[at], 1e-3, []
            for way in (step, -step):
                value[at] = kept + way
                sides.append(net.forward(x, mask)[0].sum())
            value[at] = kept
            got = (d_x if name == "inputs" else gradients[name])[at]
            assert got == pytest.approx((sides[0] - sides[1]) / 2 / step, abs=2e-3)


def test_windows_overlap_and_cover_whole_texts():
    for n in (0, 1, 47, 48, 49, 72, 73, 1000):
        places = toxicity.window_places(n)
        assert set(places[places >= 0]) == set(range(n)) and all(b == a + toxicity.STEP for a, b in zip(places[:, 0], places[1:, 0]))


def test_one_bad_window_anywhere_in_a_text_decides():
    clean = [f"some plain words about garden {i} and weather number {i * 3}" for i in range(120)]
    texts = clean + [f"{c} you vile scoundrel" for c in clean]
    model = toxicity.train(texts, np.repeat([0, 1], 120))
    filler = " ".join(clean[:60])
    low, high, empty, whole = model.scores([filler, f"{filler} you vile scoundrel {filler}", "", None])
    assert low < 0.3 < 0.6 < high and empty == whole
    forgetful = toxicity.REMEMBERED
    try:
        toxicity.REMEMBERED = 20
        assert np.allclose(model.scores([filler, texts[-1]]), [low, toxicity.Toxicity.scores(model, [texts[-1]])[0]], atol=1e-6)
    finally:
        toxicity.REMEMBERED = forgetful


def test_scores_of_a_bounded_sample_keep_the_share_of_toxic_labels(spark):
    """Of mild texts a twentieth is toxic and of harsh ones three tenths; the smaller sample has as many of either label."""
    rows = [(i, "mild words about the garden" if i % 5 else "harsh words about the rival") for i in range(1600)]
    seen = Counter()
    labels = []
    for i, text in rows:
        seen[text] += 1
        labels.append((i, int(seen[text] % 20 == 0 if i % 5 else seen[text] % 10 < 3)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    for size in (2_500, 80):
        scores = {r["text"]: r["score"] for r in toxicity.classify(docs, marks, size=size).join(docs, "doc_id").collect()}
        assert scores[rows[1][1]] == pytest.approx(0.05, abs=0.04) and scores[rows[0][1]] == pytest.approx(0.3, abs=0.12)
    texts, known, shift = toxicity.sample(docs, marks, 80)
    assert len(texts) == 160 and known.sum() == 80 and shift < -1.5 and toxicity.sample(docs, marks)[2] == 0


def test_texts_without_spaces_are_scored_to_their_end():
    for n in (48, 49, 59, 60, 61, 500):
        text = "".join(chr(0x4E00 + i) for i in range(n))
        chunks = toxicity.chunks_of(f"a {text} b")
        assert [chunks[0], chunks[-1]] == ["a", "b"] and all(len(c) <= toxicity.LONGEST_WORD for c in chunks)
        grams = {text[i : i + 5] for i in range(n - 4)}
        assert grams == {c[i : i + 5] for c in chunks[1:-1] for i in range(len(c) - 4)}
    draw = np.random.default_rng(5)
    plain = ["".join(chr(0x4E00 + c) for c in draw.integers(0, 60, 530)) for _ in range(120)]
    bad = "".join(chr(0x6E00 + 7 * i) for i in range(30))
    model = toxicity.train(plain + [p[:k] + bad + p[k:] for p, k in zip(plain, draw.integers(0, 500, 120))], np.repeat([0, 1], 120))
    filler = "".join(plain[:10])
    low, *high = model.scores([filler, filler + bad + filler[:50], filler[:1500] + bad + filler])
    assert low < 0.3 < 0.6 < min(high)


def plain_losses(texts):
    """Symbol counts of each order in dictionaries."""
    counts = Counter()
    for t in texts:
        s = [0, 0, 0, *lm.SYMBOL_OF[np.frombuffer((t or "").encode(), np.uint8)].tolist()]
        counts.update(tuple(s[i : i + 4]) for i in range(len(s) - 3))
    return counts


def plain_loss(text, counts, base, scale):
    s = [0, 0, 0, *lm.SYMBOL_OF[np.frombuffer(text.encode(), np.uint8)].tolist()]
    total = 0.0
    for i in range(len(s) - 3):
        gram, chance = s[i : i + 4], base[s[i + 3]]
        for order in range(1, 5):
            tail = gram[4 - order :]
            own = scale * sum(n for g, n in counts.items() if list(g[4 - order :]) == tail)
            seen = scale * sum(n for g, n in counts.items() if list(g[4 - order : 3]) == tail[:-1])
            chance = (own + lm.PRIOR * chance) / (seen + lm.PRIOR)
        total -= math.log(chance)
    return total / (len(s) - 3)


def test_cross_entropy_difference_against_dictionaries(spark, no_docs):
    target, background = ["Good prose, 12 words.", "more good prose"], ["x%%% y$$$ éè", None, "good", "zz zz\n"]
    frames = [spark.createDataFrame([(t,) for t in x], "text string") for x in (target, background)]
    docs = spark.createDataFrame([(1, "good proze"), (2, "x%% é"), (None, ""), (4, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm.score_documents(docs, *frames).collect()}
    t, b = plain_losses(target), plain_losses(background)
    together = Counter({k: 0 for k in range(lm.SYMBOLS)})
    for g, n in [*t.items(), *b.items()]:
        together[g[3]] += n
    base = [(together[k] + 1) / (sum(together.values()) + lm.SYMBOLS) for k in range(lm.SYMBOLS)]
    for doc_id, text in ((1, "good proze"), (2, "x%% é")):
        wanted = [plain_loss(text, t, base, 1), plain_loss(text, b, base, sum(t.values()) / sum(b.values()))]
        assert [got[doc_id]["target_loss"], got[doc_id]["background_loss"]] == pytest.approx(wanted, rel=1e-5)
    assert got[1]["score"] < got[2]["score"] and (got[None]["n_tokens"], got[4]["score"]) == (0, 0.0)


def test_language_models_on_odd_rows(spark, odd_docs, no_docs):
    text = odd_docs.select("text")
    assert lm.score_documents(odd_docs, text, text).filter("abs(score) > 1e-9").count() == 0
    assert lm.score_documents(odd_docs, no_docs.select("text"), text).count() == odd_docs.count()
    assert lm.score_documents(odd_docs, no_docs.select("text"), no_docs.select("text")).filter("score <> 0").count() == 0
    assert lm.score_documents(no_docs, text, text).count() == 0


def test_every_byte_is_a_symbol_of_its_own():
    assert len({0, *lm.SYMBOL_OF.tolist()}) == lm.SYMBOLS == 257


def test_words_of_texts():
    def words(*texts):
        ids, counts = lm.word_ids([t if isinstance(t, bytes) else t.encode() for t in texts])
        return ids.tolist(), counts.tolist()

    ids, counts = words("The den, the", "", " \t", "日本語", "Москва москва", "naïve", b"a\x80")
    assert counts == [4, 0, 0, 3, 2, 1, 2] and ids[0] == ids[3] != ids[1] and ids[7] != ids[8] and 0 not in ids
    assert len(set(ids)) == len(ids) - 1
    assert words("den The", "本")[0] == [ids[1], ids[0], ids[5]]
    long = "ab " * 700_000 + "x" * 3_000_000 + "." + "日" * 500_000
    assert words("a", long, "b")[1] == [1, 1_200_002, 1]


def plain_word_losses(text, sides, order):
    """Losses of a text of known words by dictionaries of word n-grams."""
    counts = []
    for texts in sides:
        grams, heads = Counter(), Counter()
        for words in ([""] * (order - 1) + t.split() for t in texts if t):
            for i in range(order - 1, len(words)):
                for k in range(order):
                    grams[tuple(words[i - k : i + 1])] += 1
                    heads[tuple(words[i - k : i])] += 1
        counts.append((grams, heads))
    totals = [heads[()] for _, heads in counts]
    known = {g for grams, _ in counts for g in grams if len(g) == 1}
    words, losses = [""] * (order - 1) + text.split(), []
    for (grams, heads), scale in zip(counts, (1, totals[0] / totals[1])):
        loss = 0
        for i in range(order - 1, len(words)):
            chance = (sum(g[tuple(words[i : i + 1])] for g, _ in counts) + 1) / (sum(totals) + len(known) + 1)
            for k in range(order):
                gram = tuple(words[i - k : i + 1])
                chance = (scale * grams[gram] + lm.PRIOR * chance) / (scale * heads[gram[:-1]] + lm.PRIOR)
            loss -= math.log(chance)
        losses.append(loss / (len(words) - order + 1))
    return losses


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("own", [True, False])
def test_word_models_against_dictionaries(spark, monkeypatch, order, own):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 20)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 60)
    draw = np.random.default_rng(3)
    texts = [" ".join(draw.choice(["sun", "rain", "снег", "wind", "été", "x1"], n)) for n in draw.integers(1, 12, 60)]
    target = [*texts[:4], "rain on old roofs", None]
    rows = [*enumerate(texts), (None, texts[7]), (3, texts[9]), (90, ""), (91, None), (92, "never seen sun")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sides = [t for t in target if t], [t for _, t in rows if t] if own else texts[:30]
    background = docs.select("text") if own else spark.createDataFrame([(t,) for t in sides[1]], "text string")
    found = lm.score_documents(docs, spark.createDataFrame([(t,) for t in target], "text string"), background, True, order).collect()
    key = lambda r: (str(r[0]), r[1], *np.round(r[2:], 9))
    wanted = [(i, len((t or "").split()), *(plain_word_losses(t, sides, order) if t else (0.0, 0.0))) for i, t in rows]
    assert sorted(map(key, (tuple(r)[:4] for r in found))) == sorted(map(key, wanted))
    assert all(r.score == r.target_loss - r.background_loss for r in found)
