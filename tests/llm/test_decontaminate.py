import pytest

from sluicegate.llm import decontaminate
from sluicegate.llm.decontaminate import NAME, NUMBER, UNIT
from pyspark.sql import functions as F

QUESTION = (
    "A farmer called Anna Smith sells 12 baskets of apples and 12 jars of honey at a market 5 km away, and "
    "then she walks home with 30 coins. How many coins did she get for each of the jars?"
)


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, QUESTION), (2, "too short to say anything"), (3, None), (4, "")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, benchmark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r["reworded"] for r in decontaminate.leaks(docs, benchmark).collect() if r["item_id"] == 1}


def test_slots(spark):
    row = spark.createDataFrame([("We met Anna Smith and Bob, 12.5 kg of it for 50% or 3km. The End",)], ["t"])
    words = row.select(decontaminate.tokens(F.col("t"))).first()[0]
    assert words == ["we", "met", f"{NAME}anna smith{NAME}", "and", f"{NAME}bob{NAME}", f"{NUMBER}12.5", f"{UNIT}kg", "of", "it",
                     "for", f"{NUMBER}50", f"{UNIT}%", "or", f"{NUMBER}3", f"{UNIT}km", "the", f"{NAME}end{NAME}"]


def test_exact_and_embedded_passages(spark, benchmark):
    filler = "some other words stand here before and after the passage as they do on pages"
    assert found(spark, benchmark, QUESTION, f"{filler}. {QUESTION} {filler}", filler) == {0: False, 1: False}


def test_consistent_rewording_is_a_leak_and_inconsistent_is_not(spark, benchmark):
    reworded = QUESTION.replace("12", "7").replace("Anna Smith", "Otto Maier").replace("5 km", "9 miles").replace("30", "81")
    mixed = reworded.replace("7 jars", "8 jars")  # 12 would stand for 7 and for 8
    assert found(spark, benchmark, reworded, mixed.replace("sells 7", "sells 3")) == {0: True}


def test_half_a_passage_counts_and_less_does_not(spark, benchmark):
    words = QUESTION.split()
    assert set(found(spark, benchmark, " ".join(words[:26]), " ".join(words[:14]))) == {0}


def test_odd_rows(spark, benchmark, odd_docs, no_docs):
    leaky = odd_docs.withColumn("text", F.when(F.col("doc_id").isNull() | (F.col("doc_id") == 2), QUESTION).otherwise(F.col("text")))
    got = decontaminate.leaks(leaky, benchmark).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(None, 1), (2, 1)} and len(got) == 2  # repeats are one result
    kept = decontaminate.without_leaks(leaky, benchmark)
    assert kept.columns == leaky.columns and kept.count() == leaky.count() - 5
    assert decontaminate.leaks(no_docs, benchmark).count() == 0
    assert decontaminate.without_leaks(odd_docs, benchmark.limit(0)).count() == odd_docs.count()


def test_shuffled_join_gives_the_same(spark, benchmark, odd_docs, monkeypatch):
    leaky = odd_docs.withColumn("text", F.concat(F.lit(QUESTION), F.coalesce("text", F.lit(""))))
    broadcast = sorted(map(str, decontaminate.leaks(leaky, benchmark).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", 0)
    assert sorted(map(str, decontaminate.leaks(leaky, benchmark).collect())) == broadcast


DENSE = "Die Stadt Köln baut im Herbst neue Schulen, Brücken, Strassen, Parks und Häuser."
SUM = "Anna, Bob, Carl and Dora have 3, 5, 7 and 9 apples. Anna gives Bob 2 and Carl 1. How many has Dora?"
SHORT = "What is the capital of France?"


def caught(spark, item, *texts):
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    return set(found(spark, items, *texts))


@pytest.mark.parametrize("item", [DENSE, SUM, SHORT], ids=["slots", "sum", "short"])
def test_verbatim_copies_of_dense_and_short_items(spark, item):
    around = f"many words stand before it. {item} and as many others follow after it"
    other = item.replace("Köln", "Bonn").replace("Brücken", "Wege").replace("5, 7", "8, 7").replace("France", "Spain")
    assert caught(spark, item, item, around, other, "nothing of the kind is said on this page at all") >= {0, 1}
    assert caught(spark, SHORT, SHORT.replace("France", "Spain"), "what is the capital") == set()


def test_a_long_run_of_a_longer_item_counts(spark):
    words = [f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    texts = [" ".join(words[50:190]), " ".join(words[10:35]), " ".join(words[10:34])]
    assert caught(spark, " ".join(words), *texts) == {0, 1}


def test_tables_of_numbers_meet_word_by_word(spark):
    table = " ".join(map(str, range(100, 130)))
    assert caught(spark, table, table, " ".join(map(str, range(500, 2500)))) == {0}


def test_very_long_texts_are_read_in_spans(spark):
    rows = spark.range(2).select(
        F.col("id").alias("doc_id"),
        F.concat(F.expr("repeat('some filler words again ', 700000)"), F.when(F.col("id") == 1, QUESTION).otherwise("")).alias("text"),
    )
    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.leaks(rows, items).collect()] == [1]


def test_long_runs_of_names_and_numbers_are_one_slot(spark):
    names, numbers, times = " ".join(["Éva-lotta"] * 12_000), "1," * 60_000 + "2", "said " * 20 + "9:" * 60_000 + "9"
    docs = spark.createDataFrame([(1, f"{names} {QUESTION}"), (2, f"we met {names}"), (3, numbers), (4, times)], "doc_id long, text string")
    words = {r[0]: r[1] for r in docs.select("doc_id", decontaminate.tokens(F.col("text"))).collect()}
    assert words[2] == ["we", "met", f"{NAME}{names.lower()}{NAME}"] and words[3] == [f"{NUMBER}{numbers}"]
    assert words[4] == ["said"] * 20 + [NUMBER + "9:" * 60_000 + "9"]
    items = spark.createDataFrame([(1, QUESTION)], "item_id long, text string")
    assert [(r["doc_id"], r["reworded"]) for r in decontaminate.leaks(docs, items).collect()] == [(1, False)]


@pytest.mark.parametrize("width, overlap", [(10, 4), (7, 3), (100, 10)])
def test_spans_hold_every_piece(spark, width, overlap):
    text = "".join(chr(97 + i % 26) + str(i % 10) for i in range(43))
    row = spark.createDataFrame([(text,)], ["t"]).select(decontaminate.spans(F.col("t"), width, overlap))
    got = [r["span"] for r in row.collect()]
    assert all(any(text[i : i + overlap] in s for s in got) for i in range(len(text))) and all(len(s) <= width for s in got)
