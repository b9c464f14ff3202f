import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = "the quick brown fox jumps over the lazy dog while seven small birds sing in the old oak tree near our house"


def odd_rows():
    """NULLs in every column, empty and blank texts, a very long one, repeated rows, shared ids, near copies."""
    long_text = " ".join(f"word{i % 977} {i}" for i in range(60_000))
    return [
        (1, PROSE, "en", "a", 100), (2, PROSE, "en", "b", 100), (2, PROSE, "en", "b", 100), (3, PROSE.upper(), "en", None, None),
        (4, None, None, None, None), (None, PROSE + " again", "en", "a", 1), (None, None, None, None, None), (5, "", "en", "a", 0),
        (6, " \t\n ", "en", "", 4), (7, "one", "de", "c", 3), (8, "a éß 日本語 \U0001f642", "xx", "a", 9), (9, long_text, "en", "a", 1),
        (10, "x <|endoftext|> y\x1cz  w", "en", "d", 20), (2, "another text of the same id", "en", "a", 5), (11, PROSE + " twice", "en", "b", 2),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    docs = spark.createDataFrame(odd_rows(), COLUMNS)
    extra = ("size", "target", "doc", "copies", "fingerprint", "score", "x", "y", "hash", "tokens", "bucket", "rate", "copy")
    return docs.withColumns({c: F.lit(f"own {c}") for c in extra}).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)
