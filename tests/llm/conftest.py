import random

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = ["ka", "lo", "mi", "ter", "un", "das", "pre", "vo", "shi", "ran", "el", "qu"]


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


@pytest.fixture(scope="session")
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties and repeated rows."""
    long_text = " ".join(words(random.Random(1), 30_000))
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (None, "one two three four five six", "en", None, 3),
        (None, None, None, None, None),
        (3, "   \n\t ", None, "a", 1),
        (4, "one two three four five six", "en", "a", 27),
        (4, "one two three four five six", "en", "a", 27),
        (5, "ONE two three four five six", "fr", "b", 27),
        (6, long_text, "en", "a", len(long_text)),
        (7, long_text + " end", "en", "a", len(long_text) + 4),
        (8, "12345 67890", None, "b", 11),
        (9, "x" * 200_000, "en", "b", 200_000),
        (10, "a.b" * 30_000 + "@", "en", "b", 90_001),
    ]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="session")
def clashing(odd):
    """Columns with the names that the operators give out or use inside."""
    import pyspark.sql.functions as F

    names = ("row", "_row", "_text", "spans", "score", "shard", "slot", "node", "start",
             "length", "ids", "n_lines", "n_dropped", "words", "hit", "base", "_id", "host")
    return odd.withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("doc_id < 0")
