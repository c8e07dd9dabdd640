import pytest
from pyspark.sql import types as T

from adtrail.staging import Staging

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Columns whose names an operator might use itself.
    T.StructField("name", T.StringType()), T.StructField("key", T.StringType()), T.StructField("row", T.LongType()),
    T.StructField("size", T.LongType()), T.StructField("kept", T.BooleanType()), T.StructField("stratum", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("n_words", T.LongType())])

LONG = " ".join(f"word{i % 977} and{i}" for i in range(30_000))
EDGE_TEXTS = [
    (1, None, None, None), (2, "", "en", "b"), (3, "  \t\n\x0b\x0c\r ", "en", "a"), (4, "one", "en", "a"), (5, "One two", "en", "a"),
    (6, "one two three", "en", "a"), (7, "ONE two\nthree", "en", "b"), (8, LONG, "en", "c"), (9, LONG + " tail", None, "c"),
    (10, "été straße 中文 \U0001f642 naïve <|endoftext|> it's 1999!!", "fr", "c"),
    (10, "été straße 中文 \U0001f642 naïve <|endoftext|> it's 1999!!", "fr", "c"),
    (11, "1234 5678 !!! ###", "de", None), (12, "a\x00b \x1c c\x85d", "de", "d"), (None, "no id here at all", "en", "d"),
    (13, "the cat sat on the mat " * 40, "en", "a"), (14, "same line\n" * 60, "en", "a")]


def documents(spark, rows):
    """(doc_id, text, lang, source) rows as a documents table with clashing extra columns."""
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), "x", None, 7, 1, True, "y", 0.5, 3) for i, t, lang, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def edge(spark):
    return documents(spark, EDGE_TEXTS).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])


@pytest.fixture
def staging(spark):
    with Staging(spark) as s:
        yield s
