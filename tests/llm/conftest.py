import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor " * 4000
PLAIN = [
    (5, "The quick brown fox, it's 42 of them.\nNext line", "en"),
    (3, "Straße über ÄÖÜ ΟΔΟΣ café été İ", "de"),
    (3, "Straße über ÄÖÜ ΟΔΟΣ café été İ", "de"),       # a row again
    (7, "", "en"),
    (8, None, "en"),
    (9, LONG, None),
    (None, "no id here, none at all", "en"),
    (11, "  two  blanks\t\ttab\r\n\n <|endoftext|> end ", "en"),
    (12, "日本語 テキスト 👩‍👩‍👧 １２３ \x1c\x1d a b ​.", "und"),
    (13, "12345 !!! ... 678", None),
    (14, "a\x00b c", "en"),
]
#: Extra columns that clash with names the operators use.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("block", T.StringType()), T.StructField("key", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("range", T.IntegerType()),
])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, None, "b", 1, None, 0) for i, t, g in rows], SCHEMA)


@pytest.fixture(scope="session")
def edge_docs(spark):
    return frame(spark, PLAIN)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
