import pytest
from pyspark.sql import types as T

FOLDER = "/root/testdata/sf0.01"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # columns whose names the operators use inside
    T.StructField("id", T.StringType()), T.StructField("n", T.StringType()), T.StructField("digest", T.StringType()),
    T.StructField("kept", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) with extra columns of clashing names."""

    def make(rows, partitions=3):
        return spark.createDataFrame([(i, t, "x", None, "y", "z") for i, t in rows], DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


ODD_TEXTS = [
    None, "", " ", "\t\n", "a", "a b", "A  b", "é É ß ﬁ ① ▁▁x", "\x00 \x01", "word " * 3000, "x" * 20_000,
    "😀😀 ​ z", "1 2 3 4 5 6 7 8 9 10", "no\r\nbreak\x0bhere\x0cnow", "a", "a b",
]


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, blanks, long texts, ties, repeated rows and a null id."""
    rows = [(10 + i, t) for i, t in enumerate(ODD_TEXTS)]
    return make_docs(rows + rows[4:6] + [(None, "a b"), (None, None)])
