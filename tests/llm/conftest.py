import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing extra columns."""
    long = "lorem ipsum dolor sit amet " * 20_000
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", "en", None, 3),
            (5, long, "en", "b", len(long)), (6, long + "tail", "en", "b", None), (7, "same text for two rows here", "en", "b", 27),
            (7, "same text for two rows here", "en", "b", 27), (8, "same text for two rows here", "de", "c", 27),
            (None, "a row without an id", "en", "c", 19), (None, None, None, None, None),
            (9, "token = \"0123abcdef0123abcdef0123\" größe 日本語 naïve", "de", "c", 50)]
    clash = ["size", "score", "shard", "rank", "_b", "_r", "_n", "root", "copies", "kept"]
    df = spark.createDataFrame(rows, DOC)
    for k, c in enumerate(clash):
        df = df.selectExpr("*", f"{k} as {c}")
    return df


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOC)
