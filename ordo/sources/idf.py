"""IDF tables: S3 load (term, idf) and S3b build from a tokenised corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNT_BYTES = 8 << 20      # text whose words are counted at once


def load_idf(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S3: read ``term, idf`` (parquet, or csv with a header). Unseen terms are
    not rows: features use ln 98998 and scorers 1/98999 (``functions.text``)."""
    if fmt == "csv":
        return (spark.read.option("header", True).schema("term string, idf double").csv(path))
    return spark.read.parquet(path).select("term", F.col("idf").cast("double"))


def build_idf(docs: DataFrame, tokens_col: str, n_docs: int | None = None) -> DataFrame:
    """idf = ln(N / df) over a corpus of token arrays.

    Tokens are de-duplicated inside each row (no shuffle) and then counted
    with map-side partial aggregation; the corpus size N is one scalar.
    """
    n = n_docs if n_docs is not None else docs.count()
    df = (docs.select(F.explode(F.array_distinct(F.col(tokens_col))).alias("term"))
          .groupBy("term").agg(F.count(F.lit(1)).alias("df")))
    return _with_idf(df, n)


def build_idf_of_words(docs: DataFrame, words_col: str, n_docs: int | None = None) -> DataFrame:
    """``build_idf`` of texts whose tokens stand between spaces: counted by code in Arrow, and summed before
    the shuffle, so a row is a term of some MB of text and not one of each document."""
    n = n_docs if n_docs is not None else docs.count()
    counts = docs.select(words_col).mapInArrow(_count_rows, "term string, n bigint")
    return _with_idf(counts.groupBy("term").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("df")), n)


def _with_idf(df: DataFrame, n: int) -> DataFrame:
    return df.select("term", "df", F.ln(F.lit(float(n)) / F.col("df")).alias("idf"))


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: (term, n), the number of texts that hold the term, of each part of the texts."""
    for batch in batches:
        texts = batch.column(0)
        step = max(1, len(texts) * COUNT_BYTES // max(1, texts.nbytes))
        for at in range(0, len(texts), step):
            words = pc.split_pattern(texts.slice(at, step), " ")
            coded, row = words.flatten().dictionary_encode(), pc.list_parent_indices(words).to_numpy()
            terms = coded.dictionary
            pairs = np.sort(row.astype(np.int64) * len(terms) + coded.indices.to_numpy())
            first = np.ones(len(pairs), bool)
            np.not_equal(pairs[1:], pairs[:-1], out=first[1:])
            n = np.bincount(pairs[first] % max(1, len(terms)), minlength=len(terms))
            found = pa.RecordBatch.from_arrays([terms, pa.array(n, pa.int64())], ["term", "n"])
            yield found.filter(pc.not_equal(terms, ""))
