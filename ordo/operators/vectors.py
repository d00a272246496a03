"""Word -> vector lookup with the unknown-word fallback.

The vocabulary is joined, never collected; only the single fallback vector
(one row, of the embedding width) enters the plan as a literal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.sources.vectors import END_WORD, START_WORD, UNKNOWN_WORD


def special_vector(vectors: DataFrame, word: str):
    """The vector of ``*UNK*`` / ``*START*`` / ``*END*`` (or None)."""
    row = vectors.filter(F.col("word") == word).select("vec").first()
    return None if row is None else [float(v) for v in row["vec"]]


def lookup(words: DataFrame, vectors: DataFrame, word_col: str = "word") -> DataFrame:
    """Add ``in_vocab`` and ``vec`` (the word's vector, else the unknown vector)."""
    unk = special_vector(vectors, UNKNOWN_WORD)
    unk_col = (F.array(*[F.lit(v) for v in unk]) if unk is not None
               else F.lit(None).cast("array<double>"))
    v = vectors.select(F.col("word").alias("_vw"), F.col("vec").alias("_vec"))
    j = words.join(v, F.col(word_col) == F.col("_vw"), "left")
    return (j.withColumn("in_vocab", F.col("_vw").isNotNull())
            .withColumn("vec", F.coalesce(F.col("_vec"), unk_col)).drop("_vw", "_vec"))


def vocabulary_stats(vectors: DataFrame) -> DataFrame:
    """size (number of words) and the embedding width."""
    return vectors.agg(F.count(F.lit(1)).alias("size"), F.max(F.size("vec")).alias("dim"))


__all__ = ["lookup", "special_vector", "vocabulary_stats", "START_WORD", "END_WORD", "UNKNOWN_WORD"]
