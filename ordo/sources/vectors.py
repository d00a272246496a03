"""Word-vector files (``WORD x1 ... xn`` per line, optionally gzip'd and
with a header line) as a ``(word, vec array<double>)`` DataFrame.

Width comes from the first vector line; wider rows are truncated to it and
narrower rows fail the job. The last line of a repeated word wins — an
aggregate (``max_by`` on the line ordinal, map-side combined), not a window,
so a word repeated a billion times does not land on one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed token aliases of the vector files.
START_WORD = "*START*"
END_WORD = "*END*"
UNKNOWN_WORD = "*UNK*"
UNKNOWN_ALIASES = ("UNKNOWN", "UUUNKKK", "UNK", "*UNKNOWN*", "<unk>")
START_ALIASES = ("<s>", "</s>")   # the reference maps the end tag to the start word as well


def read_vectors(spark: SparkSession, path: str, has_header: bool = False) -> DataFrame:
    lines = (spark.read.text(path)   # .gz is decompressed by the text source
             .select(F.monotonically_increasing_id().alias("line"), F.split(F.col("value"), r"\s+").alias("f")))
    if has_header:
        first = lines.agg(F.min("line").alias("m")).first()["m"]
        lines = lines.filter(F.col("line") != F.lit(first))
    word = F.get(F.col("f"), 0)
    word = (F.when(word.isin(*UNKNOWN_ALIASES), F.lit(UNKNOWN_WORD))
            .when(word.isin(*START_ALIASES), F.lit(START_WORD)).otherwise(word))
    rows = lines.select("line", word.alias("word"), (F.size("f") - 1).alias("dim"),
                        F.slice(F.col("f"), 2, 1 << 30).alias("x"))
    width = rows.agg(F.min_by("dim", "line").alias("d")).first()["d"]
    if width is None:
        return rows.select("word", F.array().cast("array<double>").alias("vec"))
    checked = rows.withColumn("x", F.when(
        F.col("dim") < width,
        F.raise_error(F.concat(F.lit(f"word vector narrower than the detected size {width}: "), F.col("word"))))
        .otherwise(F.slice(F.col("x"), 1, width)))
    vec = F.transform(F.col("x"), lambda v: v.cast("double"))
    return (checked.groupBy("word").agg(F.max_by(vec, F.col("line")).alias("vec")))
