"""Scoring a stream of candidates with the batch operators.

The reference is batch-only; nothing here adds operators. Two idioms show
that its row-local work runs unchanged on Structured Streaming:

* ``row_features`` — pure per-row columns (url tokens, is_pdf, has_tilda,
  debug string, document window) applied directly to a streaming DataFrame;
* ``score_stream`` — ``foreachBatch`` hands each micro-batch to the batch
  feature assembly (``matrix.feature_matrix``, which joins the static idf
  table) and appends the rows with their batch id, so a restarted query that
  replays a batch writes rows that can be recognised by ``batch_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.functions import text as TX
from ordo.operators.scorers import doc_window_col


def row_features(cands: DataFrame) -> DataFrame:
    """Per-row features that need no other row (safe on a streaming frame)."""
    return cands.select("query_id", "doc_pos",
                        TX.url_tokens(F.col("url")).alias("url_tokens"),
                        TX.is_pdf(F.col("url")).alias("is_pdf"),
                        TX.has_tilde(F.col("url")).alias("has_tilda"),
                        TX.debug_string(F.col("page_rank")).alias("debug"),
                        doc_window_col().alias("window"))


def score_stream(stream: DataFrame, idf: DataFrame, out_path: str, checkpoint: str,
                 trigger_available_now: bool = True):
    """Start a query that writes ``feature_matrix`` rows of every micro-batch to parquet."""
    from ordo.operators.matrix import feature_matrix

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (feature_matrix(batch, idf).withColumn("batch_id", F.lit(batch_id))
         .write.mode("append").parquet(out_path))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if trigger_available_now:
        w = w.trigger(availableNow=True)
    return w.start()
