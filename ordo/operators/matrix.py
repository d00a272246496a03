"""Feature assembly (P25) and the pointwise ranker.

``feature_matrix`` builds one row per candidate with the five tf-idf features
plus the enabled extras, in the fixed order bm25, smallest_window,
page_rank, is_pdf, has_tilda, field_score (default on: smallest_window,
is_pdf, has_tilda). Everything is one projection over the prepared candidates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.functions import text as TX
from ordo.operators import scorers as SC
from ordo.operators.features import FEATURE_NAMES, five_features
from ordo.operators.ranking import group_rank

EXTRAS_ORDER = ("bm25", "smallest_window", "page_rank", "is_pdf", "has_tilda", "field_score")
DEFAULT_EXTRAS = ("smallest_window", "is_pdf", "has_tilda")


def feature_matrix(cands: DataFrame, idf: DataFrame, extras: Sequence[str] = DEFAULT_EXTRAS,
                   keep: Sequence[str] = (), queries: DataFrame | None = None) -> DataFrame:
    """P25: (query_id, doc_pos, keep..., url_w..anchor_w, extras...)."""
    p = SC.prepare(cands, idf, queries)
    if "bm25" in extras:
        p = SC.with_bm25_lengths(p)
    if "smallest_window" in extras:
        # window and field score once per row as columns; the boost refers to
        # the window four times and lambdas are not de-duplicated by the optimizer
        p = p.withColumns({"_win": SC.doc_window_col(), "_fs": SC.field_score_col()})
    elif "field_score" in extras:
        p = p.withColumn("_fs", SC.field_score_col())
    cols = []
    extra_cols = {
        "bm25": lambda: SC.bm25_score_col(),
        "smallest_window": lambda: SC.boost_col(F.col("_win")) * F.col("_fs"),
        "page_rank": lambda: F.col("page_rank").cast("double"),
        "is_pdf": lambda: TX.is_pdf(F.col("url")),
        "has_tilda": lambda: TX.has_tilde(F.col("url")),
        "field_score": lambda: F.col("_fs"),
    }
    for name in EXTRAS_ORDER:
        if name in extras:
            cols.append(extra_cols[name]().alias(name))
    return p.select("query_id", "doc_pos", *keep, five_features().alias("_f"), *cols).select(
        "query_id", "doc_pos", *keep, *[F.col(f"_f.{n}") for n in FEATURE_NAMES], *[e for e in EXTRAS_ORDER if e in extras])


def feature_names(extras: Sequence[str] = DEFAULT_EXTRAS) -> list[str]:
    return list(FEATURE_NAMES) + [e for e in EXTRAS_ORDER if e in extras]


def linear_score(weights: dict[str, float]) -> Column:
    """w . f over named feature columns (NULL features count as missing -> NULL score)."""
    out = None
    for k, w in weights.items():
        t = F.lit(float(w)) * F.col(k)
        out = t if out is None else out + t
    return out


def rank_pointwise(scored: DataFrame, score_col: str = "score", strategy: str = "window") -> DataFrame:
    """Rank 1..n per query by score desc (NULL last), ties by doc_pos."""
    return group_rank(scored, ["query_id"], [F.col(score_col).desc_nulls_last(), F.col("doc_pos")],
                      "rank", strategy)
