"""NDCG evaluation (A1, A2, R3, R4) and the unjudged-url report.

Semantics: gain ``2^rel - 1``; the discount of list position ``i`` (1-based,
counting only judged rows) is ``log2(i + 1)``; the ideal DCG sorts the *same*
list's grades descending; no cutoff; an ideal DCG of 0 gives NDCG 1. The mean
counts every ranked query, a query without any judged row adding 0.

Plan: position and ideal position are two ``group_rank`` columns (one shuffle
on the query key for the window plan, both sorts share it), then DCG and
ideal DCG are plain sums per query (partial aggregation), so the per-query
result never holds more than one row per query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.operators.ranking import group_rank


def _disc_gain(rel: Column, pos: Column) -> Column:
    return (F.pow(F.lit(2.0), rel) - 1.0) / F.log2(pos + 1)


# Position sums of one grade block are evaluated in chunks of this many
# positions, so a block holding millions of rows is spread over many rows.
POSITION_CHUNK = 100_000


def with_positions(judged: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                   rel_col: str = "rel", strategy: str = "window") -> DataFrame:
    """R3 + R4: list position by ``order`` and ideal position by grade."""
    out = group_rank(judged, group_cols, order, "pos", strategy)
    return group_rank(out, group_cols, [F.col(rel_col).desc()], "ideal_pos", strategy)


def ideal_dcg(judged: DataFrame, group_cols: Sequence[str], rel_col: str = "rel") -> DataFrame:
    """Ideal DCG from the grade histogram, without ranking any row.

    A block of c rows of grade g starting at ideal position a adds
    (2^g - 1) * sum_{r=a}^{a+c-1} 1 / log2(r + 1). Counts per (list, grade) are
    map-side combined; the block starts are running sums over a list's grade
    levels; each block's position sum is split into chunks of POSITION_CHUNK.
    """
    from pyspark.sql import Window
    g = list(group_cols)
    h = judged.groupBy(*g, F.col(rel_col).alias("_g")).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*g).orderBy(F.col("_g").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.select("*", (F.coalesce(F.sum("_c").over(w), F.lit(0)) + 1).alias("_start"))
    h = h.select("*", F.explode(F.sequence(F.lit(0).cast("long"),
                                           F.floor((F.col("_c") - 1) / POSITION_CHUNK).cast("long"))).alias("_k"))
    lo = F.col("_start") + F.col("_k") * POSITION_CHUNK
    hi = F.least(F.col("_start") + F.col("_c") - 1, lo + POSITION_CHUNK - 1)
    disc = F.aggregate(F.sequence(lo, hi), F.lit(0.0), lambda acc, r: acc + 1.0 / F.log2(r + 1))
    return h.groupBy(*g).agg(F.sum((F.pow(F.lit(2.0), F.col("_g")) - 1.0) * disc).alias("idcg"))


def ndcg_per_query(judged: DataFrame, group_cols: Sequence[str], order: Sequence[Column],
                   rel_col: str = "rel", strategy: str = "window") -> DataFrame:
    """A1: (group..., n, dcg, idcg, ndcg) over the judged rows of each list.

    Window plan: both positions from one shuffle (two sorts in place). Range
    (skew-safe) plan: the list position is ranked, the ideal DCG comes from
    the grade histogram (``ideal_dcg``), which saves a second range sort.
    """
    group_cols = list(group_cols)
    rel = F.col(rel_col)
    if strategy == "range":
        ranked = group_rank(judged, group_cols, order, "pos", strategy)
        dcg = ranked.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"),
                                              F.sum(_disc_gain(rel, F.col("pos"))).alias("dcg"),
                                              F.lit(None).cast("double").alias("idcg"))
        idcg = ideal_dcg(judged, group_cols, rel_col).select(
            *group_cols, F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("dcg"), "idcg")
        # union + one aggregate instead of a join of the two per-list tables
        out = dcg.unionByName(idcg).groupBy(*group_cols).agg(
            F.max("n").alias("n"), F.max("dcg").alias("dcg"), F.max("idcg").alias("idcg"))
    else:
        ranked = with_positions(judged, group_cols, order, rel_col, strategy)
        out = (ranked.groupBy(*group_cols)
               .agg(F.count(F.lit(1)).alias("n"),
                    F.sum(_disc_gain(rel, F.col("pos"))).alias("dcg"),
                    F.sum(_disc_gain(rel, F.col("ideal_pos"))).alias("idcg")))
    return out.withColumn("ndcg", F.when(F.col("idcg") == 0, F.lit(1.0))
                          .otherwise(F.col("dcg") / F.col("idcg")))


def mean_ndcg(per_query: DataFrame, ranked_queries: DataFrame | None = None,
              group_cols: Sequence[str] = ("query_id",)) -> DataFrame:
    """A2: mean over every ranked query; queries without judged rows add 0."""
    base = per_query
    if ranked_queries is not None:
        base = (ranked_queries.select(*group_cols).distinct()
                .join(per_query.select(*group_cols, "ndcg"), list(group_cols), "left"))
    return base.agg(F.count(F.lit(1)).alias("n_queries"),
                    F.avg(F.coalesce(F.col("ndcg"), F.lit(0.0))).alias("mean_ndcg"))


def judged_rows(ranked: DataFrame, rels: DataFrame, keys: Sequence[str],
                rel_col: str = "rel") -> DataFrame:
    """Ranked rows that have a judgement (inner join on the list keys)."""
    return ranked.join(rels.select(*keys, rel_col), list(keys), "inner")


def unjudged_rows(ranked: DataFrame, rels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """ranked rows without a judgement (the reference warns and skips them)."""
    return ranked.join(rels.select(*keys), list(keys), "left_anti")
