"""Pairwise training and scoring without materialising pairs.

The reference builds every ordered document pair of a query (training: pairs
with different grades, features f(d2) - f(d1), positive iff rel(d1) > rel(d2);
scoring: all pairs, compared by the model). The pair table grows with the
square of a result list, so here nothing is paired. Everything a linear
pairwise learner and the pairwise ranker need is an exact function of
per-(query, grade) moments:

* pair counts      n^2 - sum_g n_g^2;
* difference sums  sum_{g1 > g2} (n_g1 s_g2 - n_g2 s_g1);
* difference Gram  sum_{g1 > g2} (n_g1 Q_g2 + n_g2 Q_g1 - s_g1 s_g2' - s_g2 s_g1');

with n_g, s_g = sum f, Q_g = sum f f' per grade, computed by one aggregate
(map-side partial aggregation — a hot query costs one partial row per task)
and cumulative sums over the grades of each query (a window over at most
``#grade levels`` rows per query). Win counts of a linear model (J6 + A11)
are "documents scored strictly lower", i.e. a rank, not a self-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordo.operators.ranking import group_rank


def grade_moments(fm: DataFrame, cols: Sequence[str], rel_col: str = "rel",
                  second_order: bool = False, by: Sequence[str] = (), weight_col: str | None = None) -> DataFrame:
    """(query_id, grade, n, s_<c>..., [q_<a>_<b>...]) per query and grade level.

    ``by`` are columns that are one value per query; a row of weight w counts as w rows."""
    u = None if weight_col is None else F.col(weight_col).cast("double")
    weighed = lambda x: x if u is None else u * x
    aggs = [(F.count(F.lit(1)) if u is None else F.sum(u)).alias("n")] + [F.sum(weighed(F.col(c))).alias(f"s_{c}") for c in cols]
    if second_order:
        for i, a in enumerate(cols):
            for b in cols[i:]:
                aggs.append(F.sum(weighed(F.col(a) * F.col(b))).alias(f"q_{a}__{b}"))
    return fm.groupBy("query_id", *by, F.col(rel_col).alias("grade")).agg(*aggs)


def _below(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Add cumulative sums over strictly lower grades of the same query."""
    w = Window.partitionBy("query_id").orderBy("grade").rowsBetween(Window.unboundedPreceding, -1)
    # one projection for all running sums (one Window operator, one analysis)
    return df.select("*", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("n_below"),
                     *[F.coalesce(F.sum(c).over(w), F.lit(0.0)).alias(f"b_{c}") for c in cols])


def pair_stats(fm: DataFrame, cols: Sequence[str], rel_col: str = "rel") -> DataFrame:
    """J5 summary per query: n_docs, n_pairs (ordered, different grade, both
    directions) and ``pos_diff_<c>`` = sum over positive-labelled pairs of
    f(d2) - f(d1), i.e. over pairs with rel(d1) > rel(d2)."""
    g = grade_moments(fm, cols, rel_col)
    s_cols = [f"s_{c}" for c in cols]
    b = _below(g, s_cols)
    # pairs (d1 in g, d2 below g): sum f(d2) - f(d1) = n_g * S_below - N_below * s_g
    contrib = [(F.col("n") * F.col(f"b_s_{c}") - F.col("n_below") * F.col(f"s_{c}")).alias(f"pos_diff_{c}")
               for c in cols]
    per = b.select("query_id", "n", (F.col("n") * F.col("n")).alias("n2"), *contrib)
    return per.groupBy("query_id").agg(
        F.sum("n").alias("n_docs"),
        (F.sum("n") * F.sum("n") - F.sum("n2")).alias("n_pairs"),
        *[F.sum(f"pos_diff_{c}").alias(f"pos_diff_{c}") for c in cols])


def pair_gram(fm: DataFrame, cols: Sequence[str], rel_col: str = "rel", by: Sequence[str] = (),
              weight_col: str | None = None) -> DataFrame:
    """M3 sufficient statistics, one global row (or one per value of ``by``): ``n_pos`` pairs with
    rel(d1) > rel(d2), ``d_<c>`` = sum of d = f(d1) - f(d2) and ``g_<a>__<b>`` = sum of d d' over them.
    With weights a pair counts as the product of its rows' weights, as copies of the rows would.

    A linear model trained on the balanced pair set {(d, +1), (-d, -1)} sees
    exactly twice these sums, so any least-squares pairwise fit needs nothing else.
    """
    cols = list(cols)
    g = grade_moments(fm, cols, rel_col, second_order=True, by=by, weight_col=weight_col)
    q_cols = [f"q_{a}__{b}" for i, a in enumerate(cols) for b in cols[i:]]
    b = _below(g, [f"s_{c}" for c in cols] + q_cols)
    terms = [(F.col("n") * F.col("n_below")).alias("n_pos")]
    for c in cols:   # d = f(d1) - f(d2), d1 in g, d2 below
        terms.append((F.col("n_below") * F.col(f"s_{c}") - F.col("n") * F.col(f"b_s_{c}")).alias(f"d_{c}"))
    for i, a in enumerate(cols):
        for bb in cols[i:]:
            q = f"q_{a}__{bb}"
            terms.append((F.col("n_below") * F.col(q) + F.col("n") * F.col(f"b_{q}")
                          - F.col(f"s_{a}") * F.col(f"b_s_{bb}") - F.col(f"b_s_{a}") * F.col(f"s_{bb}"))
                         .alias(f"g_{a}__{bb}"))
    per = b.select(*by, *terms)
    return per.groupBy(*by).agg(*[F.sum(c).alias(c) for c in per.columns if c not in by])


def pair_wins(scored: DataFrame, score_col: str = "score", strategy: str = "window") -> DataFrame:
    """J6 + A11 for a linear model: wins(d) = documents of the query scored
    strictly lower than d (the comparator's positive outcomes).

    wins = (position by score ascending) - (position among equal scores):
    two ``group_rank`` numberings, so a query holding a third of all rows —
    or a score shared by most of them — is numbered by the skew-safe plan.
    NULL scores sort first and tie with each other.
    """
    s = F.col(score_col)
    r = group_rank(scored, ["query_id"], [s.asc_nulls_first(), F.col("doc_pos")], "_up", strategy)
    r = r.withColumn("_score_key", s)
    r = group_rank(r, ["query_id", "_score_key"], [F.col("doc_pos")], "_tie", strategy)
    return r.withColumn("wins", (F.col("_up") - F.col("_tie")).cast("long")).drop("_up", "_tie", "_score_key")


def rank_pairwise(scored: DataFrame, score_col: str = "score", strategy: str = "window") -> DataFrame:
    """R2: order by wins desc, then decision value desc, then doc_pos. A query
    with a single document keeps it at rank 1."""
    won = pair_wins(scored, score_col, strategy)
    return group_rank(won, ["query_id"], [F.col("wins").desc(), F.col(score_col).desc_nulls_last(),
                                          F.col("doc_pos")], "rank", strategy)
