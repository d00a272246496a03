"""Side-by-side comparison of two experiments.

An experiment is a ranked, judged result table ``(query_id, rank, url, rel)``
plus its per-query NDCG ``(query_id, ndcg)``. Comparisons are joins on the
query key and on (query, rank); set checks are anti-joins whose non-empty
result raises, so nothing is collected but the first offending key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sign_class(diff: Column) -> Column:
    """A6 colour of a difference: green > 0, black = 0, red < 0."""
    return F.when(diff > 0, "green").when(diff == 0, "black").otherwise("red")


def compare_mean(ndcg_a: DataFrame, ndcg_b: DataFrame) -> DataFrame:
    """Mean NDCG of each experiment and the difference B - A (one pass
    over the union, conditional averages — no join of the two sides)."""
    u = (ndcg_a.select(F.lit("a").alias("side"), "ndcg")
         .unionByName(ndcg_b.select(F.lit("b").alias("side"), "ndcg")))
    m = u.agg(F.avg(F.when(F.col("side") == "a", F.col("ndcg"))).alias("mean_a"),
              F.avg(F.when(F.col("side") == "b", F.col("ndcg"))).alias("mean_b"))
    m = m.withColumn("diff", F.col("mean_b") - F.col("mean_a"))
    return m.withColumn("color", sign_class(F.col("diff")))


def compare_by_query(ndcg_a: DataFrame, ndcg_b: DataFrame, digits: int | None = None) -> DataFrame:
    """J7 + A6 + R5: per query NDCG of A and B, difference, colour, order
    position by (diff, query) as the report sorts them."""
    j = (ndcg_a.select("query_id", F.col("ndcg").alias("ndcg_a"))
         .join(ndcg_b.select("query_id", F.col("ndcg").alias("ndcg_b")), "query_id"))
    d = F.col("ndcg_b") - F.col("ndcg_a")
    j = j.withColumn("diff", F.round(d, digits) if digits is not None else d)
    return j.withColumn("color", sign_class(F.col("diff")))


def order_by_diff(by_query: DataFrame) -> DataFrame:
    """Queries sorted by NDCG difference ascending, then query (a global sort)."""
    return by_query.orderBy(F.col("diff"), F.col("query_id"))


def compare_by_rank(list_a: DataFrame, list_b: DataFrame) -> DataFrame:
    """J7 row-wise zip: result i of A beside result i of B, truncated to the shorter list."""
    a = list_a.select("query_id", "rank", F.col("url").alias("url_a"), F.col("rel").alias("rating_a"))
    b = list_b.select("query_id", "rank", F.col("url").alias("url_b"), F.col("rel").alias("rating_b"))
    return a.join(b, ["query_id", "rank"])


def query_set_diff(list_a: DataFrame, list_b: DataFrame) -> DataFrame:
    """Queries present in only one experiment (side 'a' or 'b')."""
    qa = list_a.select("query_id").distinct()
    qb = list_b.select("query_id").distinct()
    return (qa.join(qb, "query_id", "left_anti").withColumn("side", F.lit("a"))
            .unionByName(qb.join(qa, "query_id", "left_anti").withColumn("side", F.lit("b"))))


def url_set_diff(list_a: DataFrame, list_b: DataFrame) -> DataFrame:
    """(query, url) present in only one experiment."""
    ua = list_a.select("query_id", "url").distinct()
    ub = list_b.select("query_id", "url").distinct()
    keys = ["query_id", "url"]
    return (ua.join(ub, keys, "left_anti").withColumn("side", F.lit("a"))
            .unionByName(ub.join(ua, keys, "left_anti").withColumn("side", F.lit("b"))))


def check_comparable(list_a: DataFrame, list_b: DataFrame) -> None:
    """Raise (as the report renderer does) when query or url sets differ."""
    bad_q = query_set_diff(list_a, list_b).limit(1).collect()
    if bad_q:
        raise ValueError(f"experiments contain different queries, e.g. {bad_q[0].asDict()}")
    bad_u = url_set_diff(list_a, list_b).limit(1).collect()
    if bad_u:
        raise ValueError(f"experiments contain different urls, e.g. {bad_u[0].asDict()}")
