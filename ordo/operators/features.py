"""Query vectors, field term frequencies and the five-field tf-idf vector.

Plan shape: the query side (a few words per query) is exploded, joined to the
idf table and folded back into one ``qterms`` array per query; candidates then
join that per-query row once. Every per-word quantity is a lambda over
``qterms`` evaluated inside the candidate row (``aggregate``/``transform``),
so tf, normalisation and the feature sums need no further shuffle: one join
on ``query_id`` replaces the reference's per-pair nested loops.

Operators: P5 anchor counts, P6 body counts (``functions.text``), P7 field tf,
P8 raw query tf, P9 query vector, P10 length normalisation, P11 five-field
vector, P14 page-rank feature, P25 feature toggles, P26 vector difference.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.functions import text as TX

FIELDS = ("url", "title", "body", "header", "anchor")
FEATURE_NAMES = tuple(f"{f}_w" for f in FIELDS)
TOKEN_COLUMNS = ("_url_toks", "_title_toks", "_header_toks", "_anchor_counts")


def query_table(cands: DataFrame) -> DataFrame:
    """(query_id, query) — one row per query (partial aggregation on the key)."""
    return cands.groupBy("query_id").agg(F.first("query").alias("query"))


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, word, m) — distinct query words with their multiplicity."""
    counted = TX.let(TX.query_words(F.col("query")), lambda words: F.transform(F.array_distinct(words), lambda w: F.struct(
        w.alias("word"), _count(words, w).alias("m"))))
    return queries.select("query_id", F.explode(counted).alias("t")).select("query_id", "t.word", "t.m")


def query_vector(terms: DataFrame, idf: DataFrame, sublinear: bool = True,
                 unseen: float = math.log(TX.UNSEEN_IDF_FEATURES)) -> DataFrame:
    """(query_id, word, m, idf, qv) with qv = (1 + ln m) * idf, unseen idf -> ln 98998.

    ``idf`` keeps NULL for unseen words so the scorers can apply their own default.
    """
    tf = (1 + F.ln(F.col("m"))) if sublinear else F.col("m").cast("double")
    j = terms.join(idf.select(F.col("term").alias("word"), "idf"), "word", "left")
    return j.select("query_id", "word", "m", "idf",
                    (tf * F.coalesce(F.col("idf"), F.lit(unseen))).alias("qv"))


def query_term_arrays(queries: DataFrame, idf: DataFrame, sublinear: bool = True) -> DataFrame:
    """(query_id, qterms): one row per query with its array<struct<word, m, idf, qv>>."""
    return query_vector(query_terms(queries), idf, sublinear).groupBy("query_id").agg(
        F.collect_list(F.struct("word", "m", "idf", "qv")).alias("qterms"))


def attach_query_terms(cands: DataFrame, idf: DataFrame, sublinear: bool = True,
                       queries: DataFrame | None = None) -> DataFrame:
    """Candidates + ``qterms`` array<struct<word, m, idf, qv>> (one join on query_id).

    ``queries(query_id, query)`` should come from the source's own query list;
    deriving it from ``cands`` (the fallback) re-evaluates the candidate plan.
    Candidates that carry ``qterms`` already (``page_ranking``) stay as they are.
    """
    if "qterms" in cands.columns:
        return cands
    q = queries if queries is not None else query_table(cands)
    return cands.join(query_term_arrays(q, idf, sublinear), "query_id")


def with_tokens(cands: DataFrame) -> DataFrame:
    """Materialise the field token arrays once per candidate row. Candidates that carry them
    already (``page_ranking``) stay as they are."""
    if all(c in cands.columns for c in TOKEN_COLUMNS):
        return cands
    return cands.withColumns({
        "_url_toks": TX.url_tokens(F.col("url")),
        "_title_toks": TX.title_tokens(F.col("title")),
        "_header_toks": TX.header_tokens(F.col("headers")),
        "_anchor_counts": _anchor_counts(F.col("anchors"))})


def _anchor_counts(anchors: Column) -> Column:
    """map token -> sum of the counts of its anchor texts, by one sort; NULL when a count is missing."""
    pairs = F.flatten(F.transform(F.map_entries(anchors), lambda kv: F.transform(TX.jsplit(kv["key"], " "), lambda t: F.struct(
        t.alias("key"), kv["value"].cast("long").alias("value")))))
    empty = F.create_map().cast("map<string,bigint>")
    summed = TX.let(pairs, lambda p: F.when(F.size(p) > 0, F.transform_values(
        TX.grouped_values(p), lambda _, v: F.aggregate(v, F.lit(0).cast("long"), lambda a, n: a + n))).otherwise(empty))
    return F.when(~F.exists(F.map_values(anchors), lambda n: n.isNull()), summed).when(anchors.isNull(), empty)


def bound_tokens(body) -> Column:
    """``body(tok)`` with the row's token arrays bound once; ``tok(name)`` gives a column of
    ``with_tokens``. Inside an ``aggregate`` lambda the arrays would be split again per word."""
    return TX.let(F.struct(*TOKEN_COLUMNS), lambda t: body(lambda name: t[name]))


def _count(arr: Column, w: Column) -> Column:
    return F.size(arr) - F.size(F.array_remove(arr, w))      # native; a lambda would be interpreted per token


def raw_tf(field: str, w: Column, m: Column, tok=F.col) -> Column:
    """Term frequency of word ``w`` (occurring ``m`` times in the query) in ``field``.

    url/title/header: exact-match counts x m. anchor: sum over anchor texts of
    occurrences x anchor count, x m. body: ``t <- ln((t + hits) / n)`` applied
    m times from 0, n = number of distinct hit terms; 0 when the word has no hit.
    Requires ``with_tokens`` columns, or ``tok`` from ``bound_tokens``.
    """
    if field == "url":
        return (_count(tok("_url_toks"), w) * m).cast("double")
    if field == "title":
        return (_count(tok("_title_toks"), w) * m).cast("double")
    if field == "header":
        return (_count(tok("_header_toks"), w) * m).cast("double")
    if field == "anchor":
        counts = tok("_anchor_counts")
        return (F.when(counts.isNotNull(), F.coalesce(counts[w], F.lit(0).cast("long"))) * m).cast("double")
    if field == "body":
        hits = F.size(F.col("body_hits")[w])
        n = F.size(F.col("body_hits"))
        fold = F.aggregate(F.sequence(F.lit(1), m), F.lit(0.0),
                           lambda t, _: F.ln((t + hits) / n))
        fold = F.when(m == 1, F.ln((F.lit(0.0) + hits) / n)).otherwise(fold)     # without a lambda for most words
        return F.when(F.col("body_hits")[w].isNotNull(), fold).otherwise(F.lit(0.0))
    raise ValueError(field)


def anchor_counts(docs: DataFrame, keys=("query_id", "doc_pos")) -> DataFrame:
    """P5: (keys..., token, count) — sum of anchor counts over token occurrences.

    Rows of one document are adjacent after the explodes, so the map-side
    partial aggregate leaves one row per (document, token) before the shuffle.
    """
    keys = list(keys)
    return (docs.select(*keys, F.explode("anchors").alias("text", "n"))
            .select(*keys, "n", F.explode(TX.jsplit(F.col("text"), " ")).alias("token"))
            .groupBy(*keys, "token").agg(F.sum("n").alias("count")))


def field_tf(cands: DataFrame, idf: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """P7 as a long table: (query_id, doc_pos, word, m, url_tf, title_tf, body_tf, header_tf, anchor_tf)."""
    c = with_tokens(attach_query_terms(cands, idf, queries=queries))
    c = c.select("*", F.explode("qterms").alias("e"))
    w, m = F.col("e.word"), F.col("e.m")
    return c.select("query_id", "doc_pos", w.alias("word"), m.cast("long").alias("m"),
                    *[raw_tf(f, w, m).alias(f"{f}_tf") for f in FIELDS])


def feature_vector(cands: DataFrame, idf: DataFrame, smoothing: float = TX.BODY_SMOOTHING_FEATURES,
                   keep: tuple[str, ...] = (), queries: DataFrame | None = None) -> DataFrame:
    """P10 + P11: five-field tf-idf vector per candidate.

    feature_f = sum over query words (with repeats) of tf_f / (len + 2500)^m * qv,
    i.e. sum over distinct words of m * tf_f / (len + 2500)^m * qv.
    """
    c = with_tokens(attach_query_terms(cands, idf, queries=queries))
    return c.select("query_id", "doc_pos", *keep, five_features(smoothing).alias("_f")).select(
        "query_id", "doc_pos", *keep, *[F.col(f"_f.{n}") for n in FEATURE_NAMES])


def five_features(smoothing: float = TX.BODY_SMOOTHING_FEATURES) -> Column:
    """struct<url_w..anchor_w> over ``qterms`` and the row's tokens.

    A word that a field doesn't hold adds 0, so only the words that it holds are summed where that is sure:
    a field that isn't NULL, a norm above 0 and finite query weights. A field without any of the words is 0
    by a test outside the lambdas, which are interpreted."""
    norm = F.col("body_length").cast("double") + smoothing
    weights, inf = F.col("qterms.qv"), F.lit(float("inf"))
    finite = (norm > 0) & (F.array_max(weights) < inf) & (F.array_min(weights) > -inf)

    def summed(f):
        held = F.map_keys("body_hits") if f == "body" else F.map_keys("_anchor_counts") if f == "anchor" else F.col(f"_{f}_toks")
        sure = finite & held.isNotNull()
        terms = F.when(sure, F.filter("qterms", lambda e: F.array_contains(held, e["word"]))).otherwise(F.col("qterms"))
        whole = bound_tokens(lambda tok: F.aggregate(
            terms, F.lit(0.0), lambda acc, e: acc + e["m"] * raw_tf(f, e["word"], e["m"], tok) / F.pow(norm, e["m"]) * e["qv"]))
        return F.when(sure & ~F.arrays_overlap("qterms.word", held), F.lit(0.0)).otherwise(whole)

    return F.struct(*[summed(f).alias(f"{f}_w") for f in FIELDS])


def vector_difference(a: DataFrame, b: DataFrame, cols, keys_a, keys_b) -> DataFrame:
    """B - a per feature column of paired rows, with the keys of ``a``."""
    right = b.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys_b)], *[F.col(c).alias(f"_b_{c}") for c in cols])
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys_a)]
    return a.join(right, on).select(*keys_a, *[(F.col(f"_b_{c}") - F.col(c)).alias(c) for c in cols])
