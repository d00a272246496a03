"""Hand-tuned scorers: cosine-style field score, BM25F and the window boost.

P15 cosine tf, P16 weighted field score, P17 BM25F lengths/averages, P18
BM25F tf, P19 BM25F score, P20-P22 windows, P23 boost, P24 window score.
All per-word sums are ``aggregate`` lambdas over the candidate's ``qterms``
(see ``features``); the only shuffles are the query-term join and, for BM25F,
one global aggregate for the average field lengths (five scalars).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.functions import text as TX
from ordo.functions import window as W
from ordo.operators.features import FIELDS, attach_query_terms, bound_tokens, raw_tf, with_tokens

# Fixed weights of the scorers.
COSINE_WEIGHTS = {"url": 10.0, "title": 10.0, "header": 7.0, "anchor": 8.0, "body": 0.6}
BM25_WEIGHTS = {"url": 1.1, "title": 0.7, "header": 0.5, "body": 0.5, "anchor": 0.8}
BM25_B = {"url": 1.1, "title": 0.6, "header": 0.4, "body": 0.1, "anchor": 1.0}
BM25_K1 = 1.7
PAGERANK_LAMBDA = 8.0
PAGERANK_LAMBDA_PRIME = 9.5


def scorer_idf(e) -> Column:
    return F.coalesce(e["idf"], F.lit(TX.UNSEEN_IDF_SCORERS))


def cosine_tf(field: str, w: Column, m: Column, tok=F.col) -> Column:
    """log10(1 + tf) / (body_length + 15000); NULL when 1 + tf <= 0."""
    return F.log10(1 + raw_tf(field, w, m, tok)) / (F.col("body_length").cast("double") + TX.BODY_SMOOTHING_COSINE)


def _section_sum(e, tok) -> Column:
    out = None
    for f in FIELDS:
        term = COSINE_WEIGHTS[f] * cosine_tf(f, e["word"], e["m"], tok)
        out = term if out is None else out + term
    return out


def field_score_col() -> Column:
    """Sum over query words (with repeats) of tf_q * idf * sum_f w_f * ntf_f."""
    return bound_tokens(lambda tok: F.aggregate(
        F.col("qterms"), F.lit(0.0), lambda acc, e: acc + e["m"] * e["m"] * scorer_idf(e) * _section_sum(e, tok)))


def prepare(cands: DataFrame, idf: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    return with_tokens(attach_query_terms(cands, idf, queries=queries))


# ------------------------------------------------------------------ BM25F

def _length_cols() -> list[Column]:
    heads = F.coalesce(F.col("headers"), F.array().cast("array<string>"))
    anchor_texts = F.coalesce(F.map_keys(F.col("anchors")), F.array().cast("array<string>"))
    return [
        F.col("body_length").cast("double").alias("len_body"),
        F.when(F.col("url").isNotNull(), TX.word_count(F.col("url"), r"\W+")).otherwise(0)
        .cast("double").alias("len_url"),
        F.when(F.col("title").isNotNull(), TX.word_count(F.col("title"), r"\s+")).otherwise(0)
        .cast("double").alias("len_title"),
        F.aggregate(heads, F.lit(0), lambda a, h: a + TX.word_count(h, r"\s+")).cast("double").alias("len_header"),
        F.aggregate(anchor_texts, F.lit(0), lambda a, t: a + TX.word_count(t, r"\s+")).cast("double")
        .alias("len_anchor")]


def field_lengths(cands: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """P17 per document: raw field lengths and how many units each adds to the average."""
    heads = F.coalesce(F.col("headers"), F.array().cast("array<string>"))
    anchor_texts = F.coalesce(F.map_keys(F.col("anchors")), F.array().cast("array<string>"))
    return cands.select(
        "query_id", "doc_pos", *keep, *_length_cols(),
        F.lit(1).alias("n_body"),
        F.col("url").isNotNull().cast("int").alias("n_url"),
        F.col("title").isNotNull().cast("int").alias("n_title"),
        F.size(heads).alias("n_header"),
        F.size(anchor_texts).alias("n_anchor"))


def average_lengths(cands: DataFrame) -> DataFrame:
    """One row avg_<field> = sum of lengths / number of units.

    Body and url per document, title per titled document, header per header,
    anchor per anchor text (as the reference counts them). A row with ``times``
    stands for that many equal candidates.
    """
    if "times" not in cands.columns:
        cands = cands.withColumn("times", F.lit(1))
    L = field_lengths(cands, ("times",))
    return L.agg(*[F.try_divide(F.sum(F.col(f"len_{f}") * F.col("times")), F.sum(F.col(f"n_{f}") * F.col("times")).cast("double")).alias(f"avg_{f}")
                   for f in FIELDS])


def bm25_tf(field: str, w: Column, m: Column, tok=F.col) -> Column:
    """Tf / (1 + b_f (len_f / avg_f - 1)); tf = 0 -> 0; denominator <= 0 -> NULL.

    Needs ``len_<f>`` and ``avg_<f>`` columns (``with_bm25_lengths``).
    """
    tf = raw_tf(field, w, m, tok)
    den = 1 + BM25_B[field] * (F.try_divide(F.col(f"len_{field}"), F.col(f"avg_{field}")) - 1)
    return F.when(tf == 0, F.lit(0.0)).when(den > 0, tf / den)


def with_bm25_lengths(prepared: DataFrame, cands: DataFrame | None = None) -> DataFrame:
    """Attach per-document lengths and the corpus averages.

    ``cands`` are the same candidates, or their pages with ``times``, for the averages, where they cost less than ``prepared``."""
    # The averages are one global aggregate row; its five numbers come back to
    # the driver and enter the plan as literals (a scalar, not a join).
    avg = average_lengths(prepared if cands is None else cands).first()
    out = prepared
    for f in FIELDS:
        out = out.withColumn(f"avg_{f}", F.lit(avg[f"avg_{f}"]).cast("double"))
    return out.select("*", *_length_cols())


def bm25_score_col() -> Column:
    """Sum over words (with repeats) of W/(W + k1) * idf + 8 ln(page_rank + 9.5)."""
    def term(e, tok):
        wsum = None
        for f in FIELDS:
            t = BM25_WEIGHTS[f] * bm25_tf(f, e["word"], e["m"], tok)
            wsum = t if wsum is None else wsum + t
        return e["m"] * (wsum / (wsum + BM25_K1)) * scorer_idf(e)
    words = bound_tokens(lambda tok: F.aggregate(F.col("qterms"), F.lit(0.0), lambda acc, e: acc + term(e, tok)))
    return words + PAGERANK_LAMBDA * F.ln(F.col("page_rank") + PAGERANK_LAMBDA_PRIME)


# ------------------------------------------------------------------ windows

def query_word_array() -> Column:
    return TX.query_words(F.col("query"))


def doc_window_col(mode: str = "lockstep") -> Column:
    """Min over body (when #hit terms = #query words with repeats), url,
    title, each header and each anchor text; NULL when there is none. ``mode`` as in P20."""
    return TX.let(query_word_array(), lambda words: _doc_window(words, mode))


def _doc_window(words: Column, mode: str) -> Column:
    body = F.when(F.col("body_hits").isNotNull() & (F.size(F.col("body_hits")) == F.size(words)),
                  (W.lockstep_window if mode == "lockstep" else W.exact_window)(F.map_values(F.col("body_hits"))))
    heads = F.coalesce(F.col("headers"), F.array().cast("array<string>"))
    anchor_texts = F.coalesce(F.map_keys(F.col("anchors")), F.array().cast("array<string>"))
    cands = F.concat(
        F.array(body, W.text_window(F.col("url"), words, mode), W.text_window(F.col("title"), words, mode)),
        F.transform(heads, lambda h: W.text_window(h, words, mode)),
        F.transform(anchor_texts, lambda t: W.text_window(t, words, mode)))
    return F.array_min(F.filter(cands, lambda x: x.isNotNull()))


def boost_col(window: Column) -> Column:
    return W.boost(window, F.size(F.array_distinct(query_word_array())))
