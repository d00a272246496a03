"""Line-oriented text formats of the reference, read and written by Spark.

Readers keep every line a row (``sources.lines``): each line learns its
query and document from a skew-safe forward fill over the global line order,
documents are assembled by aggregation per (query, document) — bounded by one
document's own lines — and document positions come from ``group_rank``. A
query with millions of results, or one continued in the next part file,
is read by many tasks.

S1 signal file, S2 relevance file (training: last duplicate wins), S2b
evaluation judgements (negative grades clipped to 0), S5 ranked-list writer,
S6 ranked-list reader, S7 experiment-report writer, S8 experiment-report
reader (malformed blocks flagged), S10 load counters.

Every reader takes ``lines``: the good lines of ``quarantine.checked_lines``, for files that
may hold malformed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordo.functions.text import grouped_values, jsplit, let

# Line keys of the signal format, as they appear in the files.
SIGNAL_KEYS = ("query", "url", "title", "header", "body_hits", "body_length", "pagerank",
               "anchor_text", "stanford_anchor_count")
ANCHOR_TEXT_KEY = "anchor_text"
ANCHOR_COUNT_KEY = "stanford_anchor_count"


def _lines(spark: SparkSession, path: str, lines: DataFrame | None) -> DataFrame:
    from ordo.sources.lines import read_ordered_lines
    return read_ordered_lines(spark, path, "url") if lines is None else lines


def _last(arr: Column) -> Column:
    return F.get(arr, F.size(arr) - 1)


def _latest(key: str) -> Column:
    """Value of the last ``key:`` line of the group (NULL when there is none)."""
    hit = F.col("key") == key
    return F.max_by(F.when(hit, F.col("val")), F.when(hit, F.col("gpos")))


def _ordered(keys: tuple[str, ...], with_key: bool = False) -> Column:
    """The group's ``keys`` lines in file order, as structs (gpos, [key,] val)."""
    fields = [F.col("gpos")] + ([F.col("key")] if with_key else []) + [F.col("val")]
    return F.array_sort(F.collect_list(F.when(F.col("key").isin(*keys), F.struct(*fields))))


def _documents(lines: DataFrame, aggs: list[Column]) -> DataFrame:
    """One row per document (lines from its opening line to the next), with
    ``doc_pos`` = 0-based position of the document inside its query."""
    from ordo.operators.ranking import group_rank
    docs = lines.filter(F.col("d_id").isNotNull()).groupBy("q_id", "query", "d_id").agg(*aggs)
    docs = group_rank(docs, ["q_id"], [F.col("d_id")], "_r", strategy="range")
    return docs.withColumn("doc_pos", F.col("_r") - 1).drop("_r")


def read_signal(spark: SparkSession, path: str, lines: DataFrame | None = None) -> DataFrame:
    """Signal file -> candidates(query_id, query, doc_pos, url, title, headers,
    body_hits, body_length, page_rank, anchors). Repeated body_hits lines of a
    term append; a repeated anchor text keeps its last count; other repeated
    keys keep the last value."""
    L = _lines(spark, path, lines)
    docs = _documents(L, [
        _latest("url").alias("url"), _latest("title").alias("title"),
        _ordered(("header",)).alias("_h"), _ordered(("body_hits",)).alias("_b"),
        _latest("body_length").cast("int").alias("body_length"),
        _latest("pagerank").cast("int").alias("page_rank"),
        _ordered((ANCHOR_TEXT_KEY, ANCHOR_COUNT_KEY), with_key=True).alias("_a")])
    # one sort by (term, line): a term's positions stand in line order
    hits = F.transform(F.col("_b"), lambda e: F.struct(
        F.substring_index(e["val"], " ", 1).alias("key"),
        F.struct(e["gpos"].alias("g"), F.transform(F.split(F.trim(F.regexp_replace(e["val"], "^[^ ]* ", "")), " "),
                                                   lambda p: p.cast("int")).alias("p")).alias("value")))
    merged_hits = F.transform_values(grouped_values(hits), lambda k, v: F.flatten(F.transform(v, lambda e: e["p"])))
    # A count line belongs to the anchor_text line just before it in the same document:
    # the lines from one text to the next are its counts.
    def counted(a: Column) -> Column:
        def of_text(i: Column, upto: Column) -> Column:
            return let(F.get(a, i)["val"], lambda t: F.transform(F.slice(a, i + 2, upto - i - 1), lambda e: F.struct(
                t.alias("key"), F.struct(e["gpos"].alias("g"), e["val"].cast("int").alias("c")).alias("value"))))
        texts = F.filter(F.transform(a, lambda e, i: F.when(e["key"] == ANCHOR_TEXT_KEY, i)), lambda i: i.isNotNull())
        return let(texts, lambda at: F.flatten(F.transform(
            at, lambda i, k: of_text(i, F.coalesce(F.get(at, k + 1), F.size(a))))))
    pairs = let(F.col("_a"), counted)
    merged_anchors = let(pairs, lambda p: F.when(F.size(p) == 0, F.create_map().cast("map<string,int>")).otherwise(
        F.transform_values(grouped_values(p), lambda k, v: _last(v)["c"])))
    has_anchor = F.exists(F.col("_a"), lambda e: e["key"] == ANCHOR_TEXT_KEY)
    return docs.select(
        F.col("q_id").alias("query_id"), "query", "doc_pos", "url", "title",
        F.when(F.size("_h") > 0, F.transform("_h", lambda e: e["val"])).alias("headers"),
        F.when(F.size("_b") > 0, merged_hits).alias("body_hits"),
        "body_length", "page_rank",
        F.when(has_anchor, merged_anchors).alias("anchors"))


def read_rels(spark: SparkSession, path: str, evaluation: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """Judgements (query, url, rel). A repeated query block replaces
    the earlier one, a repeated url keeps its last grade (both by aggregation,
    map-side combined); ``evaluation=True`` clips negative grades to 0."""
    L = _lines(spark, path, lines)
    latest = (L.filter(F.col("key") == "query").groupBy(F.col("val").alias("query"))
              .agg(F.max("gpos").alias("_lq")))
    parts = jsplit(F.col("val"), " ")
    u = L.filter(F.col("key") == "url").select(
        "q_id", "query", "gpos", F.trim(F.get(parts, 0)).alias("url"), F.get(parts, 1).cast("double").alias("rel"))
    if evaluation:
        u = u.withColumn("rel", F.greatest(F.col("rel"), F.lit(0.0)))
    u = u.join(latest, "query").filter(F.col("q_id") == F.col("_lq"))
    return u.groupBy("query", "url").agg(F.max_by("rel", "gpos").alias("rel"))


def load_counters(cands: DataFrame) -> DataFrame:
    """Number of queries and documents of a loaded signal set."""
    return cands.agg(F.countDistinct("query_id").alias("n_queries"),
                     F.count(F.lit(1)).alias("n_documents"))


def _with_heads(rows: DataFrame) -> DataFrame:
    """Mark each query's first row: the one with its least rank, whatever that is (the
    first results may have been dropped). One aggregate, joined back by query."""
    first = rows.groupBy("query_id").agg(F.min("rank").alias("_first"))
    return rows.join(first, "query_id")


def ranked_lines(ranked: DataFrame) -> DataFrame:
    """S5 text, one row per result: ``url``/``title``/``debug`` lines, the first
    result of a query prefixed by its ``query: w1 w2 `` line.

    Rows are never grouped per query: a global (query_id, rank) order written
    by range partitions keeps each block contiguous across part files, so a
    query with millions of results is written by many tasks.
    """
    words = jsplit(F.lower(F.col("query")), " ")
    head = F.concat(F.lit("query: "), F.concat_ws("", F.transform(words, lambda w: F.concat(w, F.lit(" ")))))
    item = F.concat(F.lit("  url: "), F.col("url"), F.lit("\n    title: "), F.coalesce(F.col("title"), F.lit("null")),
                    F.lit("\n    debug: "), F.coalesce(F.col("debug"), F.lit("null")))
    value = F.when(F.col("rank") == F.col("_first"), F.concat(head, F.lit("\n"), item)).otherwise(item)
    return _with_heads(ranked).select("query_id", "rank", value.alias("value"))


def _write_sorted_text(lines: DataFrame, path: str, num_files: int | None = None) -> None:
    keys = ("query_id", "rank")
    ranged = lines.repartitionByRange(num_files, *keys) if num_files else lines.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).select("value").write.mode("overwrite").text(path)


def write_ranked(ranked: DataFrame, path: str, num_files: int | None = None) -> None:
    """Write a ranked list (query blocks, results in rank order)."""
    _write_sorted_text(ranked_lines(ranked), path, num_files)


def read_ranked(spark: SparkSession, path: str, lines: DataFrame | None = None) -> DataFrame:
    """Ranked list -> (query_id, query, rank, url, title, debug)."""
    docs = _documents(_lines(spark, path, lines), [
        _latest("url").alias("url"), _latest("title").alias("title"), _latest("debug").alias("debug")])
    return docs.select(F.col("q_id").alias("query_id"), "query",
                       (F.col("doc_pos") + 1).cast("long").alias("rank"), "url", "title", "debug")


def report_lines(report: DataFrame) -> DataFrame:
    """S7 text per result: url/rating/title/debug; the first result of a query
    is prefixed by its ``query:`` and ``ndcg:`` lines (same layout as S5). A row
    without a url stands for a query that has no result to list: its head alone."""
    head = F.concat(F.lit("query: "), F.col("query"), F.lit("\nndcg: "), F.col("ndcg").cast("string"))
    item = F.concat(F.lit("  url: "), F.col("url"), F.lit("\n    rating: "), F.col("rating").cast("string"),
                    F.lit("\n    title: "), F.coalesce(F.col("title"), F.lit("null")),
                    F.lit("\n    debug: "), F.coalesce(F.col("debug"), F.lit("null")))
    value = (F.when(F.col("url").isNull(), head)
             .when(F.col("rank") == F.col("_first"), F.concat(head, F.lit("\n"), item)).otherwise(item))
    return _with_heads(report).select("query_id", "rank", value.alias("value"))


def judged_report(ranked: DataFrame, rels: DataFrame, per_query: DataFrame) -> DataFrame:
    """Rows of a report (S7) from a ranked list, judgements (query, url, rel) and NDCGs.

    Every ranked query stands in it, with NDCG 0 when none of its results is judged; of
    the results the judged ones are listed, as the evaluator skips the others."""
    queries = ranked.select("query_id", "query").distinct().join(per_query.select("query_id", "ndcg"), "query_id", "left")
    queries = queries.withColumn("ndcg", F.coalesce("ndcg", F.lit(0.0)))
    items = (ranked.join(rels.select("query", "url", F.col("rel").alias("rating")), ["query", "url"])
             .select("query_id", "rank", "url", "rating", "title", "debug"))
    out = queries.join(items, "query_id", "left")
    return out.withColumn("rank", F.coalesce("rank", F.lit(0).cast("long")))


def write_report(report: DataFrame, path: str, num_files: int | None = None) -> None:
    """Write an experiment report (needs query_id, rank, query, ndcg, url, rating, title, debug)."""
    _write_sorted_text(report_lines(report), path, num_files)


def read_report(spark: SparkSession, path: str, lines: DataFrame | None = None) -> DataFrame:
    """Experiment report -> (query, ndcg, rank, url, rating, title, debug, _corrupt).

    A query whose ``ndcg:`` line is missing, or with a result that is not
    exactly url / rating / title / debug in that order, is kept with
    ``_corrupt = true`` instead of failing the job.
    """
    L = _lines(spark, path, lines)
    head = (L.filter(F.col("q_id").isNotNull() & F.col("d_id").isNull())
            .groupBy("q_id", "query").agg(_latest("ndcg").cast("double").alias("ndcg"),
                                          F.count_if(F.col("key") == "ndcg").alias("_n_ndcg")))
    docs = _documents(L, [
        _latest("url").alias("url"), _latest("rating").cast("double").alias("rating"),
        _latest("title").alias("title"), _latest("debug").alias("debug"),
        F.array_sort(F.collect_list(F.struct("gpos", "key")))["key"].alias("_keys")])
    docs = docs.withColumn("_ok", F.col("_keys") == F.array(*[F.lit(k) for k in ("url", "rating", "title", "debug")]))
    bad = docs.groupBy("q_id").agg(F.min(F.col("_ok").cast("int")).alias("_all_ok"))
    q = head.join(bad, "q_id", "left").withColumn(
        "_corrupt", (F.col("_n_ndcg") != 1) | (F.coalesce(F.col("_all_ok"), F.lit(1)) == 0))
    out = q.join(docs.drop("query"), "q_id", "left")
    return out.select("query", "ndcg", (F.col("doc_pos") + 1).cast("long").alias("rank"), "url", "rating",
                      "title", "debug", "_corrupt")
