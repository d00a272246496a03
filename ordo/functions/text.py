"""Column-level tokenisers and per-document predicates (no UDFs).

All functions take and return ``Column`` objects so they stay inside
whole-stage codegen / the JVM and compose into any projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference for equal results.
UNSEEN_IDF_FEATURES = 98998.0          # ln(98998) for words missing from the idf table (features)
UNSEEN_IDF_SCORERS = 1.0 / 98999.0     # 1 / (98998 + 1) for words missing from the idf table (scorers)
BODY_SMOOTHING_FEATURES = 2500.0       # body_length + 2500 divides the feature tf
BODY_SMOOTHING_COSINE = 15000.0        # body_length + 15000 divides the cosine-style tf
DEBUG_PREFIX = "Pagerank: "


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row: an expression that stands inside
    a lambda is evaluated for every element, a lambda variable is not."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _run_starts(sorted_keys: Column) -> Column:
    """Indexes at which a sorted array takes a new value (``sorted_keys`` bound by ``let``)."""
    return F.filter(F.sequence(F.lit(0), F.size(sorted_keys) - 1),
                    lambda i: (i == 0) | (F.get(sorted_keys, i) != F.get(sorted_keys, i - 1)))


def _runs(n: Column, starts: Column, take) -> Column:
    """``take(start, length)`` of each run of an array of ``n`` elements."""
    return F.transform(starts, lambda i, k: take(i, F.coalesce(F.get(starts, k + 1), n) - i))


def count_map(arr: Column) -> Column:
    """Array of strings -> map string -> occurrences, by one sort of the array."""
    empty = F.create_map().cast("map<string,int>")

    def counted(s: Column) -> Column:
        return let(_run_starts(s), lambda st: F.map_from_arrays(
            F.transform(st, lambda i: F.get(s, i)), _runs(F.size(s), st, lambda i, n: n)))
    return F.when(F.size(arr) > 0, let(F.sort_array(arr), counted)).otherwise(empty)


def grouped_values(pairs: Column) -> Column:
    """array<struct<key, value>> -> map key -> array of its values in order, by one sort."""
    def grouped(s: Column) -> Column:
        return let(F.struct(s["key"].alias("k"), s["value"].alias("v")), lambda kv: let(
            _run_starts(kv["k"]), lambda st: F.map_from_arrays(
                F.transform(st, lambda i: F.get(kv["k"], i)),
                _runs(F.size(kv["k"]), st, lambda i, n: F.slice(kv["v"], i + 1, n)))))
    return let(F.sort_array(pairs), grouped)


def positions_of(tokens: Column, words: Column) -> Column:
    """map word -> its positions in ``tokens``, for the ``words`` that occur; NULL for none."""
    def found(tw: Column) -> Column:
        hits = F.filter(F.transform(tw["t"], lambda t, i: F.struct(t.alias("key"), i.alias("value"))),
                        lambda x: F.array_contains(tw["w"], x["key"]))
        return let(hits, lambda h: F.when(F.size(h) > 0, grouped_values(h)))
    return let(F.struct(tokens.alias("t"), words.alias("w")), found)


def word_shingles(tokens: Column, k: int) -> Column:
    """Distinct 64-bit hashes of the runs of ``k`` words; none for a shorter text."""
    return let(tokens, lambda t: F.when(F.size(t) >= k, F.array_distinct(F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(t) - k, F.lit(0))), lambda i: F.xxhash64(F.slice(t, i + 1, F.lit(k)))))
    ).otherwise(F.array().cast("array<bigint>")))


def jsplit(s, pattern: str) -> Column:
    """Split ``s`` on regex ``pattern`` the way ``java.lang.String.split`` does.

    Trailing empty strings are dropped, inner and leading ones kept, and the
    empty string yields ``['']``. (Spark's ``split`` keeps trailing empties.)
    """
    def cut(p: Column) -> Column:
        whole = (F.size(p) == 1) | (F.get(p, F.size(p) - 1) != "")
        last = F.array_max(F.transform(p, lambda x, i: F.when(x != "", i + 1)))
        return F.when(whole, p).otherwise(F.slice(p, F.lit(1), F.coalesce(last, F.lit(0))))
    # The pieces are cut, not the text: a pattern anchored at the end is tried from every separator of a run.
    return let(F.split(_col(s), pattern), cut)


def query_words(query) -> Column:
    """Lower-case, split on one space."""
    return jsplit(F.lower(_col(query)), " ")


def url_tokens(url) -> Column:
    """``http:`` and ``%20`` become separators, lower-case, alphanumeric runs."""
    u = F.replace(F.replace(_col(url), F.lit("http:"), F.lit(".")), F.lit("%20"), F.lit("."))
    return F.array_remove(F.split(F.lower(u), "[^a-z0-9]+"), "")


def title_tokens(title) -> Column:
    """Split on one space, case kept."""
    return F.coalesce(jsplit(_col(title), " "), F.array().cast("array<string>"))


def header_tokens(headers) -> Column:
    """Concatenation of each header's one-space split; NULL -> empty."""
    return F.coalesce(F.flatten(F.transform(_col(headers), lambda h: jsplit(h, " "))),
                      F.array().cast("array<string>"))


def word_count(s, pattern: str) -> Column:
    """Number of pieces of a Java-style split (used for BM25F field lengths)."""
    return F.size(jsplit(_col(s), pattern))


def body_counts(body_hits) -> Column:
    """Term -> number of hit positions."""
    return F.transform_values(_col(body_hits), lambda k, v: F.size(v))


def is_pdf(url) -> Column:
    """1.0 when the lower-cased url ends with ``.pdf``."""
    return F.lower(_col(url)).endswith(".pdf").cast("double")


def has_tilde(url) -> Column:
    """1.0 when the url contains ``~``."""
    return _col(url).contains("~").cast("double")


def strip_scheme(url) -> Column:
    """The part after ``://`` (the whole url when there is none)."""
    u = _col(url)
    return F.coalesce(F.get(F.split(u, "://"), 1), u)


def debug_string(page_rank) -> Column:
    """``Pagerank: n``."""
    return F.concat(F.lit(DEBUG_PREFIX), _col(page_rank).cast("string"))


def alnum_tokens(text) -> Column:
    """Lower-cased ``[a-z0-9]+`` runs, empties dropped (view tokeniser for bodies)."""
    # array_remove is code-generated; a filter lambda would be interpreted per token
    return F.array_remove(F.split(F.lower(_col(text)), "[^a-z0-9]+"), "")
