"""Bottom-k sketches of shingle hashes, DataFrame functions only.

A sketch is the sorted array of the ``k`` smallest distinct hashes of a text's word
shingles. The ``k`` smallest of a union are among the ``k`` smallest of its parts, so
sketches merge by union, sort and cut. Below ``k`` hashes a sketch is the whole set and
all estimates are exact.

Estimates: resemblance is the share of the union's ``k`` smallest hashes that both
sketches hold; the number of distinct shingles is ``(k - 1) / v`` with ``v`` the k-th
smallest hash as a fraction of the hash range; containment of A in B follows from the
resemblance and the two counts.

Edge cases: null text is empty text; a text without words has an empty sketch; a text of
fewer words than a shingle is one shingle; two empty sketches have likeness 1, an empty
and a non-empty one 0; equal texts have equal sketches; repeated rows give repeated
results; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordo.llm.common import let, materialize
from ordo.operators.sizing import broadcast_if_small

K = 128
WORDS_EACH = 5
BUCKET_DOCS = 256            # documents that stand between two heads, about
MAX_BUCKETS = 1 << 14       # ranges of ids: their cuts and heads are small tables
_LOWEST = -(1 << 63)


def words(text: Column) -> Column:
    """Words between white space, letters as they are."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def sketch(text: Column, k: int = K, words_each: int = WORDS_EACH) -> Column:
    """array<bigint>: the k smallest distinct shingle hashes, in order."""
    def shingled(h: Column) -> Column:
        some = F.when(F.size(h) < words_each, F.array(F.xxhash64(F.concat_ws(",", h.cast("array<string>"))))).otherwise(
            F.transform(F.sequence(F.lit(0), F.greatest(F.size(h) - words_each, F.lit(0))),
                        lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(words_each)])))
        return F.when(F.size(h) > 0, some).otherwise(F.array().cast("array<bigint>"))

    hashes = F.transform(words(F.coalesce(text, F.lit(""))), lambda w: F.xxhash64(w))
    return F.slice(F.sort_array(F.array_distinct(let(hashes, shingled))), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(df: DataFrame, by: Sequence[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group from the sketches of its parts.

    Parts merge inside hashed sub-groups first, each cut to ``k`` again, so that a group
    with very many parts is not gathered in one place."""
    salt = F.pmod(F.xxhash64(sketch_col), F.lit(64))
    rows = df.select(*by, salt.alias("_s"), F.explode_outer(sketch_col).alias("_h")).distinct()
    best = Window.partitionBy(*by, "_s").orderBy(F.col("_h").asc_nulls_last())
    few = rows.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= k)
    return few.groupBy(*by).agg(F.slice(F.sort_array(F.collect_set("_h")), 1, k).alias(sketch_col))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of two sketched sets, 0 to 1."""
    def share(u: Column) -> Column:
        both = F.size(F.array_intersect(F.array_intersect(u, a), b))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u))
    return let(merged(a, b, k), share)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    fraction = (F.get(a, F.lit(k - 1)).cast("double") - float(_LOWEST)) / float(2 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / fraction)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that B holds, 0 to 1."""
    r = resemblance(a, b, k)
    na, nb = distinct_count(a, k), distinct_count(b, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), r * (na + nb) / (1.0 + r) / na))


def encoded(a: Column) -> Column:
    """Hashes as 16 hex digits each, one after another."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              mark: Callable[[Column], Column] | None = None) -> DataFrame:
    """(doc_id, text, next_text): the next text by descending id, the first behind the last;
    with ``mark`` also that function of both texts, computed once for each row.

    Ids are cut into ranges of about equal numbers of rows, by approximate quantiles. An id
    with more rows than two ranges is a range of its own, cut further by the hash of the text;
    so are null ids, which come last. Rows that share an id stand by that hash, then by text;
    only rows equal in both, whatever their number, stay together.

    Inside a range a window looks one row ahead. The row behind a range's last one is the
    head of the next range that has rows; it joins the range as a guest. Only the table of
    ranges (some ``MAX_BUCKETS`` rows at most) is ordered as a whole."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    cuts, parts, null_parts = _cuts(rows.select("doc_id"))
    spread = F.shiftrightunsigned(F.xxhash64("text"), 33)                     # 0 to 2^31 - 1
    rows = rows.withColumn("_b", F.when(F.col("doc_id").isNull(), -1).otherwise(_place(F.col("doc_id"), cuts)))
    rows = rows.withColumn("_h", spread).withColumn("_parts", F.when(F.col("_b") < 0, null_parts).otherwise(F.get(_numbers(parts, "int"), F.col("_b"))))
    rows = rows.withColumn("_s", F.shiftright(F.col("_h") * F.col("_parts"), 31)).drop("_parts")
    keys = ["_b", "_s"]
    heads = rows.groupBy(*keys).agg(F.max(F.struct("doc_id", (-F.col("_h")).alias("h"))).alias("head"))
    in_line = Window.orderBy(F.col("_b").desc(), F.col("_s"))
    order = materialize(heads.withColumn("_to", F.lag(F.struct(*keys)).over(in_line)))
    last = order.orderBy("_b", F.col("_s").desc()).select(*keys).first()
    wrap = F.struct(F.lit(last["_b"] if last else None).cast("int").alias("_b"), F.lit(last["_s"] if last else None).cast("bigint").alias("_s"))
    order = order.select(F.col("_b").alias("_hb"), F.col("_s").alias("_hs"), F.col("head.doc_id").alias("_hid"), (-F.col("head.h")).alias("_hh"),
                         F.coalesce("_to", wrap).alias("_to"))
    same = ((F.col("_b") == F.col("_hb")) & (F.col("_s") == F.col("_hs")) & F.col("doc_id").eqNullSafe(F.col("_hid"))
            & (F.col("_h") == F.col("_hh")))
    guests = (rows.join(broadcast_if_small(order, bound_rows=sum(parts) + null_parts), same)
              .groupBy("_to").agg(F.min("text").alias("text"))
              .select(F.lit(None).cast("bigint").alias("doc_id"), "text", F.col("_to._b").alias("_b"), F.col("_to._s").alias("_s"),
                      F.lit(0).cast("bigint").alias("_h"), F.lit(1).alias("_g")))
    line = Window.partitionBy(*keys).orderBy("_g", F.col("doc_id").desc_nulls_last(), "_h", "text")
    lined = rows.withColumn("_g", F.lit(0)).unionByName(guests).withColumn("next_text", F.lead("text").over(line))
    if mark is not None:       # on the same rows in the same order: no further shuffle or sort
        lined = lined.withColumn("mark", mark(F.col("text"))).withColumn(
            "next_mark", F.coalesce(F.lead("mark").over(line), F.col("mark")))
    return lined.where("_g = 0").withColumn("next_text", F.coalesce("next_text", "text")).drop("_g", "_h", *keys)


def _cuts(ids: DataFrame) -> tuple[list[int], list[int], int]:
    """(cuts, parts, null_parts): range i holds the ids with i cuts at or below them and is cut into ``parts[i]``."""
    n = ids.count()
    buckets = max(1, min(MAX_BUCKETS, n // BUCKET_DOCS))
    each = max(1, -(-n // buckets))
    found = ids.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)] or [0.5], 4 * buckets).alias("q"),
                    F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    # At most buckets / 2 ids have more rows than two ranges.
    hot = {r["doc_id"]: -(-r["n"] // each) for r in ids.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
           .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * each).collect()}
    cuts = sorted({*(found["q"] or ()), *hot, *(h + 1 for h in hot if h < (1 << 63) - 1)})
    return cuts, [1, *(hot.get(c, 1) for c in cuts)], max(1, -(-found["nulls"] // each))


def _numbers(values: Sequence[int], kind: str) -> Column:
    """A constant array, written as one literal: thousands of literals would make a slow plan."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _place(value: Column, cuts: Sequence[int]) -> Column:
    """How many of the rising ``cuts`` are at or below ``value``: binary search in whole numbers."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return let(F.struct(_numbers(cuts, "bigint").alias("c"), value.alias("v")), lambda x: F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(x["c"], at + step - 1) <= x["v"], at + step).otherwise(at)))


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last half (rounded down) replaced by as much of the start of ``following``."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.char_length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
                 words_each: int = WORDS_EACH) -> DataFrame:
    """Sketches of each text, of its edited text and its likeness to that and to the next text."""
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    lined = with_next(own, mark=lambda t: sketch(t, k, words_each))
    s, e, n = F.col("mark"), F.col("_e"), F.col("next_mark")
    return (lined.withColumn("_edited", edited(F.col("text"), F.col("next_text")))
            .withColumn("_e", sketch(F.col("_edited"), k, words_each))
            .select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"),
                    encoded(s).alias("fingerprint"), encoded(e).alias("edited_fingerprint"),
                    resemblance(s, e, k).alias("near_edited"), resemblance(s, n, k).alias("near_next"),
                    distinct_count(s, k).alias("n_shingles"), containment(s, e, k).alias("held_in_edited")))
