"""Source mixing by entropy balancing.

Targets: sources in code point order (null last) weigh 1, 2, 3, repeating, and share the
corpus size; a target stops at ``max_repeat`` times its source's size and the excess is
dealt out again by weight.

Rates: of all document rates r in [0, max_repeat] with sum(size * r) = target in each
source, entropy balancing takes those closest to 1 in relative entropy. Their form is an
exponential tilt, r = min(max_repeat, exp(lambda_source * size / scale_source)). The
duals minimise a convex function; its Newton steps, kept inside a bracket, run as Spark
aggregations over (source, size) cells: a document's rate depends on nothing else, so
cells stand for all documents. The dual table stays a DataFrame, written after each step.

Copies: cell by cell, largest sizes first, each source takes the whole copies that bring
its running total nearest to the running target, so what is left over at the end is
about half a small document. A cell deals its copies evenly to its sub-cells (by hash of
the id) and these to their documents in hash order. No group is larger than a sub-cell
or than the distinct sizes of one source.

Edge cases: null and empty texts have size 0 and rate 1 (they take no words); equal rows
are interchangeable; a null source is a source of its own; an empty table gives an empty
table; a source without words has target 0.
"""

from __future__ import annotations

import math
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordo.llm.common import materialize
from ordo.operators.ranking import group_rank

MAX_REPEAT = 3
SUB_CELLS = 256
WEIGHTS = (1, 2, 3)
STEPS = 60
TOLERANCE = 1e-7


def n_words(text: Column) -> Column:
    """Words are runs of anything but the six white-space characters."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    return F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(doc_id, source_key, size, sub): the key sorts by code point with null last."""
    key, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string")
    return docs.select(
        key.alias("doc_id"), F.when(source.isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), source)).alias("source_key"),
        n_words(F.col(f"`{text_col}`")).alias("size"), F.pmod(F.xxhash64(key), F.lit(SUB_CELLS)).cast("int").alias("sub"))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Add weight and target to (source_key, source_size).

    Each round caps the sources that their share would lift over the limit; what the
    others share is two sums. Rounds end when no source is new under the cap."""
    ranked = group_rank(sources.withColumn("_g", F.lit(0)), ["_g"], [F.col("source_key")], "_rank", strategy="range").drop("_g")
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weighed = materialize(ranked.withColumn("weight", F.get(listed, ((F.col("_rank") - 1) % len(weights)).cast("int"))).drop("_rank"))
    most = F.col("source_size") * float(max_repeat)
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    unit, fixed = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(unit) >= most if fixed >= 0 else F.lit(False)
        s = weighed.agg(F.sum(F.when(over, 1).otherwise(0)).alias("n"), F.sum(F.when(over, most).otherwise(0.0)).alias("held"),
                        F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("w")).first()
        if not s["w"] or (s["n"] or 0) == fixed:
            break
        fixed, unit = s["n"], (total - s["held"]) / s["w"]
    return weighed.withColumn("target", F.least(most, F.col("weight") * F.lit(unit)))


def rate(dual: Column, size: Column, scale: Column, max_repeat: int) -> Column:
    return F.when(size == 0, F.lit(1.0)).otherwise(F.exp(F.least(F.lit(math.log(max_repeat)), dual * size / scale)))


def solve(cells: DataFrame, goals: DataFrame, max_repeat: int = MAX_REPEAT, steps: int = STEPS,
          tolerance: float = TOLERANCE) -> DataFrame:
    """(source_key, dual, scale): duals at which each source's tilted words meet its target.

    Newton steps for all sources at once; a step that leaves the bracket is halved to its
    middle. Sources at their limit have no finite dual and take ``max_repeat`` throughout."""
    cap = math.log(max_repeat)
    scale = cells.where("size > 0").groupBy("source_key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    duals = materialize(
        goals.join(scale, "source_key", "left").select(
            "source_key", "target", "source_size", F.coalesce("scale", F.lit(1.0)).alias("scale"),
            F.lit(0.0).alias("dual"), F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"),
            ((F.col("source_size") == 0) | (F.col("target") >= F.col("source_size") * float(max_repeat))).alias("done")))
    for _ in range(steps):
        at = cells.join(duals.where(~F.col("done")).select("source_key", "dual", "scale"), "source_key")
        x = F.col("size") / F.col("scale")
        words = F.col("n") * F.col("size") * rate(F.col("dual"), F.col("size"), F.col("scale"), max_repeat)
        sums = at.groupBy("source_key").agg(
            F.sum(words).alias("words"), F.sum(F.when(F.col("dual") * x < cap, words * x).otherwise(0.0)).alias("slope"))
        gap = F.col("words") - F.col("target")
        lo = F.when(gap < 0, F.greatest("lo", "dual")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.least("hi", "dual")).otherwise(F.col("hi"))
        newton = F.col("dual") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("lo")) & (newton < F.col("hi")) & (F.abs(newton - F.col("dual")) <= 4.0)
        bounded = (F.col("lo") > float("-inf")) & (F.col("hi") < float("inf"))
        middle = F.when(bounded, (F.col("lo") + F.col("hi")) / 2).otherwise(
            F.col("dual") - F.signum("gap") * F.greatest(F.lit(1.0), F.abs("dual")))
        moved = (duals.join(sums, "source_key", "left").withColumn("gap", gap).withColumn("lo", lo).withColumn("hi", hi)
                 .withColumn("ok", F.col("done") | (F.abs("gap") <= F.col("target") * tolerance)))
        duals = materialize(moved.select(
            "source_key", "target", "source_size", "scale",
            F.when(F.col("ok"), F.col("dual")).when(inside, newton).otherwise(middle).alias("dual"),
            "lo", "hi", F.col("ok").alias("done")))
        if duals.agg(F.min(F.col("done").cast("int"))).first()[0] in (None, 1):
            break
    limit = F.col("target") >= F.col("source_size") * float(max_repeat)
    return duals.select("source_key", F.when(limit & (F.col("source_size") > 0), F.lit(float("inf"))).otherwise(
        F.col("dual")).alias("dual"), "scale")


def rounded(cells: DataFrame, max_repeat: int) -> DataFrame:
    """(source_key, size, n, copies): whole copies by (source, size), largest sizes first.

    ``cells`` has one row for each size that a source has, with its rate."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ascending=False, kind="stable")
        copies, ahead = [], 0.0          # words that the copies so far stand ahead of the rates
        for size, n, r in zip(pdf["size"], pdf["n"], pdf["rate"]):
            want = r * n
            take = round(want - ahead / size) if size else n
            take = int(min(max_repeat * n, max(0, take)))
            ahead += (take - want) * size
            copies.append(take)
        return pd.DataFrame({"source_key": pdf["source_key"], "size": pdf["size"], "n": pdf["n"], "copies": copies})

    return cells.groupBy("source_key").applyInPandas(run, "source_key string, size bigint, n bigint, copies bigint")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken and copies of every row."""
    rows = materialize(sized(docs, id_col, text_col, source_col))
    sub_cells = materialize(rows.groupBy("source_key", "size", "sub").agg(F.count(F.lit(1)).alias("m")))
    cells = materialize(sub_cells.groupBy("source_key", "size").agg(F.sum("m").alias("n")))
    goals = materialize(targets(cells.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                                weights, max_repeat))
    duals = solve(cells, goals, max_repeat)
    rates = cells.join(duals, "source_key").select(
        "source_key", "size", "n", rate(F.col("dual"), F.col("size"), F.col("scale"), max_repeat).alias("rate"))
    whole = rounded(rates, max_repeat)
    # A sub-cell's copies are a difference of floors, so they add up to the cell's.
    upto = Window.partitionBy("source_key", "size").orderBy("sub").rowsBetween(Window.unboundedPreceding, 0)
    part = "(cast(copies as decimal(19, 0)) * cast({} as decimal(19, 0))) div n"      # beyond 64 bits where a cell is large
    share = (sub_cells.withColumn("_upto", F.sum("m").over(upto)).join(whole, ["source_key", "size"])
             .withColumn("_a", F.expr(part.format("_upto"))).withColumn("_b", F.expr(part.format("(_upto - m)")))
             .join(goals.select("source_key", "source_size", "target"), "source_key")
             .select("source_key", "size", "sub", "m", (F.col("_a") - F.col("_b")).alias("give"), "source_size", "target"))
    rank = F.row_number().over(Window.partitionBy("source_key", "size", "sub").orderBy(F.xxhash64("doc_id", "size"), "doc_id"))
    copies = F.expr("give div m") + F.when(F.col("_r") <= F.expr("give % m"), 1).otherwise(0)
    return (rows.withColumn("_r", rank).join(share, ["source_key", "size", "sub"])
            .withColumn("copies", copies.cast("bigint"))
            .select("doc_id", "size", F.col("source_size").cast("bigint").alias("source_size"), "target",
                    (F.col("copies") * F.col("size")).alias("taken"), "copies", "source_key"))


def apply_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT, id_col: str = "doc_id",
              text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, with its own columns.

    Rows that share an id and a size share their copies in turn."""
    numbered = materialize(mix(docs, weights, max_repeat, id_col, text_col, source_col).groupBy("doc_id", "source_key", "size").agg(
        F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows")))
    source = F.col(f"`{source_col}`").cast("string")
    own = {c: f"_{c}_{uuid.uuid4().hex}" for c in ("key", "size", "id", "k", "sz", "copies", "rows", "each", "n")}   # names that no column of docs has
    keyed = docs.withColumns({own["key"]: F.when(source.isNull(), F.lit("z")).otherwise(F.concat(F.lit("a"), source)),
                              own["size"]: n_words(F.col(f"`{text_col}`"))})
    given = numbered.where("_copies > 0").select(*[F.col(c).alias(own[k]) for c, k in (
        ("doc_id", "id"), ("source_key", "k"), ("size", "sz"), ("_copies", "copies"), ("_rows", "rows"))])
    found = keyed.join(given, F.col(f"`{id_col}`").eqNullSafe(F.col(own["id"])) & (F.col(own["key"]) == F.col(own["k"]))
                       & (F.col(own["size"]) == F.col(own["sz"])))
    each = F.col(own["copies"])
    if not numbered.where("_rows > 1").isEmpty():
        # Rows that share an id take the same whole part; the first of them take the rest.
        at = F.row_number().over(Window.partitionBy(own["id"], own["k"], own["sz"]).orderBy(F.xxhash64(F.col(f"`{text_col}`"))))
        each = F.expr(f"{own['copies']} div {own['rows']}") + F.when(at <= F.expr(f"{own['copies']} % {own['rows']}"), 1).otherwise(0)
    return (found.withColumn(own["each"], each).where(F.col(own["each"]) > 0)
            .withColumn(own["n"], F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(own["each"]))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
