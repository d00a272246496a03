"""Malformed lines of the text formats, set apart with file, line number and reason.

``checked_lines`` reads a file once and returns two tables: the good lines, which every reader
of ``textio`` takes as ``lines``, and the malformed ones. Each line is in exactly one of good,
malformed and blank (``line_counts``). Reasons:

* ``no key``       no colon in the line;
* ``unknown key``  a key that the format doesn't have;
* ``no query``     before the first ``query:`` line;
* ``no document``  a document's line before the query's first ``url:`` line;
* ``bad number``   a number that can't be read (a term's positions, a grade, a length, ...).

What a line belongs to is settled before anything is set apart, so a malformed line never moves
the lines around it to another document. Line numbers are ranks by file on the range plan: a file
of any size is numbered by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordo.operators.ranking import group_rank
from ordo.session import materialize
from ordo.sources.lines import read_ordered_lines
from ordo.sources.textio import ANCHOR_COUNT_KEY, SIGNAL_KEYS

REASONS = ("no key", "unknown key", "no query", "no document", "bad number")


def _number(kind: str) -> Callable[[Column], Column]:
    return lambda val: val.try_cast(kind).isNotNull()


def _positions(val: Column) -> Column:
    """``term p1 p2 ...`` with at least one position."""
    words = F.split(val, " ")
    return (F.size(words) > 1) & F.forall(F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
                                          lambda p: p.try_cast("int").isNotNull())


def _graded(val: Column) -> Column:
    """``url grade``."""
    return F.get(F.split(val, " "), 1).try_cast("double").isNotNull()


@dataclass(frozen=True)
class LineFormat:
    """``head``: keys that stand between a query and its documents; ``checks``: value tests by key."""
    document_keys: tuple[str, ...]
    head: tuple[str, ...] = ()
    checks: dict[str, Callable[[Column], Column]] = field(default_factory=dict)


FORMATS = {
    "signal": LineFormat(tuple(k for k in SIGNAL_KEYS if k not in ("query", "url")), checks={
        "body_hits": _positions, "body_length": _number("int"), "pagerank": _number("int"), ANCHOR_COUNT_KEY: _number("int")}),
    "judgements": LineFormat((), checks={"url": _graded}),
    "ranked": LineFormat(("title", "debug")),
    "report": LineFormat(("rating", "title", "debug"), head=("ndcg",), checks={
        "ndcg": _number("double"), "rating": _number("double")}),
}


def _reason(fmt: LineFormat) -> Column:
    """Why a line is malformed; NULL for a good one."""
    key = F.col("key")
    known = ("query", "url", *fmt.head, *fmt.document_keys)
    why = (F.when(key.isNull(), "no key").when(~key.isin(*known), "unknown key")
           .when((key != "query") & F.col("q_id").isNull(), "no query"))
    if fmt.document_keys:
        why = why.when(key.isin(*fmt.document_keys) & F.col("d_id").isNull(), "no document")
    for name, good in fmt.checks.items():
        why = why.when((key == name) & ~good(F.col("val")), "bad number")
    return why


def _judged_lines(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    lines = read_ordered_lines(spark, path, "url", all_lines=True)
    blank = F.trim("value") == ""
    lines = lines.withColumn("blank", blank).withColumn("reason", F.when(~blank, _reason(FORMATS[fmt])))
    numbered = group_rank(lines, ["file"], [F.col("gpos")], "line_no", strategy="range")
    return materialize(numbered)


def _good(judged: DataFrame) -> DataFrame:
    return judged.where(~F.col("blank") & F.col("reason").isNull()).select("gpos", "key", "val", "q_id", "query", "d_id")


def _bad(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNotNull()).select("file", "line_no", "reason", "value")


def checked_lines(spark: SparkSession, path: str, fmt: str) -> tuple[DataFrame, DataFrame]:
    """(good, malformed) lines of files in the format ``fmt``, a name in ``FORMATS``.

    good: what ``read_ordered_lines`` returns; malformed: file, line_no (from 1), reason, value.
    A file without lines gives two empty tables."""
    judged = _judged_lines(spark, path, fmt)
    return _good(judged), _bad(judged)


def line_counts(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """One row: lines, good, blank, malformed; the last three add up to the first."""
    judged = _judged_lines(spark, path, fmt)
    return judged.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("blank") & F.col("reason").isNull()).alias("good"),
                      F.count_if("blank").alias("blank"), F.count_if(F.col("reason").isNotNull()).alias("malformed"))
