"""Smallest-window expressions (P20, P21, P23) as array higher-order functions.

No UDF: the lock-step window is a ``transform`` over rounds, each round
taking element ``min(r, len-1)`` of every (sorted, de-duplicated) position
list; the window of a round is ``max - min + 1`` and the result the minimum
over rounds (NULL stands for "no window", the reference's infinity).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordo.functions.text import grouped_values, jsplit, let

# Fixed values of the boost curve.
BOOST_FACTOR = 2.0
CUT_OFF = 9.0


def lockstep_window(lists: Column) -> Column:
    """P20: lock-step smallest window over an array of position arrays."""
    def smallest(norm: Column) -> Column:
        longest = F.array_max(F.transform(norm, lambda l: F.size(l)))
        return F.array_min(F.transform(F.sequence(F.lit(0), longest - 1), lambda r: let(
            F.transform(norm, lambda l: F.get(l, F.least(r, F.size(l) - 1))),
            lambda at: F.array_max(at) - F.array_min(at) + 1)))
    norm = F.transform(lists, lambda l: F.sort_array(F.array_distinct(l)))
    return let(norm, lambda n: F.when(F.size(n) > 0, smallest(n)))


def exact_window(lists: Column) -> Column:
    """P20 with ``mode='exact'``: the smallest span that holds a position of every list.

    All positions in order; each is the end of a span that starts at the least of the
    lists' last positions so far."""
    def swept(norm: Column) -> Column:
        marks = F.sort_array(F.flatten(F.transform(norm, lambda l, k: F.transform(
            l, lambda p: F.struct(p.alias("p"), k.alias("k"))))))
        start = F.struct(F.transform(norm, lambda l: F.lit(None).cast("int")).alias("last"), F.lit(None).cast("int").alias("best"))

        def step(acc: Column, m: Column) -> Column:
            return let(F.transform(acc["last"], lambda x, k: F.when(k == m["k"], m["p"]).otherwise(x)), lambda last: F.struct(
                last.alias("last"), F.when(F.exists(last, lambda x: x.isNull()), acc["best"]).otherwise(
                    F.least(acc["best"], m["p"] - F.array_min(last) + 1)).alias("best")))
        return F.aggregate(marks, start, step, lambda acc: acc["best"])
    norm = F.transform(lists, lambda l: F.array_distinct(l).cast("array<int>"))
    return let(norm, lambda n: F.when((F.size(n) > 0) & ~F.exists(n, lambda l: F.size(l) == 0), swept(n)))


def text_window(text: Column, words: Column, mode: str = "lockstep") -> Column:
    """Window over *all* distinct ``\\W+`` tokens of ``text``, only when
    every query word is a (case-sensitive) substring of it; else NULL."""
    window = {"lockstep": lockstep_window, "exact": exact_window}[mode]

    def over(tw: Column) -> Column:
        pairs = F.transform(tw["t"], lambda t, i: F.struct(t.alias("key"), i.alias("value")))
        return F.when(F.size(tw["t"]) > 0, window(F.map_values(grouped_values(pairs))))
    ok = F.forall(words, lambda w: F.instr(text, w) > 0)
    return F.when(text.isNotNull() & ok, let(F.struct(jsplit(text, r"\W+").alias("t")), over))


def boost(window: Column, distinct_words: Column) -> Column:
    """Window boost; ``distinct_words`` = number of distinct query words."""
    x = (window - distinct_words).cast("double")
    curve = F.sqrt(F.abs(F.lit(10.0) + (F.lit(1.0) - x * x / CUT_OFF) * BOOST_FACTOR))
    return (F.when(distinct_words == 1, F.lit(1.0))
            .when(window.isNull(), F.lit(1.0))
            .when(window == distinct_words, BOOST_FACTOR * window)
            .when(x > CUT_OFF, F.lit(1.0))
            .otherwise(curve))
