"""Column expressions against hand-computed values (windows, boost, splits, NDCG)."""

import math

import pytest
from pyspark.sql import functions as F


def test_lockstep_window(spark):
    from ordo.functions.window import lockstep_window
    df = spark.createDataFrame([([[1, 10], [9, 50]],), ([[1, 10, 20], [4, 12], [30]],)], "l array<array<int>>")
    assert [r[0] for r in df.select(lockstep_window(F.col("l"))).collect()] == [9, 19]


def test_boost_curve(spark):
    from ordo.functions.window import boost
    xs = [-1, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    df = spark.createDataFrame([(x + 3, 3) for x in xs], "w int, k int")
    got = [r[0] for r in df.select(boost(F.col("w"), F.col("k"))).collect()]
    exp = [3.431877, 3.431877, 3.333333, 3.162278, 2.905933, 2.538591, 2.0, 1.054093, 1.490712, 2.449490, 1.0]
    assert got == pytest.approx(exp, abs=1e-6)


def test_jsplit_semantics(spark):
    from ordo.functions.text import jsplit
    df = spark.createDataFrame([("a  b ",), ("",), ("   ",), (" a",)], "s string")
    got = [r[0] for r in df.select(jsplit(F.col("s"), " ")).collect()]
    assert got == [["a", "", "b"], [""], [], ["", "a"]]


@pytest.mark.parametrize("rels,exp", [([3, 2, 3, 0, 1, 2], 0.948810748568), ([0, 0, 0], 1.0),
                                      ([0, 1], 0.630929753571), ([2.5, 1.5, 0.5], 1.0),
                                      ([0, 3, 1.5], 0.653786781802)])
@pytest.mark.parametrize("strategy", ["window", "range"])
def test_ndcg_goldens(spark, rels, exp, strategy):
    from ordo.operators.metrics import ndcg_per_query
    df = spark.createDataFrame([(1, i, float(r)) for i, r in enumerate(rels)], "query_id long, pos0 long, rel double")
    got = ndcg_per_query(df, ["query_id"], [F.col("pos0")], strategy=strategy).first()["ndcg"]
    assert got == pytest.approx(exp, abs=1e-9)
