"""Reports with unjudged results, window modes, text helpers, session settings, kernel sums."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F


def test_report_keeps_queries_whose_results_are_unjudged(spark, tmp_path):
    from ordo.operators.metrics import ndcg_per_query
    from ordo.sources.textio import judged_report, read_report, write_report
    ranked = spark.createDataFrame(
        [(1, "first unjudged", 1, "u1"), (1, "first unjudged", 2, "u2"), (1, "first unjudged", 3, "u3"),
         (2, "none judged", 1, "v1"), (2, "none judged", 2, "v2"),
         (3, "last unjudged", 1, "w1"), (3, "last unjudged", 2, "w2")], "query_id long, query string, rank long, url string"
    ).withColumn("title", F.col("url")).withColumn("debug", F.lit("Pagerank: 1"))
    rels = spark.createDataFrame([("first unjudged", "u2", 0.0), ("first unjudged", "u3", 3.0), ("last unjudged", "w1", 2.0)],
                                 "query string, url string, rel double")
    per = ndcg_per_query(ranked.join(rels, ["query", "url"]), ["query_id"], [F.col("rank")])
    path = str(tmp_path / "r")
    write_report(judged_report(ranked, rels, per), path)
    rows = read_report(spark, path).collect()
    got = {}
    for r in rows:
        assert not r["_corrupt"]
        got.setdefault(r["query"], []).append((r["url"], r["rating"], round(r["ndcg"], 6)))
    assert got["none judged"] == [(None, None, 0.0)]
    low = round(1 / math.log2(3), 6)
    assert sorted(got["first unjudged"]) == [("u2", 0.0, low), ("u3", 3.0, low)]
    assert got["last unjudged"] == [("w1", 2.0, 1.0)]


def test_ranked_list_whose_first_result_is_missing(spark, tmp_path):
    from ordo.sources.textio import read_ranked, write_ranked
    rows = spark.createDataFrame([(1, "a", 2, "u2"), (1, "a", 3, "u3"), (2, "b", 1, "v1")], "query_id long, query string, rank long, url string")
    write_ranked(rows.withColumn("title", F.lit("t")).withColumn("debug", F.lit("d")), str(tmp_path / "r"))
    assert sorted((r["query"], r["url"]) for r in read_ranked(spark, str(tmp_path / "r")).collect()) == [("a", "u2"), ("a", "u3"), ("b", "v1")]


def test_exact_window_equals_brute_force(spark):
    from ordo.functions.window import exact_window
    r = random.Random(3)
    cases = [[sorted(r.sample(range(60), r.randint(1, 5))) for _ in range(r.randint(1, 4))] for _ in range(40)]
    df = spark.createDataFrame([(k, c) for k, c in enumerate(cases)], "k int, lists array<array<int>>")
    got = {x["k"]: x["w"] for x in df.select("k", exact_window(F.col("lists")).alias("w")).collect()}
    assert got == {k: min(max(p) - min(p) + 1 for p in itertools.product(*c)) for k, c in enumerate(cases)}


def test_counts_and_positions(spark):
    from ordo.functions.text import count_map, positions_of
    toks = ["b", "a", "b", "c", "a", "b"]
    row = spark.createDataFrame([(toks, ["b", "x", "a"], [])], "t array<string>, w array<string>, e array<string>").select(
        count_map(F.col("t")).alias("c"), count_map(F.col("e")).alias("none"), positions_of(F.col("t"), F.col("w")).alias("p"),
        positions_of(F.col("t"), F.array(F.lit("zz"))).alias("q")).first()
    assert row["c"] == {"a": 2, "b": 3, "c": 1} and row["none"] == {} and row["q"] is None
    assert row["p"] == {"a": [1, 4], "b": [0, 2, 5]}


def test_settings_from_outside_survive(spark):
    from ordo.session import get_spark
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "77")
    try:
        again = get_spark()
        assert again.sparkContext.master == "local[4]" and again.conf.get("spark.sql.shuffle.partitions") == "77"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_decision_values_over_many_blocks(spark):
    from ordo.operators.models import SvmParams, decision_values
    r = random.Random(5)
    svs = [(r.choice([-1.0, 1.0]) * r.random(), [r.gauss(0, 1) for _ in range(3)]) for _ in range(2500)]
    rows = [(k, [r.gauss(0, 1) for _ in range(3)]) for k in range(4)]
    out = decision_values(spark.createDataFrame(rows, "k int, x array<double>"), "x",
                          spark.createDataFrame(svs, "coef double, vec array<double>"), 0.5, SvmParams().checked(3), ("linear", "rbf"))
    for got in out.collect():
        x = dict(rows)[got["k"]]
        dot = sum(c * sum(a * b for a, b in zip(x, v)) for c, v in svs) - 0.5
        rbf = sum(c * math.exp(-0.125 * sum((a - b) ** 2 for a, b in zip(x, v))) for c, v in svs) - 0.5
        assert got["dec_linear"] == pytest.approx(dot) and got["dec_rbf"] == pytest.approx(rbf)


def test_training_rows_need_judgements(spark):
    from ordo.plans.tasks import check_judged
    rows = spark.createDataFrame([(1, 1), (1, 2)], "query_id long, doc_pos long")
    check_judged(rows, rows.withColumn("rel", F.lit(1.0)))
    with pytest.raises(ValueError, match="doc_pos=2"):
        check_judged(rows, rows.where("doc_pos = 1").withColumn("rel", F.lit(1.0)))


@pytest.mark.parametrize("what", ["window", "anchors"])
def test_text_work_grows_with_the_text(spark, what):
    """Twice the tokens take about twice the time, not eight times."""
    import time
    from ordo.functions.text import count_map
    from ordo.functions.window import text_window

    def run(n):
        text = " ".join(f"t{k}" for k in range(n))
        df = spark.range(8).select(F.concat(F.lit(text), F.lit(" x"), F.col("id")).alias("t"))
        c = text_window(F.col("t"), F.array(F.lit("t1"))) if what == "window" else F.size(count_map(F.split("t", " ")))
        best = 1e9
        for _ in range(3):
            t0 = time.time()
            df.select(F.sum(F.coalesce(c, F.lit(0)))).collect()
            best = min(best, time.time() - t0)
        return best
    run(1000)
    assert run(16_000) < 4 * run(8_000) + 0.5


def test_tokens_are_not_split_inside_an_aggregate(spark, signal, idf):
    from ordo.operators.features import feature_vector
    plan = feature_vector(signal, idf)._jdf.queryExecution().optimizedPlan().toString()
    inside = [p for p in plan.split("aggregate(")[1:] if "split(" in p.split("lambdafunction")[1][:400]]
    assert not inside
