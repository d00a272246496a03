"""Command-line entry points for the three things the reference's users run.

  python -m ordo.cli rank     --signal S --rel R --idf I --test T --out O [--task 1|2|3]
      train on (S, R), rank the test signal file T, write the ranked list O
      and print the training-set mean NDCG;
  python -m ordo.cli ndcg     --ranked O --rel R [--report P]
      mean NDCG of a ranked list against judgements (negative grades -> 0),
      optionally writing the experiment report;
  python -m ordo.cli compare  --a P1 --b P2 [--out D]
      mean NDCG difference of two reports (raises when their query or url sets
      differ); ``--out`` gets the whole per-query table, worst difference first.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _judged(cands: DataFrame, rels: DataFrame) -> DataFrame:
    """Judgements keyed like the candidates (query text and url -> query_id, doc_pos)."""
    return cands.select("query_id", "doc_pos", "query", "url").join(rels, ["query", "url"])


def rank_files(spark: SparkSession, signal: str, rel: str, idf_path: str, test: str, out: str,
               task: int = 3, idf_format: str = "parquet") -> dict:
    from ordo.plans import tasks
    from ordo.sources.idf import load_idf
    from ordo.sources.textio import read_rels, read_signal, write_ranked
    train = read_signal(spark, signal)
    train_rels = _judged(train, read_rels(spark, rel))
    idf = load_idf(spark, idf_path, idf_format)
    tasks.check_judged(train, train_rels)
    fitted = tasks.fit(task, train, train_rels, idf)
    fit = tasks.apply(fitted, train, train_rels, idf)              # training NDCG, as the reference prints
    test_c = read_signal(spark, test)
    res = tasks.apply(fitted, test_c, None, idf)                   # test lists: no judgements
    ranked = res.ranked.join(test_c.select("query_id", "doc_pos", "query", "url", "title", "page_rank"),
                             ["query_id", "doc_pos"]).withColumn(
        "debug", F.concat(F.lit("Pagerank: "), F.col("page_rank").cast("string")))
    write_ranked(ranked, out)
    m = fit.mean.first()
    return {"task": task, "train_mean_ndcg": m["mean_ndcg"], "train_queries": m["n_queries"], "weights": fit.weights}


def evaluate_files(spark: SparkSession, ranked_path: str, rel: str, report: str | None = None) -> dict:
    from ordo.operators.metrics import mean_ndcg, ndcg_per_query
    from ordo.sources.textio import judged_report, read_ranked, read_rels, write_report
    ranked = read_ranked(spark, ranked_path)
    rels = read_rels(spark, rel, evaluation=True)
    judged = ranked.join(rels, ["query", "url"])                  # unjudged lines are skipped (F2)
    per = ndcg_per_query(judged, ["query_id"], [F.col("rank")])
    m = mean_ndcg(per, ranked_queries=ranked).first()
    if report:
        write_report(judged_report(ranked, rels, per), report)
    return {"n_queries": m["n_queries"], "mean_ndcg": m["mean_ndcg"]}


def compare_files(spark: SparkSession, a: str, b: str, out: str | None = None) -> dict:
    from ordo.operators.compare import check_comparable, compare_by_query, compare_mean, order_by_diff
    from ordo.sources.textio import read_report
    ra, rb = read_report(spark, a), read_report(spark, b)
    la = ra.where("url is not null").select(F.col("query").alias("query_id"), "url")
    lb = rb.where("url is not null").select(F.col("query").alias("query_id"), "url")
    check_comparable(la, lb)
    na = ra.select(F.col("query").alias("query_id"), "ndcg").distinct()
    nb = rb.select(F.col("query").alias("query_id"), "ndcg").distinct()
    m = compare_mean(na, nb).first()
    by_query = order_by_diff(compare_by_query(na, nb))
    if out:
        by_query.write.mode("overwrite").parquet(out)
    worst = [r.asDict() for r in by_query.limit(10).collect()]     # a look at the table; --out has all of it
    return {"mean_a": m["mean_a"], "mean_b": m["mean_b"], "diff": m["diff"], "color": m["color"],
            "first_by_diff": worst}


def main(argv=None) -> None:
    from ordo.session import get_spark
    ap = argparse.ArgumentParser(prog="ordo")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("rank")
    for k in ("signal", "rel", "idf", "test", "out"):
        r.add_argument(f"--{k}", required=True)
    r.add_argument("--task", type=int, default=3)
    r.add_argument("--idf-format", default="parquet")
    n = sub.add_parser("ndcg")
    n.add_argument("--ranked", required=True)
    n.add_argument("--rel", required=True)
    n.add_argument("--report")
    c = sub.add_parser("compare")
    c.add_argument("--a", required=True)
    c.add_argument("--b", required=True)
    c.add_argument("--out")
    args = ap.parse_args(argv)
    spark = get_spark()
    if args.cmd == "rank":
        out = rank_files(spark, args.signal, args.rel, args.idf, args.test, args.out, args.task, args.idf_format)
    elif args.cmd == "ndcg":
        out = evaluate_files(spark, args.ranked, args.rel, args.report)
    else:
        out = compare_files(spark, args.a, args.b, args.out)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
