"""Relevance / ranked-list / report readers and writers."""

import os
import tempfile

from pyspark.sql import functions as F


def _write(text):
    d = tempfile.mkdtemp(prefix="ordo-test-")
    p = os.path.join(d, "f.txt")
    with open(p, "w") as f:
        f.write(text)
    return p


def test_rels_last_wins_and_clip(spark):
    from ordo.sources.textio import read_rels
    p = _write("query: a b\n  url: http://x 1.5\n  url: http://y -1\n  url: http://x 2.5\n"
               "query: c\n  url: http://z 3\n")
    train = {(r["query"], r["url"]): r["rel"] for r in read_rels(spark, p).collect()}
    assert train == {("a b", "http://x"): 2.5, ("a b", "http://y"): -1.0, ("c", "http://z"): 3.0}
    ev = {(r["query"], r["url"]): r["rel"] for r in read_rels(spark, p, evaluation=True).collect()}
    assert ev[("a b", "http://y")] == 0.0


def test_ranked_round_trip(spark, signal):
    from ordo.sources.textio import read_ranked, write_ranked
    ranked = signal.select("query_id", "query", "url", "title",
                           F.concat(F.lit("Pagerank: "), F.col("page_rank").cast("string")).alias("debug"),
                           (F.col("doc_pos") + 1).cast("long").alias("rank"))
    out = tempfile.mkdtemp(prefix="ordo-ranked-") + "/r"
    write_ranked(ranked, out)
    back = read_ranked(spark, out).orderBy("query", "rank").collect()
    assert [(r["query"], r["rank"], r["url"]) for r in back] == [
        ("campus bike map", 1, "http://bike.example.edu/map"),
        ("campus bike map", 2, "http://www.example.edu/~joe/parking.pdf"),
        ("to go to city", 1, "https://city.example.edu/go")]
    assert back[0]["debug"] == "Pagerank: 3"


def test_report_reader_flags_malformed(spark):
    from ordo.sources.textio import read_report
    p = _write("query: q1\nndcg: 0.5\n  url: http://a\n    rating: 1.0\n    title: t\n    debug: d\n"
               "query: q2\nndcg: 1.0\n  url: http://b\n    title: missing rating\n")
    rows = {r["query"]: r for r in read_report(spark, p).collect()}
    assert rows["q1"]["url"] == "http://a" and rows["q1"]["rating"] == 1.0 and not rows["q1"]["_corrupt"]
    assert rows["q2"]["_corrupt"]


def test_counters(signal):
    from ordo.sources.textio import load_counters
    r = load_counters(signal).first()
    assert (r["n_queries"], r["n_documents"]) == (2, 3)


def test_ranked_list_spanning_part_files(spark):
    """A hot query written by several tasks (several part files) reads back whole and in order."""
    from ordo.sources.textio import read_ranked, write_ranked
    rows = [(1000, "hot query", r, f"http://h/{r}", f"t{r}", "Pagerank: 1") for r in range(1, 3001)]
    rows += [(q, f"q{q}", r, f"http://x/{q}/{r}", "t", "Pagerank: 0") for q in range(1, 40) for r in range(1, 4)]
    df = spark.createDataFrame(rows, "query_id long, query string, rank long, url string, title string, debug string")
    out = tempfile.mkdtemp(prefix="ordo-parts-") + "/r"
    write_ranked(df, out, num_files=4)
    parts = [f for f in os.listdir(out) if f.startswith("part-") and os.path.getsize(os.path.join(out, f)) > 0]
    assert len(parts) > 1
    back = read_ranked(spark, out)
    hot = [(r["rank"], r["url"]) for r in back.filter(F.col("query") == "hot query").orderBy("rank").collect()]
    assert hot == [(r, f"http://h/{r}") for r in range(1, 3001)]
    assert back.count() == len(rows)
