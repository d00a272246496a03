"""Page candidates: each page's body is indexed once for all queries that meet it."""

from pyspark.sql import functions as F

from ordo.functions.text import positions_of
from ordo.sources import views as V


def pages(spark, tmp_path):
    html = "<html><title>{}</title><h1>Head {}</h1><a href='x'>An chor</a><p>{}</p></html>"
    rows = [(k, f"http://h/{k}", html.format(f"Red fox {k % 3}", k, f"the red {k % 3} fox and a fox " * (k % 4 + 1))) for k in range(14)]
    rows += [(3, "http://h/again", html.format("Red red again", 3, "again a red")), (None, "http://h/none", html.format("No id", 0, "no")),
             (20, "http://h/20", None), (22, "http://h/22", html.format("far fox", 22, ""))]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_hits_equal_those_of_each_candidate(spark, tmp_path):
    sf = pages(spark, tmp_path)
    cands, _ = V.page_ranking(spark, sf)
    docs = V.page_docs(spark, sf)
    plain = V._windows(docs).join(docs, F.col("doc_pos") == F.col("page_id")).select(
        "query_id", "query", "doc_pos", "url", F.size("body").alias("body_length"),
        F.coalesce(positions_of(F.col("body"), F.split("query", " ")), F.create_map().cast("map<string,array<int>>")).alias("body_hits"))
    rows = lambda df: sorted(map(repr, df.select("query_id", "query", "doc_pos", "url", "body_length", F.map_entries("body_hits").alias("h")).collect()))
    assert rows(cands) == rows(plain) and len(rows(plain)) > 100
    without = sorted(c for c in cands.columns if c != "body_hits")
    same = lambda df: sorted(map(repr, df.select(*[c for c in without if c != "anchors"], F.map_entries("anchors")).collect()))
    assert same(V.page_candidates(spark, sf)) == same(cands)


def test_where_chooses_queries(spark, tmp_path):
    sf = pages(spark, tmp_path)
    some, rels = V.page_ranking(spark, sf, F.col("query_id") % 4 == 0)
    whole, all_rels = V.page_ranking(spark, sf)
    rows = lambda df: sorted(map(repr, df.select("query_id", "doc_pos", "url").collect()))
    assert rows(some) == rows(whole.where("query_id % 4 = 0")) and rows(rels) == rows(all_rels.where("query_id % 4 = 0"))


def test_experiments_read_the_candidates_once(spark, tmp_path, monkeypatch):
    from ordo.plans import catalog
    sf, calls = pages(spark, tmp_path), []
    real = V._index_hits
    monkeypatch.setattr(V, "_index_hits", lambda: calls.append(1) or real())
    la, lb, _, _ = catalog._experiments(spark, sf)
    assert len(calls) == 1 and la.count() == lb.count() > 0


def test_words_of_odd_html(spark):
    from ordo.functions.text import alnum_tokens
    odd = ["<b>Red</b>fox <i", "a<b\n>c >d <<e>f<g <", "5<6 Kelvin İx xİ größe ſ ı ﬀ", "\x00 \t\x0b\x1c   AZaz09_`@[{/:", "", "<>", None, "é \U0001f600x<中>y", "<" * 50]
    df = spark.createDataFrame([(h,) for h in odd], "html string")
    got = df.select(V._body_words()(F.col("html")).alias("w"), F.concat_ws(" ", alnum_tokens(F.regexp_replace("html", "<[^>]*>", " "))).alias("want"), "html").collect()
    assert [r["w"] for r in got] == [None if r["html"] is None else r["want"] for r in got]


def test_hits_of_parts_of_a_batch():
    import pyarrow as pa
    asks = pa.array([[{"query_id": 7, "query": "a b a"}], [{"query_id": 8, "query": "c"}, {"query_id": None, "query": "b a z"}], [], [{"query_id": 9, "query": "a"}]],
                    pa.list_(pa.struct([("query_id", pa.int64()), ("query", pa.string())])))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["x a", "a b  a c", "b", None]), asks], ["doc_pos", "words", "asked"])
    (out,) = V._index_hits()(iter([batch.slice(1)]))
    assert out.schema.names == ["doc_pos", "body_length", "asked"] and out.column("body_length").to_pylist() == [4, 1, None]
    assert out.column("asked").to_pylist() == [
        [{"query_id": 8, "query": "c", "body_hits": [("c", [3])]}, {"query_id": None, "query": "b a z", "body_hits": [("a", [0, 2]), ("b", [1])]}],
        [], [{"query_id": 9, "query": "a", "body_hits": []}]]


def test_the_candidate_step_is_not_merged_into_few_tasks(spark, tmp_path):
    cands, _ = V.page_ranking(spark, pages(spark, tmp_path))
    assert cands.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_bodies_are_read_without_regular_expressions_in_the_plan(spark, tmp_path):
    plan = V.worded_docs(spark, pages(spark, tmp_path)).select("words")._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "regexp_replace" not in plan
