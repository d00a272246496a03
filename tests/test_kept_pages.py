"""Pages that are written once give what pages read from html give; query terms join the queries, not the candidates."""

from pyspark.sql import functions as F

from ordo.functions.text import jsplit
from ordo.operators.features import TOKEN_COLUMNS, attach_query_terms, query_term_arrays, raw_tf, with_tokens
from ordo.operators.scorers import average_lengths
from ordo.plans import catalog
from ordo.sources import views as V


def pages(spark, tmp_path):
    html = "<html><title>{}</title><h1>Head {}</h1><a href='x'>An  chor</a><p>{}</p></html>"
    rows = [(k, f"http://h/{k}", html.format(f"Red fox {k % 3}", k, f"the red {k % 3} fox and a fox " * (k % 4 + 1))) for k in range(14)]
    rows += [(3, "http://h/again", html.format("Red red again", 3, "again a red")), (None, "http://h/none", html.format("No id", 0, "no")),
             (5, None, html.format("No url red", 3, "red")), (20, "http://h/20", None), (21, "http://h/21", ""), (22, "http://h/22", html.format("far fox", 22, "")),
             (23, "http://h/23", "<title>odd ends</title> a .<b> c << d> e < f 5<6 Kelvin İx größe \n\t x<"), (24, "http://h/24", "<>--<title>-</title>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def rows(df):
    maps = [c for c, t in df.dtypes if t.startswith("map")]
    plain = df.select(*[F.sort_array(F.map_entries(c)).alias(c) if c in maps else c for c in sorted(df.columns)])
    return sorted(map(repr, plain.collect()))


def test_kept_pages_equal_the_pages(spark, tmp_path):
    sf = pages(spark, tmp_path)
    want = rows(V.page_docs(spark, sf))
    assert rows(V.kept_docs(spark, sf).drop("words")) == want and rows(V.worded_docs(spark, sf).drop("words")) == want
    assert rows(V.page_candidates(spark, sf, V.kept_docs(spark, sf))) == rows(V.page_candidates(spark, sf))


def test_candidates_carry_the_terms_of_their_query(spark, tmp_path):
    sf = pages(spark, tmp_path)
    idf, queries = catalog._page_idf(spark, sf), V.page_query_table(spark, sf)
    cands, rels = V.page_ranking(spark, sf, F.col("query_id") % 4 != 1)
    want = attach_query_terms(cands, idf, queries=queries)
    got, got_rels = V.page_ranking(spark, sf, F.col("query_id") % 4 != 1, V.kept_docs(spark, sf), query_term_arrays(queries, idf))
    by_word = lambda df: rows(df.withColumn("qterms", F.sort_array("qterms")))
    assert by_word(got) == by_word(want) and len(by_word(got)) > 80
    assert rows(got_rels) == rows(rels)
    assert attach_query_terms(got, idf) is got


def test_lengths_of_pages_count_their_candidates(spark, tmp_path):
    sf = pages(spark, tmp_path)
    docs = V.kept_docs(spark, sf)
    assert rows(average_lengths(V.page_meetings(docs))) == rows(average_lengths(V.page_candidates(spark, sf)))


def test_counts_of_words(spark):
    df = spark.createDataFrame([("http://red/red", "red a red", ["red", "b red"], {"red red": 3, "x": 2}), (None, None, None, None)],
                               "url string, title string, headers array<string>, anchors map<string,int>")
    got = with_tokens(df).select(*[raw_tf(f, F.lit("red"), F.lit(2)).alias(f) for f in ("url", "title", "header", "anchor")]).collect()
    assert [tuple(r) for r in got] == [(4.0, 4.0, 4.0, 12.0), (None, 0.0, 0.0, 0.0)]


def test_html_is_read_once(spark, tmp_path, monkeypatch):
    sf, reads, real = pages(spark, tmp_path), [], V._docs_of
    monkeypatch.setattr(V, "_docs_of", lambda *a: reads.append(1) or real(*a))
    assert catalog._v2_weighed(spark, sf)[0].count() > 0 and len(reads) == 1


def test_fields_are_split_once_a_page(spark, tmp_path):
    sf = pages(spark, tmp_path)
    got = catalog._v2_weighed(spark, sf)[0]
    assert rows(got) == rows(with_tokens(got.drop(*TOKEN_COLUMNS))) and with_tokens(got) is got


def test_anchor_counts_of_odd_rows(spark):
    old = lambda w, m: (F.aggregate(F.coalesce(F.map_entries("anchors"), F.array().cast("array<struct<key:string,value:int>>")),
                                    F.lit(0).cast("long"), lambda a, e: a + F.size(F.filter(jsplit(e["key"], " "), lambda t: t == w)) * e["value"]) * m)
    anchors = [{"a b a": 2, "a": 3, "": 4, " a  b ": 1}, {}, None, {"a": None, "b": 1}, {"B a": 1, "b": 1}]
    df = with_tokens(spark.createDataFrame([(None, None, None, a) for a in anchors], "url string, title string, headers array<string>, anchors map<string,int>"))
    for word in ("a", "b", "", "z"):
        got = [r[0] for r in df.select(raw_tf("anchor", F.lit(word), F.lit(2))).collect()]
        assert got == [r[0] for r in df.select(old(F.lit(word), F.lit(2)).cast("double")).collect()]
        assert got[1:4] == [0.0, 0.0, None]
