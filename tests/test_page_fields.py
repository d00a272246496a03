"""Pages' fields are read from bytes, words are counted in Arrow and features sum the words that a field holds."""

import math

import pyarrow as pa
from pyspark.sql import functions as F

from ordo.operators.features import FEATURE_NAMES, FIELDS, bound_tokens, five_features, query_terms, raw_tf, with_tokens
from ordo.plans import catalog
from ordo.sources import idf as I
from ordo.sources import views as V

ODD = ["<title>A</title><h1>x</h1><a b>t</a>", "<TITLE>Ünï\ncode</Title><H1></h1><h1>two</H1><A\tx>no</a><A x\n>Yes\n</A><a >Yes\n</a>", "<title>open", "<title>a<title>b</title>c</title>",
       "<h1>a<h1>b</h1><h1>", "<a <b>c</a><a d", "<a x>n<a y>m</a></a><a z></a>", "</title><title></title>", "", None, "<a><b a >x</a><a >Kİ</a><a >Z</a><a >\U0001f600</a><a >～</a>", "<article> <a é>ß</a>"]


def page_rows(spark, html):
    return spark.createDataFrame([(k, f"u{k}", h) for k, h in enumerate(html)], "page_id long, url string, html string")


def test_fields_of_odd_html(spark):
    pages = page_rows(spark, ODD)
    rows = lambda df: [r.asDict() for r in df.orderBy("page_id").collect()]
    got = rows(V._docs_of(pages, F.lit(1).alias("n"), V._page_fields()(F.col("html"))))
    want = rows(V._docs_of(pages, F.lit(1).alias("n")))
    assert got == want and [list(r["anchors"]) for r in got] == [list(r["anchors"]) for r in want]
    assert got[1]["anchors"] == {"Yes\n": 2} and got[1]["headers"] == ["", "two"] and got[9]["title"] is None


def test_fields_are_read_without_regular_expressions_in_the_plan(spark, tmp_path):
    page_rows(spark, ODD).write.parquet(f"{tmp_path}/pages.parquet")
    plan = V.worded_docs(spark, str(tmp_path)).drop("body")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan


def test_words_counted_in_arrow_equal_those_of_arrays(spark, monkeypatch):
    docs = spark.createDataFrame([("a b a",), ("b",), ("",), (None,), ("c a",), ("a" * 50 + " b",)], "words string")
    want = I.build_idf(V._split_words(docs), "body", 6)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(I.build_idf_of_words(docs, "words", 6)) == rows(want) and len(rows(want)) == 4
    assert I.build_idf_of_words(docs, "words", 6).dtypes == want.dtypes
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "a b a", None, "", "b a", "b"])], ["words"])
    monkeypatch.setattr(I, "COUNT_BYTES", 8)
    parts = [b.to_pylist() for b in I._count_rows(iter([batch.slice(1), batch.slice(0, 0), batch.slice(2, 1)]))]
    assert len(parts) > 2
    total = {}
    for r in sum(parts, []):
        total[r["term"]] = total.get(r["term"], 0) + r["n"]
    assert total == {"a": 2, "b": 3}


def test_kept_pages_count_words_in_arrow(spark, tmp_path):
    page_rows(spark, [h for h in ODD if h]).write.parquet(f"{tmp_path}/pages.parquet")
    sf = str(tmp_path)
    rows = lambda df: sorted(map(tuple, df.collect()))
    idf = catalog._page_idf(spark, sf, V.kept_docs(spark, sf))
    assert rows(idf) == rows(catalog._page_idf(spark, sf))
    assert "MapInArrow" in idf._jdf.queryExecution().optimizedPlan().toString()


def test_features_equal_the_sum_over_all_words(spark):
    norm = F.col("body_length").cast("double") + 2500.0
    add = lambda f, tok: lambda acc, e: acc + e["m"] * raw_tf(f, e["word"], e["m"], tok) / F.pow(norm, e["m"]) * e["qv"]
    every = bound_tokens(lambda tok: F.struct(*[F.aggregate("qterms", F.lit(0.0), add(f, tok)).alias(f"{f}_w") for f in FIELDS]))
    one = lambda w, m=1, qv=2.0: (w, m, 1.0, qv)
    page = ("http://red/fox", "red a red", ["fox", "b red"], {"red red": 3, "x": 2}, {"red": [1, 4], "fox": [2]}, 7)
    cases = [([one("red"), one("fox", 2), one("none", 3)], page), ([one("none")], page), ([], page), ([one("b"), one("x", 2, -1.5)], page),
             ([one("red"), one("none", 1, math.inf)], page), ([one("none", 1, math.nan)], page), ([one("none", 1, -math.inf)], page), ([one("red", 3), one("fox", 3)], page),
             ([one("none")], (None,) * 6), ([one("red")], (None,) * 6), ([one("none")], (None, None, None, None, None, 3)), ([one("red")], (*page[:5], None)),
             ([one("none")], ("u", "t", [], {"x": None}, {}, 0)), ([one("u")], ("u", "", ["u"], {}, {}, 0)), ([one("none")], (*page[:5], -2501)), ([one("red")], (*page[:5], -2501))]
    df = with_tokens(spark.createDataFrame([(k, q, *p) for k, (q, p) in enumerate(cases)], "k int, qterms array<struct<word:string,m:int,idf:double,qv:double>>, url string, "
                                           "title string, headers array<string>, anchors map<string,int>, body_hits map<string,array<int>>, body_length int"))
    rows = {str([r["k"], *r["f"]]) for r in df.select("k", five_features().alias("f")).collect()}
    assert rows == {str([r["k"], *r["f"]]) for r in df.select("k", every.alias("f")).collect()} and len(rows) == len(cases)
    plan = df.select(five_features().alias("f")).select(*[f"f.{n}" for n in FEATURE_NAMES])._jdf.queryExecution().optimizedPlan().toString()
    assert "arrays_overlap" in plan


def test_terms_of_odd_queries(spark):
    df = spark.createDataFrame([(1, "b a B a"), (2, ""), (3, None), (4, " a  a "), (None, "x x x")], "query_id long, query string")
    got = sorted(map(tuple, query_terms(df).fillna(0).collect()))
    assert got == [(0, "x", 3), (1, "a", 2), (1, "b", 2), (2, "", 1), (4, "", 2), (4, "a", 2)]
