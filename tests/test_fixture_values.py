"""Golden values worked out from the formulas for the hand-made signal file."""

import math

import pytest
from pyspark.sql import functions as F

from ordo.operators import features as FE
from ordo.operators import scorers as SC


def _by_doc(df, col):
    return {(r["query_id"], r["doc_pos"]): r[col] for r in df.collect()}


def test_signal_reader(signal):
    rows = signal.orderBy("query_id", "doc_pos").collect()
    assert len(rows) == 3
    d1 = rows[0]
    assert d1["url"] == "http://bike.example.edu/map"
    assert d1["headers"] == ["bike routes", "campus map and bike map"]
    assert d1["body_hits"]["bike"] == [12, 41, 90]
    assert d1["anchors"] == {"bike map": 4, "campus bike map": 2}
    assert rows[1]["headers"] is None and rows[1]["anchors"] is None
    assert rows[2]["query"] == "to go to city"


def test_url_tokens(spark, signal):
    from ordo.functions.text import url_tokens
    got = [r[0] for r in signal.orderBy("query_id", "doc_pos").select(url_tokens("url")).collect()]
    assert got == [["bike", "example", "edu", "map"],
                   ["www", "example", "edu", "joe", "parking", "pdf"],
                   ["https", "city", "example", "edu", "go"]]


def test_feature_vector(signal, idf):
    fv = FE.feature_vector(signal, idf).orderBy("query_id", "doc_pos").collect()
    exp = [(0.002333333333, 0.003, -0.000675775180, 0.005333333333, 0.015333333333),
           (0.0, 0.0, -0.000374674152, 0.0, 0.0),
           (0.005039866251, 0.005040374978, -0.000402775586, 0.0, 0.0)]
    for r, e in zip(fv, exp):
        assert [r[n] for n in FE.FEATURE_NAMES] == pytest.approx(e, abs=1e-11)


def test_scorers(signal, idf):
    p = SC.with_bm25_lengths(SC.prepare(signal, idf))
    w = SC.doc_window_col()
    rows = p.select("query_id", "doc_pos", SC.field_score_col().alias("fs"), SC.bm25_score_col().alias("bm"),
                    w.alias("win"), SC.boost_col(w).alias("boost")).orderBy("query_id", "doc_pos").collect()
    assert [r["fs"] for r in rows] == pytest.approx([0.008389685360, -0.000038005176, 0.001222351530], abs=1e-11)
    assert [r["bm"] for r in rows] == pytest.approx([26.411942751, 17.556480267, 19.995974185], abs=1e-8)
    assert [r["win"] for r in rows] == [3, None, 4]
    assert [r["boost"] for r in rows] == pytest.approx([6.0, 1.0, 3.431876713662], abs=1e-11)


def test_average_lengths(signal):
    a = SC.average_lengths(signal).first()
    assert (a["avg_body"], a["avg_header"], a["avg_anchor"], a["avg_title"], a["avg_url"]) == pytest.approx(
        (593.333333, 3.5, 2.5, 3.0, 5.666667), abs=1e-6)


def test_pdf_tilde(signal):
    from ordo.functions.text import has_tilde, is_pdf
    got = [(r[0], r[1]) for r in signal.orderBy("query_id", "doc_pos").select(is_pdf("url"), has_tilde("url")).collect()]
    assert got == [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)]


def test_null_cosine_case(spark):
    """One hit among three hit terms -> 1 + ln(1/3) < 0 -> NULL field score."""
    from ordo.sources.idf import load_idf  # noqa: F401
    df = spark.createDataFrame(
        [(0, "a b c", 0, "http://x/", "t", None, {"a": [1], "b": [2, 3, 4], "c": [5, 6, 7]}, 10, 0, None)],
        "query_id long, query string, doc_pos int, url string, title string, headers array<string>, "
        "body_hits map<string,array<int>>, body_length int, page_rank int, anchors map<string,int>")
    idf = spark.createDataFrame([("a", 1.0)], "term string, idf double")
    got = SC.prepare(df, idf).select(SC.field_score_col().alias("fs")).first()["fs"]
    assert got is None
