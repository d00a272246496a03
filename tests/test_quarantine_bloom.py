"""Malformed lines set apart, the Bloom filter, sparse nominal vectors, splits of long separator runs."""

import os
import random
import tempfile
import time

import pytest
from pyspark.sql import functions as F

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")

SIGNAL = """  url: http://early
query: a b
  title: lost
no colon here

  url: http://x
    title: t
    body_hits: a 1 2
    body_hits: b one
    colour: red
    body_length: many
    body_length: 7
    anchor_text: hello you
    stanford_anchor_count: 3
    anchor_text: again
    stanford_anchor_count: x
    stanford_anchor_count: 5
    anchor_text: hello you
    stanford_anchor_count: 9
"""


def _file(text):
    path = tempfile.mkdtemp(prefix="ordo-lines-") + "/f.txt"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_signal_lines_are_set_apart_and_the_rest_is_read(spark):
    from ordo.sources.quarantine import checked_lines, line_counts
    from ordo.sources.textio import read_signal
    path = _file(SIGNAL)
    good, bad = checked_lines(spark, path, "signal")
    got = [(r["line_no"], r["reason"]) for r in bad.orderBy("line_no").collect()]
    assert got == [(1, "no query"), (3, "no document"), (4, "no key"), (9, "bad number"), (10, "unknown key"),
                   (11, "bad number"), (16, "bad number")]
    row = read_signal(spark, path, lines=good).collect()
    assert len(row) == 1 and row[0]["url"] == "http://x" and row[0]["body_hits"] == {"a": [1, 2]}
    assert row[0]["body_length"] == 7 and row[0]["anchors"] == {"hello you": 9, "again": 5}
    n = line_counts(spark, path, "signal").first()
    assert (n["lines"], n["good"], n["blank"], n["malformed"]) == (19, 11, 1, 7)


@pytest.mark.parametrize("fmt,text,reasons", [
    ("judgements", "query: q\n  url: http://a 1.5\n  url: http://b\n  url: http://c x\n  title: t\n",
     ["bad number", "bad number", "unknown key"]),
    ("ranked", "query: q\n  debug: d\n  url: http://a\n    title: t\n    debug: d\n", ["no document"]),
    ("report", "ndcg: 1\nquery: q\nndcg: high\n  url: http://a\n    rating: 1.0\n    rating: -\n", ["no query", "bad number", "bad number"]),
    ("signal", "\n", [])])
def test_other_formats(spark, fmt, text, reasons):
    from ordo.sources.quarantine import checked_lines
    _, bad = checked_lines(spark, _file(text), fmt)
    assert [r["reason"] for r in bad.orderBy("line_no").collect()] == reasons


def test_a_clean_file_reads_alike_with_and_without_checks(spark, signal):
    from ordo.sources.quarantine import checked_lines
    from ordo.sources.textio import read_signal
    path = os.path.join(FIXTURES, "signal.txt")
    good, bad = checked_lines(spark, path, "signal")
    assert bad.count() == 0
    cols = ["query", "doc_pos", "url", "title", "headers", "body_length", "page_rank"]
    assert sorted(map(str, read_signal(spark, path, lines=good).select(cols).collect())) == sorted(map(str, signal.select(cols).collect()))


def test_an_anchor_with_very_many_counts(spark):
    from ordo.sources.textio import read_signal
    lines = "".join(f"anchor_text: a{i}\nstanford_anchor_count: {i}\n" for i in range(20000))
    row = read_signal(spark, _file("query: q\nurl: http://x\n" + lines)).first()
    assert row["anchors"] == {f"a{i}": i for i in range(20000)}


@pytest.mark.parametrize("pattern,sep", [(" ", " "), (r"\W+", "."), (r"\s+", " ")])
def test_long_runs_of_separators_split_in_linear_time(spark, pattern, sep):
    from ordo.functions.text import jsplit
    df = spark.createDataFrame([("a" + sep * 200_000,), ("a" + sep * 200_000 + "b",), (sep * 200_000,), ("a \n",), (None,)], "s string")
    start = time.time()
    got = [r[0] for r in df.select(jsplit("s", pattern)).collect()]
    assert time.time() - start < 30
    assert got[0] == ["a"] and got[1] == (["a"] + [""] * 199_999 + ["b"] if pattern == " " else ["a", "b"])
    assert got[2] == [] and got[3] == (["a", "\n"] if pattern == " " else ["a"]) and got[4] is None


def test_bloom_filter_holds_what_it_was_given(spark):
    from ordo.operators import bloom
    rng = random.Random(3)
    mine = [rng.getrandbits(64) - (1 << 63) for _ in range(3000)]
    other = [rng.getrandbits(64) - (1 << 63) for _ in range(20000)]
    bits = bloom.bits_for(len(mine))
    assert bits & (bits - 1) == 0 and bloom.bits_for(0) == bloom.MIN_BITS and bloom.bits_for(1 << 40) == bloom.MAX_BITS
    table = lambda xs: spark.createDataFrame([(x,) for x in xs], "h bigint")
    a, b = bloom.build(table(mine[:1000] + mine[:5]), "h", bits), bloom.build(table(mine[1000:]), "h", bits)
    both = bloom.merge(a, b)
    assert both.first()["filter"] == bloom.build(table(mine), "h", bits).first()["filter"]
    passed = lambda f, xs: table(xs).where(bloom.might_hold(f, F.col("h"), bits)).count()
    assert passed(both, mine) == len(mine)
    assert passed(both, other) < len(other) * 0.01
    empty = bloom.build(table([]), "h", bits)
    assert passed(empty, mine) == 0
    with pytest.raises(ValueError):
        bloom.build(a, "filter", 100)


def test_nominal_vectors_of_many_values(spark):
    from ordo.operators.scale import nominal_dictionary, nominal_vectors
    few = spark.createDataFrame([(1, "b", 7), (2, "a", 7), (3, None, 7), (4, "b", 7)], "id int, c string, idx int")
    rows = {r["id"]: (r["v"].size, list(r["v"].indices), r["idx"]) for r in nominal_vectors(few, "c", "v").collect()}
    assert rows == {1: (2, [1], 7), 2: (2, [0], 7), 3: (2, [], 7), 4: (2, [1], 7)}
    unseen = spark.createDataFrame([(1, "z"), (2, "a")], "id int, c string")
    held = nominal_vectors(unseen, "c", "v", nominal_dictionary(few, "c")).orderBy("id").collect()
    assert [list(r["v"].indices) for r in held] == [[], [0]]
    many = spark.range(100_000).select("id", F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    wide = nominal_vectors(many, "c", "v")
    plans = [len(x._jdf.queryExecution().optimizedPlan().toString()) for x in (nominal_vectors(few, "c", "v"), wide)]
    assert plans[1] < 2 * plans[0]
    assert wide.where((F.col("id") == 99_999)).first()["v"].indices.tolist() == [99_999]
