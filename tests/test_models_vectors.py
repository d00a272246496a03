"""Word-vector reader (S4/P27), hyper-parameter checks (M10), model I/O."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F


def _vec_file(text, gz=False):
    d = tempfile.mkdtemp(prefix="ordo-vec-")
    p = os.path.join(d, "v.txt.gz" if gz else "v.txt")
    if gz:
        with gzip.open(p, "wt") as f:
            f.write(text)
    else:
        with open(p, "w") as f:
            f.write(text)
    return p


VEC = "3 2\n<s> 1 2\n</s> 3 4\n<unk> 5 6\nbike 7 8 9\nmap 1 1\nmap 2 2\n"


@pytest.mark.parametrize("gz", [False, True])
def test_read_vectors(spark, gz):
    from ordo.sources.vectors import read_vectors
    v = {r["word"]: r["vec"] for r in read_vectors(spark, _vec_file(VEC, gz), has_header=True).collect()}
    assert v["*START*"] == [3.0, 4.0]          # </s> maps to the start word too; the later line wins
    assert v["*UNK*"] == [5.0, 6.0]
    assert v["bike"] == [7.0, 8.0]             # wider row truncated to the first width
    assert v["map"] == [2.0, 2.0]              # last duplicate wins
    assert len(v) == 4


def test_short_vector_raises(spark):
    from ordo.sources.vectors import read_vectors
    with pytest.raises(Exception):
        read_vectors(spark, _vec_file("a 1 2\nb 3\n")).collect()


def test_lookup_falls_back_to_unknown(spark):
    from ordo.operators.vectors import lookup, vocabulary_stats
    from ordo.sources.vectors import read_vectors
    vecs = read_vectors(spark, _vec_file(VEC), has_header=True)
    words = spark.createDataFrame([("bike",), ("zebra",)], "word string")
    got = {r["word"]: (r["in_vocab"], r["vec"]) for r in lookup(words, vecs).collect()}
    assert got["bike"] == (True, [7.0, 8.0])
    assert got["zebra"] == (False, [5.0, 6.0])
    st = vocabulary_stats(vecs).first()
    assert (st["size"], st["dim"]) == (4, 2)


def test_svm_params_checks():
    from ordo.operators.models import SvmParams
    assert SvmParams(gamma=0).checked(8).gamma == pytest.approx(1 / 8)
    for bad in (dict(kernel="cubic"), dict(C=0), dict(gamma=-1), dict(degree=-1), dict(eps=0)):
        with pytest.raises(ValueError):
            SvmParams(**bad).checked(4)


def test_kernels_on_literal_rows(spark):
    import math
    from ordo.operators.models import SvmParams, decision_values
    rows = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    sv = spark.createDataFrame([(1.0, [1.0, 0.0]), (-0.5, [0.0, 1.0])], "coef double, vec array<double>")
    p = SvmParams().checked(2)
    d = decision_values(rows, "x", sv, 0.25, p).first()
    assert d["dec_linear"] == pytest.approx(1.0 * 1 - 0.5 * 2 - 0.25)
    assert d["dec_rbf"] == pytest.approx(math.exp(-0.125 * 4) - 0.5 * math.exp(-0.125 * 2) - 0.25)
    assert d["dec_poly"] == pytest.approx((0.125 * 1) ** 3 - 0.5 * (0.125 * 2) ** 3 - 0.25)
    assert d["dec_sigmoid"] == pytest.approx(math.tanh(0.125) - 0.5 * math.tanh(0.25) - 0.25)


def test_weights_round_trip(spark):
    from ordo.sources.models_io import load_weights, save_weights
    p = tempfile.mkdtemp(prefix="ordo-w-") + "/w"
    save_weights(spark, {"a": 1.5, "b": -2.0}, p)
    assert load_weights(spark, p) == {"a": 1.5, "b": -2.0}


def test_nominal_to_binary(spark):
    from ordo.operators.scale import nominal_to_binary
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b")], "id int, c string")
    got = {r["id"]: (r["c_a"], r["c_b"]) for r in nominal_to_binary(df, "c").collect()}
    assert got == {1: (0.0, 1.0), 2: (1.0, 0.0), 3: (0.0, 1.0)}


def test_pairwise_weights_depend_on_c_and_solve_the_normal_equations(spark):
    import numpy as np
    from ordo.operators.models import fit_pairwise
    rows = [(q, d, float(d % 3), 0.1 * d + 0.01 * q, (-1.0) ** d) for q in range(4) for d in range(5)]
    fm = spark.createDataFrame(rows, "query_id long, doc_pos long, rel double, x double, y double")
    pairs = np.array([[a[3] - b[3], a[4] - b[4]] for a in rows for b in rows if a[0] == b[0] and a[2] > b[2]])
    found = []
    for c in (0.01, 1.0):
        w = np.array(list(fit_pairwise(fm, ["x", "y"], C=c).values()))
        assert np.allclose(w - c * pairs.T @ (1 - pairs @ w), 0, atol=1e-9)
        found.append(w)
    assert not np.allclose(*found, rtol=0.05)
