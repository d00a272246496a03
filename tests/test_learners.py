"""Hinge over implicit pairs, Nystroem map, fold moments, calibration and votes against brute force."""

import json
import tempfile
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordo.operators import folds, hinge, kernel_map, votes
from ordo.operators.models import fit_pairwise, with_class_weights

COLS = ["x0", "x1", "x2"]


def table(spark, n=160, lists=9, d=3, seed=0, weights=False, missing=0.0):
    r = np.random.default_rng(seed)
    rel = r.integers(0, 4, n)
    x = np.round(r.normal(size=(n, d)) + 0.4 * rel[:, None] * (np.arange(d) % 2 == 0), 6)
    rows = [(int(r.integers(0, lists)), k, float(rel[k]), float(r.choice([1.0, 2.0])) if weights else 1.0,
             *[None if r.random() < missing else float(v) for v in x[k]]) for k in range(n)]
    schema = "query_id long, doc_pos long, rel double, u double, " + ", ".join(f"x{j} double" for j in range(d))
    return spark.createDataFrame(rows, schema), rows


def all_pairs(rows):
    d, w = [], []
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[2] > b[2]:
                d.append(np.array(a[4:]) - np.array(b[4:]))
                w.append(a[3] * b[3])
    return np.array(d), np.array(w)


def dual_ascent(d, u, C, rounds=12_000):
    """(lower bound, objective) of the least objective by exact coordinate steps on the dual of the explicit pairs."""
    alpha, w, sq = np.zeros(len(d)), np.zeros(d.shape[1]), (d * d).sum(1)
    order = np.random.default_rng(1)
    for _ in range(rounds):
        for k in order.permutation(len(d)):
            new = min(2 * C * u[k], max(0.0, alpha[k] + (1 - w @ d[k]) / sq[k]))
            w += (new - alpha[k]) * d[k]
            alpha[k] = new
        low = alpha.sum() - w @ w / 2
        high = w @ w / 2 + 2 * C * (u * np.maximum(0, 1 - d @ w)).sum()
        if high - low < 1e-7 * high:
            break
    return low, high


@pytest.mark.parametrize("large", [20_000, 12])
def test_hinge_pass_equals_all_pairs(spark, large):
    """Loss and subgradient at several points, with lists in blocks and in slices."""
    df, rows = table(spark, weights=True)
    d, u = all_pairs(rows)
    packed = hinge.pack(df, COLS, weight_col="u", block_rows=40, large_list=large)
    assert (packed.large is None) == (large > 100) and packed.pairs == pytest.approx(u.sum())
    points = np.array([[0.0, 0.0, 0.0], [0.5, -1.0, 2.0]])
    for w, f in zip(points, packed.at(points)):
        m = 1 - d @ w
        assert f[0] == pytest.approx((u * np.maximum(m, 0)).sum(), rel=1e-9)
        assert f[1:] == pytest.approx(-(u * (m > 0)) @ d, rel=1e-9, abs=1e-9)


def test_hinge_objective_equals_a_pair_solver(spark):
    df, rows = table(spark, n=50, lists=6)
    d, u = all_pairs(rows)
    packed = hinge.pack(df, COLS)
    found = {}
    for C in (0.01, 1.0):
        low, high = dual_ascent(d, u, C)
        fit = hinge.solve(packed, C, eps=1e-7)
        assert low * (1 - 1e-9) <= fit.objective <= min(low * (1 + 1e-6), high * (1 + 1e-7)) and 0 <= fit.gap <= 1e-7 * fit.objective
        found[C] = fit
    assert not np.allclose(found[0.01].weights, found[1.0].weights, rtol=1e-2)          # C takes effect
    rough = hinge.solve(packed, 1.0, eps=0.3)
    assert rough.passes < found[1.0].passes and rough.gap <= 0.3 * rough.objective      # eps takes effect


@pytest.mark.parametrize("loss", ["squares", "hinge"])
def test_a_weight_of_two_is_the_row_twice(spark, loss):
    df, rows = table(spark, n=80, lists=5)
    weighed = with_class_weights(df, "rel", {3.0: 2.0}, "u")
    twice = df.unionByName(df.where("rel = 3"))
    a = fit_pairwise(weighed, COLS, "rel", 0.1, loss, 1e-6, "u")
    b = fit_pairwise(twice, COLS, "rel", 0.1, loss, 1e-6)
    assert a == pytest.approx(b, rel=1e-2 if loss == "hinge" else 1e-9, abs=1e-3 if loss == "hinge" else 1e-9)


def test_hinge_without_pairs_or_rows(spark):
    df, _ = table(spark, n=20)
    same = df.withColumn("rel", F.lit(1.0))
    assert hinge.fit_hinge(same, COLS) == {c: 0.0 for c in COLS}
    assert hinge.fit_hinge(df.where("false"), COLS) == {c: 0.0 for c in COLS}
    with pytest.raises(ValueError):
        fit_pairwise(df, COLS, loss="cubes")


def test_kernel_error_is_bounded_and_falls_with_landmarks(spark):
    df, rows = table(spark, n=300)
    x = np.array([r[4:] for r in rows])
    true = np.exp(-0.125 * ((x[:, None] - x[None]) ** 2).sum(2))
    last = 2.0
    for m in (2, 8, 40, 150):
        kernel = kernel_map.fit(df, COLS, m)
        z = kernel_map.mapped(df, COLS, kernel, ["doc_pos"])
        bound = kernel_map.errors(z).first()
        got = np.array([r["z"] for r in z.orderBy("doc_pos").collect()])
        worst = np.abs(true - got @ got.T).max()
        assert worst <= bound["max_error"] + 1e-8 and bound["max_error"] < last and bound["mean_error"] <= bound["max_error"]
        last = bound["max_error"]
    assert last < 0.02
    assert not np.array_equal(kernel_map.fit(df, COLS, 8, seed=2, sample=50).landmarks, kernel_map.fit(df, COLS, 8, sample=50).landmarks)


def by_hand(rows, fold, k, cols):
    """Imputed, training-fold rows and held-out rows of fold k."""
    train = [r for r in rows if fold[r[0]] != k]
    means = [np.mean([r[4 + j] for r in train if r[4 + j] is not None]) for j in range(cols)]
    x = lambda rs: np.array([[means[j] if r[4 + j] is None else r[4 + j] for j in range(cols)] for r in rs])
    return train, x(train), x([r for r in rows if fold[r[0]] == k])


def test_fold_models_equal_fits_on_the_training_rows(spark):
    df, rows = table(spark, n=200, lists=20, missing=0.15)
    fm = df.join(folds.query_folds(df, 4), "query_id")
    fold = {r["query_id"]: r["fold"] for r in fm.select("query_id", "fold").distinct().collect()}
    moments, pairs = folds.fold_moments(fm, COLS, "rel"), folds.fold_pairs(fm, COLS)
    for k in moments:
        train, x, _ = by_hand(rows, fold, k, 3)
        y = np.array([r[2] for r in train])
        want = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
        got = folds.regression(folds.without(moments, k))
        assert np.append(got.weights, got.intercept) == pytest.approx(want, rel=1e-8)
        z = (x - x.mean(0)) / x.std(0, ddof=1)
        d = np.array([z[i] - z[j] for i in range(len(z)) for j in range(len(z)) if train[i][0] == train[j][0] and y[i] > y[j]])
        w = np.linalg.solve(d.T @ d + np.eye(3) / 10.0, d.sum(0)) / x.std(0, ddof=1)
        assert folds.pairwise(folds.without(moments, k), folds.without(pairs, k), 10.0).weights == pytest.approx(w, rel=1e-8)


def test_a_held_out_row_does_not_reach_its_own_model(spark):
    """Grades of one fold set to nonsense change the scores of the other folds only."""
    df, _ = table(spark, n=200, lists=20, missing=0.1)
    fm = df.join(folds.query_folds(df, 4), "query_id")

    def scores(rows):
        moments = folds.fold_moments(rows, COLS, "rel")
        s = folds.held_out_scores(rows, COLS, {f: folds.regression(folds.without(moments, f)) for f in moments})
        return {r["doc_pos"]: (r["fold"], r["s"]) for r in rows.select("doc_pos", "fold", s.alias("s")).collect()}
    a, b = scores(fm), scores(fm.withColumn("rel", F.when(F.col("fold") == 2, F.col("doc_pos") * 7.0).otherwise(F.col("rel"))))
    assert all(a[k][1] == pytest.approx(b[k][1], rel=1e-9) for k in a if a[k][0] == 2)
    assert any(abs(a[k][1] - b[k][1]) > 1 for k in a if a[k][0] != 2)


def test_platt_is_the_optimum(spark):
    r = np.random.default_rng(3)
    f = r.normal(size=400)
    y = (r.random(400) < 1 / (1 + np.exp(-2 * f + 0.5))).astype(int)
    a, b = folds.platt(spark.createDataFrame([(float(u), int(v)) for u, v in zip(f, y)], "f double, y int"), "f", "y")
    up, down = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    p = 1 / (1 + np.exp(a * f + b))
    assert abs(((t - p) * f).sum()) < 1e-6 and abs((t - p).sum()) < 1e-6 and a < 0
    one = spark.createDataFrame([(1.0, 1), (2.0, 1)], "f double, y int")
    assert all(np.isfinite(folds.platt(one, "f", "y")))


def test_votes_equal_brute_force_for_four_classes(spark):
    df, rows = table(spark, n=200)
    moments = votes.class_moments(df, COLS, "rel")
    for machines in (votes.least_squares(moments), votes.centroids(moments)):
        assert [(m.first, m.second) for m in machines] == list(combinations([0.0, 1.0, 2.0, 3.0], 2))
        got = {r["doc_pos"]: (r["predicted"], r["votes"]) for r in votes.vote(df, COLS, machines).collect()}
        for row in rows:
            count = [0, 0, 0, 0]
            for m in machines:
                won = m.first if np.dot(m.weights, row[4:]) + m.bias > 0 else m.second
                count[int(won)] += 1
            assert got[row[1]] == (float(count.index(max(count))), count)
    a, b = 0.0, 2.0
    x = np.array([[*r[4:], 1.0] for r in rows if r[2] in (a, b)])
    want = np.linalg.lstsq(x, np.array([1.0 if r[2] == a else -1.0 for r in rows if r[2] in (a, b)]), rcond=None)[0]
    m = next(m for m in votes.least_squares(moments, 0.0) if (m.first, m.second) == (a, b))
    assert [*m.weights, m.bias] == pytest.approx(want, rel=1e-7)
    weighed = votes.class_moments(df.withColumn("w", F.lit(2.0)), COLS, "rel", "w")
    assert weighed[1.0][0] == 2 * moments[1.0][0]
    assert votes.vote(df.withColumn("x0", F.lit(None).cast("double")), COLS, machines).first()["predicted"] is None


def test_a_saved_task_ranks_as_the_fitted_one(spark):
    from ordo.plans import tasks
    fitted = tasks.Fitted(("is_pdf",), {"url_w": 0.1, "is_pdf": 0.0}, {"url_w": (0.1, 1 / 3), "is_pdf": (0.5, None)}, (16, 0.125, 1), {"rff_0": 2 / 7}, 1e-17)
    for one in (fitted, tasks.Fitted((), {"a": 0.3}, None, None, {"a": 1.0 / 3.0}, 0.7)):
        path = tempfile.mkdtemp(prefix="ordo-task-") + "/t"
        tasks.save(spark, one, path)
        assert tasks.load(spark, path) == one
        json.loads(spark.read.text(path).first()[0])


class _Local:
    """The passes of ``hinge.Pairs`` over rows held here."""

    def __init__(self, lists, x, grade):
        self.lists, self.x, self.grade, self.n, self.dim = lists, x, grade, np.ones(len(x)), x.shape[1]

    def at(self, points):
        out = []
        for w in points:
            below, _, above = hinge.swept(self.lists, self.x @ w, self.grade, self.n).reshape(3, -1)
            out.append(hinge._sums(self.x @ w, self.x, self.n, above, below))
        return np.array(out)


@pytest.mark.parametrize("C", [1.0, 100.0, 10_000.0])
def test_hinge_with_two_equal_features_and_many_pairs(C):
    """Equal columns under a loss that dwarfs |w|^2: the minimum is found, and both columns weigh the same."""
    r = np.random.default_rng(5)
    lists = np.repeat(np.arange(1300), 10)
    x = np.where(r.random((13_000, 5)) < 0.9, 0.0, r.exponential(1.0, (13_000, 5)))
    x[:, 3] = x[:, 1]
    x = (x - x.mean(0)) / x.std(0, ddof=1)
    grade = (np.tile(np.arange(10), 1300) * 3 + lists * 7) % 7
    fit = hinge.solve(_Local(lists, x, grade), C, eps=1e-4)
    assert fit.gap <= 1e-4 * fit.objective
    assert fit.weights[3] == pytest.approx(fit.weights[1], abs=1e-5)
    again = hinge.solve(_Local(lists, x[:, [0, 1, 2, 4]] * [1, 2 ** 0.5, 1, 1], grade), C, eps=1e-4)
    assert fit.objective == pytest.approx(again.objective, rel=1e-4)
