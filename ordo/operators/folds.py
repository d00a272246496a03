"""Model selection and calibration from fold moments.

One aggregate gives sufficient statistics of every fold; a training set is the total minus its
fold, so no model is fitted on rows twice and nothing is cached. Missing values are part of the
statistics: a row is extended by a flag per feature, ``e = (x or 0, x missing)``, and whatever mean
``m`` a training set has, its imputed row is ``[I | diag(m)] e``. So imputation, scaling and the fit
all belong to the training folds, for any number of hyper-parameters, from the same table.

* ``fold_moments`` / ``FoldMoments.regression``: pointwise least squares without a fold.
* ``fold_pairs`` / ``FoldMoments.pairwise``: the squared-loss pairwise ranker without a fold, for any C.
* ``held_out_scores``: every row scored by the models that have not seen its fold, in one projection.
* ``cross_validate``: mean NDCG by (C, fold) from one ranking job.
* ``platt``: sigmoid by damped Newton steps, each one aggregate over the held-out decision values.

What reaches the driver has folds x features^2 numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordo.operators.pairs import pair_gram


def _missing(c: str) -> Column:
    return F.col(c).isNull() | F.isnan(F.col(c))


def extended(fm: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``keep`` and, for each feature, its value (0 where missing) and its missing flag."""
    values = [F.when(_missing(c), F.lit(0.0)).otherwise(F.col(c).cast("double")).alias(f"v{k}") for k, c in enumerate(cols)]
    flags = [F.when(_missing(c), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"f{k}") for k, c in enumerate(cols)]
    return fm.select(*keep, *values, *flags), [f"v{k}" for k in range(len(cols))] + [f"f{k}" for k in range(len(cols))]


def query_folds(fm: DataFrame, k: int = 5, query_col: str = "query_id") -> DataFrame:
    """(query_id, fold): whole lists go to folds in turn, by their id."""
    from ordo.operators.models import stratified_folds
    lists = fm.select(query_col).distinct().withColumn("_one", F.lit(0))
    return stratified_folds(lists, "_one", [F.col(query_col)], k).select(query_col, "fold")


@dataclass(frozen=True)
class Moments:
    n: float
    first: np.ndarray        # sums of e
    second: np.ndarray       # sums of e e'
    cross: np.ndarray        # sums of e y
    y: float

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.first - other.first, self.second - other.second, self.cross - other.cross, self.y - other.y)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.first + other.first, self.second + other.second, self.cross + other.cross, self.y + other.y)

    def means(self) -> np.ndarray:
        """Feature means over the rows that have the feature; 0 where none has."""
        d = len(self.first) // 2
        present = self.n - self.first[d:]
        return np.where(present > 0, self.first[:d] / np.maximum(present, 1.0), 0.0)


def _fill(means: np.ndarray) -> np.ndarray:
    return np.hstack([np.eye(len(means)), np.diag(means)])


def fold_moments(fm: DataFrame, cols: Sequence[str], label: str, fold_col: str = "fold") -> dict[int, Moments]:
    """Moments of every fold, from one aggregate. Rows without a label take no part."""
    rows, e = extended(fm.where(F.col(label).isNotNull()), cols, [F.col(fold_col).alias("fold"), F.col(label).cast("double").alias("y")])
    terms = [(i, j) for i in range(len(e)) for j in range(i, len(e))]
    aggs = ([F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")] + [F.sum(c).alias(f"a_{c}") for c in e]
            + [F.sum(F.col(c) * F.col("y")).alias(f"b_{c}") for c in e]
            + [F.sum(F.col(e[i]) * F.col(e[j])).alias(f"c_{i}_{j}") for i, j in terms])
    out = {}
    for r in rows.groupBy("fold").agg(*aggs).collect():
        second = np.zeros((len(e), len(e)))
        for i, j in terms:
            second[i, j] = second[j, i] = r[f"c_{i}_{j}"]
        out[r["fold"]] = Moments(float(r["n"]), np.array([r[f"a_{c}"] for c in e]), second, np.array([r[f"b_{c}"] for c in e]), r["y"])
    return out


def fold_pairs(fm: DataFrame, cols: Sequence[str], rel_col: str = "rel", fold_col: str = "fold",
               weight_col: str | None = None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(sum of d, sum of d d') of every fold over its pairs of different grades, d the difference of extended rows."""
    keep = ["query_id", F.col(rel_col).alias("rel"), F.col(fold_col).alias("fold")] + ([weight_col] if weight_col else [])
    rows, e = extended(fm.where(F.col(rel_col).isNotNull()), cols, keep)
    out = {}
    for r in pair_gram(rows, e, "rel", by=("fold",), weight_col=weight_col).collect():
        gram = np.zeros((len(e), len(e)))
        for i, a in enumerate(e):
            for j in range(i, len(e)):
                gram[i, j] = gram[j, i] = r[f"g_{a}__{e[j]}"] or 0.0
        out[r["fold"]] = (np.array([r[f"d_{a}"] or 0.0 for a in e]), gram)
    return out


@dataclass(frozen=True)
class Linear:
    """A linear model of raw features: missing ones count as ``fill``."""
    weights: np.ndarray
    fill: np.ndarray
    intercept: float = 0.0


def regression(train: Moments) -> Linear:
    """Least squares with intercept on imputed rows; of collinear features' solutions the shortest."""
    m = train.means()
    a = _fill(m)
    mean = a @ train.first / train.n
    cov = a @ train.second @ a.T / train.n - np.outer(mean, mean)
    with_y = a @ train.cross / train.n - mean * train.y / train.n
    w = np.linalg.lstsq(cov, with_y, rcond=1e-12)[0]
    return Linear(w, m, float(train.y / train.n - w @ mean))


def pairwise(train: Moments, pairs: tuple[np.ndarray, np.ndarray], C: float) -> Linear:
    """The squared-loss pairwise ranker on imputed, standardised rows, as weights of raw features."""
    m = train.means()
    a = _fill(m)
    mean = a @ train.first / train.n
    var = (np.diag(a @ train.second @ a.T) - train.n * mean ** 2) / max(train.n - 1.0, 1.0)
    s = np.where(var > 1e-24, np.sqrt(np.maximum(var, 1e-24)), 1.0)
    d, gram = a @ pairs[0] / s, a @ pairs[1] @ a.T / np.outer(s, s)
    w = np.linalg.solve(gram + np.eye(len(s)) / C, d) / s
    return Linear(w, m, float(-w @ mean))                # of standardised rows, so 0 on average


def without(parts: dict, fold: int):
    """The total of ``parts`` minus one of them."""
    rest = [v for k, v in parts.items() if k != fold]
    if isinstance(rest[0], tuple):
        return sum(r[0] for r in rest), sum(r[1] for r in rest)
    total = rest[0]
    for r in rest[1:]:
        total = total + r
    return total


def score(model: Linear, cols: Sequence[str]) -> Column:
    total = F.lit(model.intercept)
    for c, w, m in zip(cols, model.weights, model.fill):
        total = total + F.lit(float(w)) * F.when(_missing(c), F.lit(float(m))).otherwise(F.col(c))
    return total


def held_out_scores(fm: DataFrame, cols: Sequence[str], models: dict[int, Linear], fold_col: str = "fold") -> Column:
    """The score of a row by its fold's model; null for a fold without one."""
    out = F.lit(None).cast("double")
    for fold, model in models.items():
        out = F.when(F.col(fold_col) == fold, score(model, cols)).otherwise(out)
    return out


def cross_validate(fm: DataFrame, cols: Sequence[str], rel_col: str = "rel", Cs: Sequence[float] | None = None,
                   fold_col: str = "fold", digits: int | None = None) -> DataFrame:
    """(C, fold, n_queries, mean_ndcg) of held-out lists. With ``Cs`` the pairwise ranker at each C; else the
    pointwise regression, C null. ``digits`` rounds scores before ranking."""
    from ordo.operators.metrics import ndcg_per_query
    moments = fold_moments(fm, cols, rel_col, fold_col)
    if Cs is None:
        grid = {None: {f: regression(without(moments, f)) for f in moments}}
    else:
        pairs = fold_pairs(fm, cols, rel_col, fold_col)
        grid = {C: {f: pairwise(without(moments, f), without(pairs, f), C) for f in moments} for C in Cs}
    scores = [held_out_scores(fm, cols, models, fold_col) for models in grid.values()]
    each = F.array(*[F.struct(F.lit(C).cast("double").alias("C"), (F.round(s, digits) if digits is not None else s).alias("score"))
                     for C, s in zip(grid, scores)])
    rows = fm.select("query_id", "doc_pos", F.col(rel_col).alias("rel"), F.col(fold_col).alias("fold"), F.explode(each).alias("m")).select(
        "query_id", "doc_pos", "rel", "fold", F.col("m.C").alias("C"), F.col("m.score").alias("score"))
    per = ndcg_per_query(rows.where(F.col("rel").isNotNull()), ["C", "fold", "query_id"], [F.col("score").desc_nulls_last(), F.col("doc_pos")])
    return per.groupBy("C", "fold").agg(F.count(F.lit(1)).alias("n_queries"), F.avg("ndcg").alias("mean_ndcg"))


def platt(dec: DataFrame, decision: str, label: str, steps: int = 50, tolerance: float = 1e-10) -> tuple[float, float]:
    """M9: (A, B) of 1 / (1 + exp(A f + B)) with the smoothed targets (n+ + 1) / (n+ + 2) and 1 / (n- + 2).

    ``decision`` has to come from models that have not seen the row. A step that does not lower the
    cost is halved; two numbers move, so each step is one aggregate."""
    rows = dec.select(F.col(decision).cast("double").alias("f"), (F.col(label) > 0).alias("up")).where(F.col("f").isNotNull())
    n = rows.agg(F.sum(F.col("up").cast("int")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    up, down = float(n["p"] or 0), float((n["n"] or 0) - (n["p"] or 0))
    target = F.when(F.col("up"), F.lit((up + 1.0) / (up + 2.0))).otherwise(F.lit(1.0 / (down + 2.0)))
    a, b = 0.0, float(np.log((down + 1.0) / (up + 1.0)))

    def at(a: float, b: float):
        z = F.lit(a) * F.col("f") + F.lit(b)
        p = 1.0 / (1.0 + F.exp(z))
        cost = target * z + F.log1p(F.exp(-F.abs(z))) + F.greatest(-z, F.lit(0.0))      # -t log p - (1 - t) log (1 - p)
        off, bend = target - p, p * (1.0 - p)
        return rows.agg(F.sum(cost).alias("cost"), F.sum(off * F.col("f")).alias("ga"), F.sum(off).alias("gb"),
                        F.sum(bend * F.col("f") * F.col("f")).alias("haa"), F.sum(bend * F.col("f")).alias("hab"),
                        F.sum(bend).alias("hbb")).first()

    now = at(a, b)
    if now["cost"] is None:
        return a, b
    for _ in range(steps):
        h = np.array([[now["haa"] + 1e-12, now["hab"]], [now["hab"], now["hbb"] + 1e-12]])
        move = -np.linalg.solve(h, [now["ga"], now["gb"]])
        size = 1.0
        while True:
            new = at(a + size * move[0], b + size * move[1])
            if new["cost"] <= now["cost"] or size < 1e-10:
                break
            size /= 2
        a, b, now = a + size * move[0], b + size * move[1], new
        if np.abs(size * move).max() <= tolerance * max(1.0, abs(a), abs(b)):
            break
    return float(a), float(b)


def probability(decision: Column, a: float, b: float) -> Column:
    return 1.0 / (1.0 + F.exp(F.lit(a) * decision + F.lit(b)))


def best(found: DataFrame) -> DataFrame:
    """Mean NDCG over the folds of each C, best first (ties: the smaller C)."""
    mean = found.groupBy("C").agg((F.sum(F.col("mean_ndcg") * F.col("n_queries")) / F.sum("n_queries")).alias("mean_ndcg"))
    return mean.withColumn("place", F.row_number().over(Window.orderBy(F.col("mean_ndcg").desc(), "C")))      # one row per C
