"""Learners and kernel scoring (M2, M4-M10, A7, A8) on Spark.

* M2  pointwise linear regression: ``pyspark.ml`` normal-equation solver; its
      Gram matrix is also exposed as a one-row aggregate (``regression_moments``).
* M4  pairwise linear ranker, two losses: squares on the pair-difference
      moments of ``pairs.pair_gram`` (exact, no pair rows; the d x d system is
      solved on the driver), or the hinge of the C-SVC (``operators.hinge``).
* M5  kernel ranker: seeded random Fourier features ``sqrt(2/D) cos(Wx + b)``
      here, or the Nystroem map with an error bound (``operators.kernel_map``);
      M4 then runs in that space.
* M6  kernel decision function over a support-vector table of any size, in
      blocks that rows meet by an equi-join (linear / poly / rbf / sigmoid).
* M7  class from the decision value (one-vs-one voting: ``operators.votes``); M8
      stratified folds; M9 Platt scaling by weighted ``LogisticRegression`` on given
      decision values (cross-fitted by Newton steps: ``operators.folds``); M10
      hyper-parameters (grid: ``operators.folds``); A7 linear weights; A8 class counts
      and class weights.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.operators.ranking import group_rank

# Support vectors of a block: an array column of this many stands in one row.
BLOCK_VECTORS = 1000


@dataclass(frozen=True)
class SvmParams:
    """Hyper-parameters (defaults as the reference runs them: C = 1, gamma = 0.125)."""
    kernel: str = "rbf"          # linear | poly | rbf | sigmoid
    C: float = 1.0
    gamma: float = 0.125         # 0 -> 1 / number of features
    degree: int = 3
    coef0: float = 0.0
    eps: float = 1e-3
    seed: int = 1

    def checked(self, n_features: int) -> "SvmParams":
        if self.kernel not in ("linear", "poly", "rbf", "sigmoid"):
            raise ValueError(f"kernel must be linear, poly, rbf or sigmoid, got {self.kernel!r}")
        if self.C <= 0:
            raise ValueError(f"C must be positive, got {self.C}")
        if self.gamma < 0:
            raise ValueError(f"gamma must not be negative, got {self.gamma}")
        if self.degree < 0:
            raise ValueError(f"degree must not be negative, got {self.degree}")
        if self.eps <= 0:
            raise ValueError(f"eps must be positive, got {self.eps}")
        g = self.gamma if self.gamma > 0 else 1.0 / max(n_features, 1)
        return SvmParams(self.kernel, self.C, g, self.degree, self.coef0, self.eps, self.seed)


# ---------------------------------------------------------------- M2

def regression_moments(fm: DataFrame, cols: Sequence[str], label: str) -> DataFrame:
    """One row: n, sum x_i, sum x_i x_j, sum x_i y, sum y, sum y^2 (the normal equations)."""
    cols = list(cols)
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(label).alias("sy"), F.sum(F.col(label) ** 2).alias("syy")]
    for i, a in enumerate(cols):
        aggs += [F.sum(a).alias(f"s_{a}"), F.sum(F.col(a) * F.col(label)).alias(f"sy_{a}")]
        for b in cols[i:]:
            aggs.append(F.sum(F.col(a) * F.col(b)).alias(f"ss_{a}__{b}"))
    return fm.agg(*aggs)


def fit_linear_regression(fm: DataFrame, cols: Sequence[str], label: str):
    """M2: least squares with intercept (normal equations, no regularisation)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    # training rows without a target value are dropped
    rows = fm.select(*cols, F.col(label).cast("double").alias("label")).dropna(subset=["label"])
    data = VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep").transform(rows)
    return LinearRegression(solver="normal", regParam=0.0, standardization=False).fit(data)


# ---------------------------------------------------------------- M4 / M5

def solve_pairwise(gram_row, cols: Sequence[str], C: float = 1.0) -> np.ndarray:
    """M4: w = argmin |w|^2 / 2 + C / 2 * sum_pairs (1 - w.d)^2 from ``pair_gram``'s row.

    The least-squares form of the C-SVC: (1/C + G) w = sum d, G the pair Gram matrix."""
    cols = list(cols)
    k = len(cols)
    G = np.zeros((k, k))
    for i, a in enumerate(cols):
        for j in range(i, k):
            v = gram_row[f"g_{a}__{cols[j]}"] or 0.0
            G[i, j] = G[j, i] = v
    d = np.array([gram_row[f"d_{c}"] or 0.0 for c in cols])
    return np.linalg.solve(G + np.eye(k) / C, d)


def fit_pairwise(fm: DataFrame, cols: Sequence[str], rel_col: str = "rel", C: float = 1.0, loss: str = "squares",
                 eps: float = 1e-3, weight_col: str | None = None) -> dict[str, float]:
    """M4 with ``loss`` "squares" or "hinge"; ``eps`` is the hinge solver's relative gap."""
    if loss == "hinge":
        from ordo.operators.hinge import fit_hinge
        return fit_hinge(fm, cols, rel_col, C, eps, weight_col)
    if loss != "squares":
        raise ValueError(f"loss must be squares or hinge, got {loss!r}")
    from ordo.operators.pairs import pair_gram
    row = pair_gram(fm, cols, rel_col, weight_col=weight_col).first()
    w = solve_pairwise(row, cols, C)
    return dict(zip(cols, map(float, w)))


def rff_columns(cols: Sequence[str], n_components: int, gamma: float, seed: int) -> list[Column]:
    """M5: random Fourier features of the RBF kernel exp(-gamma |x - y|^2)."""
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(n_components, len(cols)))
    b = rng.uniform(0.0, 2.0 * np.pi, size=n_components)
    scale = float(np.sqrt(2.0 / n_components))
    out = []
    for k in range(n_components):
        lin = F.lit(float(b[k]))
        for j, c in enumerate(cols):
            lin = lin + F.lit(float(W[k, j])) * F.col(c)
        out.append((F.lit(scale) * F.cos(lin)).alias(f"rff_{k}"))
    return out


# ---------------------------------------------------------------- M6 / M7 / A7

def _kernel(kind: str, p: SvmParams, x: Column, v: Column) -> Column:
    dot = F.aggregate(F.zip_with(x, v, lambda a, b: a * b), F.lit(0.0), lambda acc, t: acc + t)
    if kind == "linear":
        return dot
    if kind == "poly":
        return F.pow(F.lit(p.gamma) * dot + p.coef0, p.degree)
    if kind == "rbf":
        sq = F.aggregate(F.zip_with(x, v, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, t: acc + t)
        return F.exp(-F.lit(p.gamma) * sq)
    if kind == "sigmoid":
        return F.tanh(F.lit(p.gamma) * dot + p.coef0)
    raise ValueError(kind)


def decision_values(rows: DataFrame, x_col: str, sv: DataFrame, rho: float, p: SvmParams,
                    kinds: Sequence[str] = ("linear", "poly", "rbf", "sigmoid")) -> DataFrame:
    """M6: sum_k coef_k K(x, sv_k) - rho for each row and kernel.

    ``sv(coef double, vec array<double>)`` may have any size. It is hashed into blocks,
    each row is repeated for every block number, and an equi-join on that number brings
    both together; partial sums per row are added up. The linear kernel needs no blocks:
    its sum is the row times the weights (A7). ``rows`` keeps all its columns."""
    from ordo.session import materialize
    sv = materialize(sv.select("coef", "vec"))
    out = rows
    if "linear" in kinds:
        w = [r["w"] for r in linear_weights(sv, 0.0).orderBy("j").collect()][:-1]     # one number per feature
        terms = [F.lit(float(v)) * F.get(F.col(x_col), F.lit(j)) for j, v in enumerate(w)]
        out = out.withColumn("dec_linear", sum(terms, F.lit(0.0)) - F.lit(rho))
    rest = [k for k in kinds if k != "linear"]
    if not rest:
        return out
    n_blocks = max(1, -(-sv.count() // BLOCK_VECTORS))
    blocks = (sv.withColumn("_blk", F.pmod(F.xxhash64("vec", "coef"), F.lit(n_blocks)).cast("int"))
              .groupBy("_blk").agg(F.collect_list(F.struct("coef", "vec")).alias("_svs")))

    def summand(kind):
        return lambda acc, s: acc + s["coef"] * _kernel(kind, p, F.col(x_col), s["vec"])

    keyed = materialize(out.withColumn("_row", F.monotonically_increasing_id()))
    met = (keyed.select("_row", x_col, F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("_blk"))
           .join(blocks, "_blk"))
    sums = met.select("_row", *[F.aggregate("_svs", F.lit(0.0), summand(k)).alias(f"_p_{k}") for k in rest]).groupBy("_row").agg(
        *[F.sum(f"_p_{k}").alias(f"_p_{k}") for k in rest])
    done = keyed.join(sums, "_row", "left").drop("_row")
    for k in rest:
        done = done.withColumn(f"dec_{k}", F.coalesce(f"_p_{k}", F.lit(0.0)) - F.lit(rho)).drop(f"_p_{k}")
    return done


def predict_class(decision: Column, first_label=1, second_label=0) -> Column:
    """M7 (binary): the first label wins when the decision value is > 0."""
    return F.when(decision > 0, F.lit(first_label)).otherwise(F.lit(second_label))


def linear_weights(sv: DataFrame, rho: float) -> DataFrame:
    """w_j = sum_k coef_k sv_kj, plus the bias -rho as the last entry."""
    per = (sv.select("coef", F.posexplode("vec").alias("j", "v"))
           .groupBy("j").agg(F.sum(F.col("coef") * F.col("v")).alias("w")))
    dim = sv.select(F.max(F.size("vec")).alias("d"))
    return per.unionByName(dim.select(F.col("d").alias("j"), F.lit(-float(rho)).alias("w")))


# ---------------------------------------------------------------- A8 / M8 / M9

def class_counts(df: DataFrame, label: str, order: Sequence[Column]) -> DataFrame:
    """Rows per class and the order in which classes first occur."""
    first = df.select(label, F.struct(*order).alias("_o"))
    g = first.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.min("_o").alias("_first"))
    g = g.withColumn("_all", F.lit(0))
    return group_rank(g, ["_all"], [F.col("_first")], "first_seen", strategy="range").drop("_all", "_first")


def with_class_weights(df: DataFrame, label: str, weights: dict, out: str = "weight", default: float = 1.0) -> DataFrame:
    """A row's weight by its class; a class that is not named has ``default``."""
    w = F.lit(float(default))
    for k, v in weights.items():
        if v < 0:
            raise ValueError(f"class weight of {k!r} must not be negative, got {v}")
        w = F.when(F.col(label) == F.lit(k), F.lit(float(v))).otherwise(w)
    return df.withColumn(out, w)


def stratified_folds(df: DataFrame, label: str, order: Sequence[Column], k: int = 5) -> DataFrame:
    """M8: fold = (position within its class - 1) mod k; classes are balanced
    across folds. A class holding most rows is numbered by the skew-safe plan."""
    r = group_rank(df, [label], order, "_pos", strategy="range")
    return r.withColumn("fold", ((F.col("_pos") - 1) % k).cast("int")).drop("_pos")


def platt(dec: DataFrame, decision: str, label: str):
    """M9: sigmoid 1/(1+exp(A f + B)) fitted to decision values with the
    smoothed targets (n+ + 1)/(n+ + 2) and 1/(n- + 2), written as two weighted
    rows per example for ``LogisticRegression``. Returns (A, B)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    cnt = dec.agg(F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).alias("p"),
                  F.sum(F.when(F.col(label) > 0, 0).otherwise(1)).alias("n")).first()
    hi = (cnt["p"] + 1.0) / (cnt["p"] + 2.0)
    lo = 1.0 / (cnt["n"] + 2.0)
    t = F.when(F.col(label) > 0, F.lit(hi)).otherwise(F.lit(lo))
    rows = dec.select(F.col(decision).alias("f"), t.alias("t"))
    two = (rows.select("f", F.lit(1.0).alias("label"), F.col("t").alias("w"))
           .unionByName(rows.select("f", F.lit(0.0).alias("label"), (1 - F.col("t")).alias("w"))))
    data = VectorAssembler(inputCols=["f"], outputCol="features").transform(two)
    m = LogisticRegression(weightCol="w", regParam=0.0, standardization=False).fit(data)
    return -float(m.coefficients[0]), -float(m.intercept)
