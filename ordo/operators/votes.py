"""One-vs-one voting (M7): a machine for every pair of classes, the class with most votes wins.

Machines are linear and come from class moments: one aggregate gives each class's count, sums and
products, and a machine of two classes is solved from the moments of both (``least_squares``), or
separates their centroids (``centroids``). k classes make k(k-1)/2 machines of d + 1 numbers, which
is all that reaches the driver; ``MAX_CLASSES`` bounds k. A decision over 0 is a vote for the first
class of the pair, any other for the second; on equal votes the lowest class wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CLASSES = 100


@dataclass(frozen=True)
class Machine:
    first: float
    second: float
    weights: tuple[float, ...]
    bias: float


def class_moments(fm: DataFrame, cols: Sequence[str], label: str, weight_col: str | None = None) -> dict[float, tuple[float, np.ndarray, np.ndarray]]:
    """Class -> (n, sum x, sum x x') of rows that have all features; a row's weight counts it so often."""
    u = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    terms = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    rows = fm.dropna(subset=[label, *cols]).groupBy(F.col(label).cast("double").alias("label")).agg(
        F.sum(u).alias("n"), *[F.sum(u * F.col(c)).alias(f"s{i}") for i, c in enumerate(cols)],
        *[F.sum(u * F.col(cols[i]) * F.col(cols[j])).alias(f"q{i}_{j}") for i, j in terms]).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} classes")
    out = {}
    for r in sorted(rows, key=lambda r: r["label"]):
        q = np.zeros((len(cols), len(cols)))
        for i, j in terms:
            q[i, j] = q[j, i] = r[f"q{i}_{j}"]
        out[r["label"]] = (float(r["n"]), np.array([r[f"s{i}"] for i in range(len(cols))]), q)
    return out


def least_squares(moments: dict, ridge: float = 1e-6) -> list[Machine]:
    """Targets +1 and -1, with intercept; ``ridge`` keeps collinear features solvable."""
    out = []
    for a, b in combinations(moments, 2):
        (na, sa, qa), (nb, sb, qb) = moments[a], moments[b]
        n, d = na + nb, len(sa)
        mean, target = (sa + sb) / n, (na - nb) / n
        cov = (qa + qb) / n - np.outer(mean, mean) + ridge * np.eye(d)
        w = np.linalg.solve(cov, (sa - sb) / n - mean * target)
        out.append(Machine(a, b, tuple(map(float, w)), float(target - w @ mean)))
    return out


def centroids(moments: dict) -> list[Machine]:
    """Votes for the nearer centroid: 2 (ca - cb) . x + |cb|^2 - |ca|^2."""
    out = []
    for a, b in combinations(moments, 2):
        ca, cb = (moments[k][1] / moments[k][0] for k in (a, b))
        out.append(Machine(a, b, tuple(map(float, 2 * (ca - cb))), float(cb @ cb - ca @ ca)))
    return out


def decision(m: Machine, cols: Sequence[str]) -> Column:
    total = F.lit(m.bias)
    for c, w in zip(cols, m.weights):
        total = total + F.lit(w) * F.col(c)
    return total


def vote(fm: DataFrame, cols: Sequence[str], machines: Sequence[Machine], digits: int | None = None) -> DataFrame:
    """``fm`` with ``votes`` (by class, ascending) and ``predicted``; a row with a missing feature has neither.

    ``digits`` rounds decisions, for decisions that should be exactly 0."""
    classes = sorted({m.first for m in machines} | {m.second for m in machines})
    won = []
    for m in machines:
        d = decision(m, cols)
        won.append(F.when(d.isNull(), F.lit(None)).when((F.round(d, digits) if digits is not None else d) > 0, F.lit(classes.index(m.first)))
                   .otherwise(F.lit(classes.index(m.second))))
    listed = F.array(*won)
    counts = F.transform(F.sequence(F.lit(0), F.lit(len(classes) - 1)), lambda k: F.size(F.filter(listed, lambda v: v == k)))
    out = fm.withColumn("votes", F.when(~F.exists(listed, lambda v: v.isNull()), counts))
    first = F.array_position("votes", F.array_max("votes")).cast("int")
    return out.withColumn("predicted", F.get(F.array(*[F.lit(c) for c in classes]), first - 1))
