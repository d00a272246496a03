"""Nystroem map of the RBF kernel, with an error bound for every row (M5).

``z(x) = K(x, Z) L^-T`` with landmarks Z and ``K(Z, Z) = L L'``, so ``z(x) . z(y)`` is the kernel of the
projections on the landmarks' span. What is left of a row, ``r(x) = 1 - |z(x)|^2``, is not
negative, and ``|K(x, y) - z(x) . z(y)| <= sqrt(r(x) r(y))`` for any two rows: the largest
``r`` of a table bounds the error of all its pairs without looking at pairs.

Seeding: rows are dealt into ``SAMPLE`` hash classes and the row of least hash stands for its class,
an aggregate with a bounded result; on the driver landmarks are taken from these greedily, each the
row with the largest ``r`` so far (a pivoted Cholesky factorisation), until ``m`` are taken or no
row has more than ``tolerance`` left. The seed changes the classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 2000            # rows that landmarks are chosen from, at most


@dataclass(frozen=True)
class KernelMap:
    landmarks: np.ndarray      # m x d
    root: np.ndarray           # m x m, L^-T
    gamma: float

    def rows(self, x: np.ndarray) -> np.ndarray:
        """z of each row of ``x``."""
        far = (x * x).sum(1)[:, None] - 2 * x @ self.landmarks.T + (self.landmarks * self.landmarks).sum(1)
        return np.exp(-self.gamma * np.maximum(far, 0.0)) @ self.root

    def column(self, x: Column) -> Column:
        """z of an array column, in Arrow batches."""
        def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for s in batches:
                yield pd.Series(list(self.rows(np.stack(s.to_numpy()))) if len(s) else [], dtype=object)
        return F.pandas_udf(mapped, "array<double>")(x)


def chosen(sample: np.ndarray, m: int, gamma: float, tolerance: float = 1e-9) -> KernelMap:
    """Landmarks out of ``sample`` by greedy residual."""
    left, taken = np.ones(len(sample)), []
    factor = np.zeros((len(sample), 0))
    while len(taken) < min(m, len(sample)):
        k = int(left.argmax())
        if left[k] <= tolerance:
            break
        row = np.exp(-gamma * ((sample - sample[k]) ** 2).sum(1)) - factor @ factor[k]
        factor = np.hstack([factor, (row / np.sqrt(left[k]))[:, None]])
        left = np.maximum(left - factor[:, -1] ** 2, 0.0)
        taken.append(k)
    z = sample[taken]
    far = ((z[:, None] - z[None]) ** 2).sum(2)
    lower = np.linalg.cholesky(np.exp(-gamma * far) + 1e-12 * np.eye(len(z)))
    return KernelMap(z, np.linalg.inv(lower).T, gamma)


def fit(fm: DataFrame, cols: Sequence[str], m: int = 32, gamma: float = 0.125, seed: int = 1, sample: int = SAMPLE) -> KernelMap:
    """A map for the features ``cols`` (rows with a missing one take no part)."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    rows = fm.select(x.alias("x")).where(~F.exists("x", lambda v: v.isNull() | F.isnan(v))).withColumn("h", F.xxhash64("x", F.lit(seed)))
    least = rows.groupBy(F.pmod("h", F.lit(sample)).alias("c")).agg(F.min_by("x", "h").alias("x"))
    found = sorted(tuple(r["x"]) for r in least.select("x").collect())
    if not found:
        raise ValueError("no row has all features")
    return chosen(np.array(found), m, gamma)


def mapped(fm: DataFrame, cols: Sequence[str], kernel: KernelMap, keep: Sequence[str], out: str = "z") -> DataFrame:
    """``keep`` and the array column ``out`` of every row."""
    return fm.select(*keep, kernel.column(F.array(*[F.col(c).cast("double") for c in cols])).alias(out))


def errors(z: DataFrame, z_col: str = "z") -> DataFrame:
    """One row: n, max_error, mean_error. The largest ``r`` bounds the kernel error of all pairs of rows."""
    left = F.greatest(1.0 - F.aggregate(z_col, F.lit(0.0), lambda a, v: a + v * v), F.lit(0.0))
    return z.select(left.alias("r")).agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("max_error"), F.avg("r").alias("mean_error"))
