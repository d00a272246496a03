"""Pairwise C-SVC with the hinge loss over pairs that are never formed (M4).

    J(w) = |w|^2 / 2 + 2 C * sum over pairs (i, j), grade_i > grade_j, of u_i u_j max(0, 1 - w.(x_i - x_j))

Every pair counts in both directions, as the balanced pair set does; the bias of that set is 0
by symmetry. ``u`` is a row's weight: a weight of 2 is the row twice.

*A pass.* For given weights a list is swept once in the order of its scores. For a row of score
``s`` the violating partners are the rows of lower grades scored above ``s - 1`` and those of
higher grades scored below ``s + 1``; running counts per grade give both, so a list of n rows and
L grades costs n log n + n L, not n^2. Loss and subgradient are sums over rows of these counts.

*Lists.* Rows are packed once into blocks of whole lists, one table row each: a pass reads them
without a shuffle. Lists over ``LARGE_LIST`` rows don't fit a block. They are swept in slices: rows
of equal (list, score, grade) are summed first, events are range partitioned by (list, score), and
what earlier slices hold per grade is carried over, a table of slices x grades.

*Solver.* A bundle method. Each pass evaluates several points between the best one so far and the
minimum of the model; each gives a plane under the loss, and the model is their maximum. Its
minimum bounds J from below, so the gap to the best point certifies the result: it stops when the
gap is under ``eps`` of J. Weights, planes and gap are numbers of features and passes, never of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.session import Generations

BLOCK_ROWS = 20_000       # rows of a block of whole lists, about
LARGE_LIST = 20_000       # rows of a list beyond which it is swept in slices
POINTS = (1.0, 0.5, 0.2, 0.05)     # of the way from the best point to the model's minimum
_BELOW, _ROW, _ABOVE = 0, 1, 2     # events at equal scores: the probe at s + 1 first, the probe at s - 1 last


def swept(lists: np.ndarray, s: np.ndarray, grade: np.ndarray, n: np.ndarray, ahead: np.ndarray | None = None,
          total: np.ndarray | None = None, kind: np.ndarray | None = None) -> np.ndarray:
    """Violating partners of each row: (lower-graded ones scored above s - 1, higher-graded ones scored below s + 1).

    ``lists`` numbers the lists from 0, ``grade`` the grades from 0, ``n`` is each row's weight. For a
    slice of a list, ``s`` holds the places of events of the given ``kind``, ``ahead`` (list, grade) what
    lies before the slice and ``total`` (list, grade) what the whole list has."""
    m = len(s)
    if kind is None:
        at = np.concatenate([s + 1.0, s, s - 1.0])
        kind = np.repeat(np.array([_BELOW, _ROW, _ABOVE]), m)
        lists, grade, n = np.tile(lists, 3), np.tile(grade, 3), np.tile(n, 3)
    else:
        at = s
    order = np.lexsort((kind, at, lists))
    ls, ks, gs = lists[order], kind[order], grade[order]
    ns = np.where(ks == _ROW, n[order], 0.0)
    first = np.flatnonzero(np.append(True, ls[1:] != ls[:-1])) if len(ls) else np.zeros(0, np.int64)
    run = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(ls))))
    found = np.zeros(len(ls))
    for g in range(int(grade.max()) + 1 if len(grade) else 0):
        upto = np.cumsum(np.where(gs == g, ns, 0.0))
        before = np.append(0.0, upto)[first]
        here = upto - before[run]
        whole = np.append(upto[first[1:] - 1], upto[-1:]) - before
        if ahead is not None:
            here = here + ahead[ls, g]
            whole = total[ls[first], g]
        found += np.where((ks == _ABOVE) & (gs > g), whole[run] - here, 0.0) + np.where((ks == _BELOW) & (gs < g), here, 0.0)
    out = np.empty(len(ls))
    out[order] = found
    return out


def _sums(s: np.ndarray, x: np.ndarray, n: np.ndarray, lower: np.ndarray, higher: np.ndarray) -> np.ndarray:
    """(loss, subgradient): ``lower`` and ``higher`` count each row's violating partners."""
    net = (higher - lower) * n
    return np.append((lower * n).sum() + net @ s, net @ x)


def _block_pass(points: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(points), points.shape[1] + 1))
        for batch in batches:
            for raw in batch.to_pylist():
                x = np.frombuffer(raw["x"]).reshape(-1, points.shape[1])
                lists, grade, n = (np.frombuffer(raw[k], t) for k, t in (("lists", np.int64), ("grade", np.int64), ("n", np.float64)))
                for k, w in enumerate(points):
                    s = x @ w
                    below, _, above = swept(lists, s, grade, n).reshape(3, -1)
                    total[k] += _sums(s, x, n, above, below)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(points)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["point", "sums"])
    return run


@dataclass(frozen=True)
class Pairs:
    """Rows packed for passes over their pairs."""
    blocks: DataFrame            # one row per block: x, lists, grade, n as arrays of numbers
    large: DataFrame | None      # (list, grade, n, x) of the lists over LARGE_LIST rows
    dim: int
    pairs: float                 # weighted pairs of different grades, each once

    def at(self, points: np.ndarray) -> np.ndarray:
        """(point, 1 + dim): sum of hinge losses and a subgradient at each weight vector."""
        parts = self.blocks.mapInArrow(_block_pass(points), "point int, sums array<double>").collect()
        out = np.zeros((len(points), self.dim + 1))
        for r in parts:                                  # a row per task and point
            out[r["point"]] += np.array(r["sums"])
        if self.large is not None:
            for k, w in enumerate(points):
                out[k] += _large_pass(self.large, w)
        return out


def _large_pass(rows: DataFrame, w: np.ndarray) -> np.ndarray:
    """(loss, subgradient) over lists of any length, by range-partitioned slices."""
    gens = Generations(rows.sparkSession, "hinge-pass")
    d = len(w)
    score = sum((F.lit(float(v)) * F.col("x")[j] for j, v in enumerate(w)), F.lit(0.0))
    cells = rows.withColumn("s", score).groupBy("list", "s", "grade").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("x")[j] * F.col("n")) for j in range(d)]).alias("x"))
    cells = gens.keep(cells)
    event = lambda at, kind: F.struct((F.col("s") + at).alias("at"), F.lit(kind).alias("kind"))
    events = cells.select("*", F.explode(F.array(event(1.0, _BELOW), event(0.0, _ROW), event(-1.0, _ABOVE))).alias("e")).select(
        "list", "grade", "n", "s", "x", F.col("e.at").alias("at"), F.col("e.kind").alias("kind"))
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = gens.keep(events.repartitionByRange(width, "list", "at", "kind").withColumn("slice", F.spark_partition_id()))
    held = sliced.where(F.col("kind") == _ROW).groupBy("list", "slice", "grade").agg(F.sum("n").alias("n")).toPandas()   # slices x grades
    grades = int(held["grade"].max()) + 1

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names, lists = np.unique(pdf["list"].to_numpy(), return_inverse=True)
        mine = int(pdf["slice"].iloc[0])
        ahead, total = np.zeros((len(names), grades)), np.zeros((len(names), grades))
        for k, name in enumerate(names):
            of = held[held["list"] == name]
            np.add.at(total[k], of["grade"].to_numpy(), of["n"].to_numpy())
            of = of[of["slice"] < mine]
            np.add.at(ahead[k], of["grade"].to_numpy(), of["n"].to_numpy())
        kind = pdf["kind"].to_numpy()
        found = swept(lists, pdf["at"].to_numpy(), pdf["grade"].to_numpy(), pdf["n"].to_numpy(), ahead, total, kind)
        s, n, x = pdf["s"].to_numpy(), pdf["n"].to_numpy(), np.stack(pdf["x"].to_numpy())       # x is summed over n already
        lower, higher = np.where(kind == _ABOVE, found, 0.0), np.where(kind == _BELOW, found, 0.0)
        out = np.append((lower * n).sum() + ((higher - lower) * n) @ s, (higher - lower) @ x)
        return pd.DataFrame({"sums": [out]})

    parts = sliced.groupBy("slice").applyInPandas(run, "sums array<double>").collect()           # a row per slice
    gens.close()
    return np.sum([np.array(r["sums"]) for r in parts], axis=0) if parts else np.zeros(d + 1)


def pack(fm: DataFrame, cols: Sequence[str] | str, rel_col: str = "rel", query_col: str = "query_id",
         weight_col: str | None = None, block_rows: int = BLOCK_ROWS, large_list: int = LARGE_LIST) -> Pairs:
    """Rows of ``fm`` packed for passes. ``cols`` are feature columns, or one array column.

    Rows without a grade or a feature make no pair (fill features before); grades are any numbers."""
    gens = Generations(fm.sparkSession, "hinge")
    x = F.col(cols) if isinstance(cols, str) else F.array(*[F.col(c).cast("double") for c in cols])
    weight = F.lit(1.0) if weight_col is None else F.col(weight_col).cast("double")
    rows = fm.select(F.col(query_col).alias("list"), F.col(rel_col).cast("double").alias("rel"), weight.alias("n"), x.alias("x"))
    rows = gens.keep(rows.where(F.col("rel").isNotNull() & (F.col("n") > 0) & ~F.exists("x", lambda v: v.isNull() | F.isnan(v))))
    per = gens.keep(rows.groupBy("list", "rel").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")))
    lists = per.groupBy("list").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"))
    whole = lists.agg(F.sum("rows").alias("rows"), F.sum(F.col("n") * F.col("n") - F.col("nn")).alias("pairs"), F.max("rows").alias("most")).first()
    # Grades numbered from 0 over all lists; a list of a few grades only has few rows of this table.
    grades = sorted(r["rel"] for r in per.select("rel").distinct().collect())
    levels = F.array(*[F.lit(float(g)) for g in grades]) if grades else F.array().cast("array<double>")
    rows = rows.withColumn("grade", (F.array_position(levels, F.col("rel")) - 1).cast("bigint")).drop("rel")
    large = None
    if whole["most"] and whole["most"] > large_list:
        long = gens.keep(lists.where(F.col("rows") > large_list).select("list"))      # one in large_list rows at most
        large = gens.keep(rows.join(long, "list", "left_semi"))
        rows = rows.join(long, "list", "left_anti")
    n_blocks = max(1, -(-(whole["rows"] or 0) // block_rows))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, number = np.unique(pdf["list"].to_numpy(), return_inverse=True)
        raw = lambda a, t: np.ascontiguousarray(a, t).tobytes()
        return pd.DataFrame({"x": [raw(np.stack(pdf["x"].to_numpy()), np.float64)], "lists": [raw(number, np.int64)],
                             "grade": [raw(pdf["grade"].to_numpy(), np.int64)], "n": [raw(pdf["n"].to_numpy(), np.float64)]})

    blocks = (rows.withColumn("block", F.pmod(F.xxhash64("list"), F.lit(n_blocks))).groupBy("block")
              .applyInPandas(run, "x binary, lists binary, grade binary, n binary"))
    first = rows.first() if large is None else large.first()
    return Pairs(gens.keep(blocks), large, len(first["x"]) if first else (1 if isinstance(cols, str) else len(cols)), (whole["pairs"] or 0.0) / 2)


def _model_minimum(slopes: np.ndarray, heights: np.ndarray, steps: int = 100) -> tuple[np.ndarray, float]:
    """w of min |w|^2 / 2 + max_k (slopes_k . w + heights_k), and a lower bound of that minimum.

    Primal-dual interior-point steps on (w, the maximum, one share per plane); each solves a system
    of d unknowns, never singular. Any shares that add up to 1 give a bound, so the bound holds however far the steps came."""
    # In units of the highest plane: |v|^2 / 2 + max(slopes' v + heights'), w = sqrt(unit) v.
    unit = max(1.0, float(np.abs(heights).max()))
    slopes, heights = slopes / np.sqrt(unit), heights / unit
    m, d = slopes.shape
    w, share = np.zeros(d), np.full(m, 1.0 / m)
    slack = 1.0 + heights.max() - heights
    top = heights.max() + 1.0
    low, found = -np.inf, w
    for _ in range(steps):
        mu = share @ slack / m
        off_w = w + slopes.T @ share
        off_t = slack - top + slopes @ w + heights
        off_s = 1.0 - share.sum()
        ratio = share / slack
        # The step of the maximum is taken out: what is left is I + A'A with A the weighted slopes around their mean. By the
        # singular values of A, as A'A would round the I away where many rows share a direction (two equal features).
        if not (np.isfinite(ratio).all() and ratio.sum() > 0):
            break
        mean = slopes.T @ ratio / ratio.sum()
        around = slopes - mean
        _, size, axes = np.linalg.svd(np.sqrt(ratio)[:, None] * around, full_matrices=False)

        def move(target: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
            push = (target - share * slack) / slack + ratio * off_t
            right = -off_w - around.T @ push - off_s * mean
            along = axes @ right
            d_w = right + axes.T @ (along / (1.0 + size ** 2) - along)
            d_top = (push.sum() - off_s) / ratio.sum() + mean @ d_w
            d_slack = d_top - slopes @ d_w - off_t
            return d_w, d_top, d_slack, (target - share * slack - share * d_slack) / slack

        def reach(v: np.ndarray, dv: np.ndarray) -> float:
            return float(min(1.0, (-v[dv < 0] / dv[dv < 0]).min(initial=1e9)))

        _, _, d_slack, d_share = move(np.zeros(m))
        ahead = (share + reach(share, d_share) * d_share) @ (slack + reach(slack, d_slack) * d_slack) / m
        d_w, d_top, d_slack, d_share = move((ahead / mu) ** 3 * mu - d_slack * d_share)
        a = 0.995 * min(reach(share, d_share), reach(slack, d_slack))
        w, top, slack, share = w + a * d_w, top + a * d_top, slack + a * d_slack, share + a * d_share
        if not (np.isfinite(w).all() and np.isfinite(share).all()):
            break
        fair = np.maximum(share, 0.0) / np.maximum(share, 0.0).sum()
        bound = float(heights @ fair - (slopes.T @ fair) @ (slopes.T @ fair) / 2)
        if bound > low:
            low, found = bound, w
        value = w @ w / 2 + (slopes @ w + heights).max()
        if value - low <= 1e-11:
            break
    return found * np.sqrt(unit), low * unit


@dataclass(frozen=True)
class Fit:
    weights: np.ndarray
    objective: float
    gap: float           # objective minus a lower bound of the least objective
    passes: int


def solve(pairs: Pairs, C: float = 1.0, eps: float = 1e-3, max_passes: int = 200, start: np.ndarray | None = None) -> Fit:
    """Weights whose objective is within ``eps`` (relative) of the least one; raises if ``max_passes`` don't reach that."""
    d, scale = pairs.dim, 2.0 * C
    best = np.zeros(d) if start is None else np.asarray(start, float)
    slopes, heights, low = np.zeros((1, d)), np.zeros(1), 0.0          # the loss is never negative
    value, gap = np.inf, np.inf
    points = best[None]
    for done in range(1, max_passes + 1):
        found = pairs.at(points) * scale
        for w, f in zip(points, found):
            slopes = np.vstack([slopes, f[1:]])
            heights = np.append(heights, f[0] - f[1:] @ w)
            if w @ w / 2 + f[0] < value:
                value, best = w @ w / 2 + f[0], w
        w, bound = _model_minimum(slopes, heights)
        low = max(low, bound)                                # planes are only added, so the bound never falls
        gap = value - low
        if gap <= eps * max(value, 1e-12):
            return Fit(best, float(value), float(max(gap, 0.0)), done)
        points = np.array([best + t * (w - best) for t in POINTS])
    raise RuntimeError(f"gap {gap:.3g} of objective {value:.6g} after {max_passes} passes; raise eps or max_passes")


def fit_hinge(fm: DataFrame, cols: Sequence[str], rel_col: str = "rel", C: float = 1.0, eps: float = 1e-3,
              weight_col: str | None = None) -> dict[str, float]:
    """M4: the hinge-loss pairwise ranker by feature name."""
    fit = solve(pack(fm, cols, rel_col, weight_col=weight_col), C, eps)
    return dict(zip(cols, map(float, fit.weights)))
