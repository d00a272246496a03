"""Train, rank and evaluate compositions (the three tasks).

task 1  pointwise linear regression on the five tf-idf features;
task 2  pairwise linear ranker on standardised features (pair moments, M3/M4);
task 3  task 2 plus the extras (smallest-window score, is_pdf, has_tilda),
        missing values mean-imputed first; ``kernel=True`` adds the random
        Fourier map (M5) before the pairwise fit.

Statistics (means, deviations, model weights) are fitted on the training
frame and applied unchanged to the test frame. Ranking is the pointwise
window rank of the model score; for a linear pairwise model that order is
the comparator's order (R2), so no document pairs are formed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.operators import scale
from ordo.operators.matrix import DEFAULT_EXTRAS, feature_matrix, feature_names, linear_score, rank_pointwise
from ordo.operators.metrics import judged_rows, mean_ndcg, ndcg_per_query
from ordo.operators.folds import fold_moments, regression
from ordo.operators.models import fit_pairwise, rff_columns
from ordo.session import materialize


@dataclass
class RankResult:
    ranked: DataFrame        # query_id, doc_pos, score, rank
    per_query: DataFrame     # query_id, n, dcg, idcg, ndcg
    mean: DataFrame          # n_queries, mean_ndcg
    weights: dict


def _evaluate(scored: DataFrame, rels: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    ranked = rank_pointwise(scored)
    j = judged_rows(ranked, rels, ["query_id", "doc_pos"])
    per = ndcg_per_query(j, ["query_id"], [F.col("score").desc_nulls_last(), F.col("doc_pos")])
    return ranked, per, mean_ndcg(per, ranked_queries=ranked)


@dataclass
class Fitted:
    """A fitted task: what ``apply`` needs, all of it a few numbers per feature."""
    extras: tuple
    fill: dict               # A9 means of the training rows
    stats: dict | None       # scaler of the training rows (pairwise tasks)
    rff: tuple | None        # (components, gamma, seed) of the kernel map
    weights: dict
    intercept: float = 0.0


def check_judged(train: DataFrame, rels: DataFrame) -> None:
    """Every training row needs a judgement; raises with the first that has none."""
    missing = train.join(rels.select("query_id", "doc_pos"), ["query_id", "doc_pos"], "left_anti").select("query_id", "doc_pos")
    row = missing.first()
    if row is not None:
        raise ValueError(f"no judgement for training row query_id={row['query_id']}, doc_pos={row['doc_pos']}")


def _features(fitted: Fitted, fm: DataFrame, keep: tuple[str, ...]) -> tuple[DataFrame, list[str]]:
    cols = feature_names(fitted.extras)
    fm = fm.fillna(fitted.fill)
    if fitted.stats is not None:
        fm = scale.apply_standardizer(fm, fitted.stats)
    if fitted.rff is None:
        return fm, cols
    n, gamma, seed = fitted.rff
    return fm.select(*keep, *rff_columns(cols, n, gamma, seed)), [f"rff_{k}" for k in range(n)]


def fit(task: int, train: DataFrame, train_rels: DataFrame, idf: DataFrame, kernel: bool = False, n_components: int = 16,
        gamma: float = 0.125, seed: int = 1, C: float = 1.0, loss: str = "squares", eps: float = 1e-3, queries: DataFrame | None = None) -> Fitted:
    """Task 1, 2 or 3 fitted on the training lists; ``loss`` of the pairwise tasks is "squares" or "hinge".

    ``queries`` (query_id, query) saves a second pass over the lists for their queries."""
    extras = DEFAULT_EXTRAS if task == 3 else ()
    cols = feature_names(extras)
    fm = materialize(feature_matrix(train, idf, extras=extras, queries=queries).join(
        train_rels.select("query_id", "doc_pos", "rel"), ["query_id", "doc_pos"]))
    fill = {c: (m if m is not None else 0.0) for c, m in scale.fit_means(fm, cols).items()}     # A9
    if task == 1:
        whole = fold_moments(fm.withColumn("fold", F.lit(0)), cols, "rel")
        if not whole:
            raise ValueError("no judged training row")
        model = regression(whole[0])
        return Fitted(extras, fill, None, None, dict(zip(cols, map(float, model.weights))), model.intercept)
    out = Fitted(extras, fill, scale.fit_standardizer(fm.fillna(fill), cols), (n_components, gamma, seed) if kernel else None, {})
    z, use = _features(out, fm, ("query_id", "doc_pos", "rel"))
    out.weights = fit_pairwise(z, use, "rel", C, loss, eps)
    return out


def apply(fitted: Fitted, test: DataFrame, test_rels: DataFrame | None, idf: DataFrame, queries: DataFrame | None = None) -> RankResult:
    """Rank the test lists; with judgements also NDCG."""
    fm = materialize(feature_matrix(test, idf, extras=fitted.extras, queries=queries))
    z, _ = _features(fitted, fm, ("query_id", "doc_pos"))
    # Rounded, so that equal features tie whatever the order of the additions was.
    scored = z.withColumn("score", F.round(linear_score(fitted.weights) + F.lit(fitted.intercept), 9))
    rels = test_rels if test_rels is not None else test.select("query_id", "doc_pos", F.lit(None).cast("double").alias("rel")).where(F.lit(False))
    ranked, per, mean = _evaluate(scored, rels)
    return RankResult(ranked, per, mean, {**fitted.weights, "intercept": fitted.intercept} if fitted.stats is None else fitted.weights)


def task1(train: DataFrame, train_rels: DataFrame, test: DataFrame, test_rels: DataFrame,
          idf: DataFrame, queries: DataFrame | None = None) -> RankResult:
    return apply(fit(1, train, train_rels, idf, queries=queries), test, test_rels, idf, queries)


def task2(train, train_rels, test, test_rels, idf, loss: str = "squares", queries=None) -> RankResult:
    return apply(fit(2, train, train_rels, idf, loss=loss, queries=queries), test, test_rels, idf, queries)


def task3(train, train_rels, test, test_rels, idf, kernel: bool = False, loss: str = "squares", queries=None) -> RankResult:
    return apply(fit(3, train, train_rels, idf, kernel=kernel, loss=loss, queries=queries), test, test_rels, idf, queries)


def save(spark, fitted: Fitted, path: str) -> None:
    """A fitted task as one JSON row under ``path``: a few numbers per feature, exact (``float.hex``)."""
    hexed = lambda v: None if v is None else {k: (list(map(float.hex, x)) if isinstance(x, (tuple, list)) else float(x).hex()) for k, x in v.items()}
    stats = None if fitted.stats is None else {c: [None if v is None else float(v).hex() for v in ms] for c, ms in fitted.stats.items()}
    value = json.dumps({"extras": list(fitted.extras), "fill": hexed(fitted.fill), "stats": stats,
                        "rff": None if fitted.rff is None else [fitted.rff[0], float(fitted.rff[1]).hex(), fitted.rff[2]],
                        "weights": hexed(fitted.weights), "intercept": float(fitted.intercept).hex()})
    spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load(spark, path: str) -> Fitted:
    """The task that ``save`` wrote; ranks as the one that was saved."""
    found = json.loads(spark.read.text(path).first()["value"])
    back = lambda v: {k: float.fromhex(x) for k, x in v.items()}
    stats = None if found["stats"] is None else {c: tuple(None if v is None else float.fromhex(v) for v in ms) for c, ms in found["stats"].items()}
    rff = None if found["rff"] is None else (found["rff"][0], float.fromhex(found["rff"][1]), found["rff"][2])
    return Fitted(tuple(found["extras"]), back(found["fill"]), stats, rff, back(found["weights"]), float.fromhex(found["intercept"]))
