"""Saving and loading fitted rankers.

Spark ML models use their own persistence (``write().overwrite().save``);
the pairwise linear ranker is a ``(feature, coef)`` table and a kernel model
an ``sv(coef, vec)`` table plus ``rho``, both stored as parquet, so a model
is read back by any executor rather than shipped from the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_ml_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_linear_regression(path: str):
    from pyspark.ml.regression import LinearRegressionModel
    return LinearRegressionModel.load(path)


def save_weights(spark: SparkSession, weights: dict[str, float], path: str) -> None:
    spark.createDataFrame(sorted(weights.items()), "feature string, coef double") \
        .coalesce(1).write.mode("overwrite").parquet(path)


def load_weights(spark: SparkSession, path: str) -> dict[str, float]:
    # a weight table has one row per feature (bounded by the feature count)
    return {r["feature"]: r["coef"] for r in spark.read.parquet(path).collect()}


def save_svm(sv: DataFrame, rho: float, path: str) -> None:
    sv.select("coef", "vec").withColumn("rho", F.lit(float(rho))).write.mode("overwrite").parquet(path)


def load_svm(spark: SparkSession, path: str) -> tuple[DataFrame, float]:
    t = spark.read.parquet(path)
    rho = t.select("rho").first()
    return t.select("coef", "vec"), (rho["rho"] if rho else 0.0)
