"""Column scaling over a feature matrix: A3 z-score, A9 mean imputation, A10 min-max
and nominal-to-binary encoding.

Each is one global aggregate (map-side partial aggregation, a handful of
numbers back to the driver) followed by a projection with those numbers as
literals: no join, no second shuffle. The statistics can be fitted on one
frame (training) and applied to another (test), the ``scaler='train'``
choice; ``fit`` + ``apply`` keep them explicit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fit_standardizer(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """A3 statistics: mean and sample standard deviation per column (NULLs ignored)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in cols}


def apply_standardizer(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a zero (or undefined) std only subtracts the mean."""
    out = df
    for c, (m, s) in stats.items():
        centred = F.col(c) - F.lit(m if m is not None else 0.0)
        out = out.withColumn(c, centred / F.lit(s) if s not in (None, 0.0) and s == s else centred)
    return out


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    return apply_standardizer(df, fit_standardizer(fit_on if fit_on is not None else df, cols))


def fit_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """A9 statistics: mean of the present values (NULL and NaN are missing)."""
    row = df.agg(*[F.avg(F.when(~F.isnan(F.col(c)), F.col(c))).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def impute_mean(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Replace missing values by the column mean (as a mean ``Imputer`` does)."""
    means = fit_means(fit_on if fit_on is not None else df, cols)
    out = df
    for c, m in means.items():
        out = out.withColumn(c, F.when(F.col(c).isNull() | F.isnan(F.col(c)), F.lit(m)).otherwise(F.col(c)))
    return out


def minmax(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """A10: (x - min) / (max - min) into [0, 1]; a constant column maps to 0.5."""
    src = fit_on if fit_on is not None else df
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    row = src.agg(*aggs).first()
    out = df
    for c in cols:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if lo is None or hi is None or hi == lo:
            out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.lit(0.5)))
        else:
            out = out.withColumn(c, (F.col(c) - F.lit(lo)) / F.lit(hi - lo))
    return out


def nominal_to_binary(df: DataFrame, col: str, out_prefix: str | None = None) -> DataFrame:
    """A10: one 0/1 column per category of a nominal column (``StringIndexer``
    + ``OneHotEncoder`` without dropping a level). The category list is the
    fitted indexer's label array — one entry per distinct value."""
    from pyspark.ml.feature import OneHotEncoder, StringIndexer
    from pyspark.ml.functions import vector_to_array
    prefix = out_prefix or f"{col}_"
    idx = StringIndexer(inputCol=col, outputCol="_idx", stringOrderType="alphabetAsc",
                        handleInvalid="keep").fit(df)
    enc = OneHotEncoder(inputCols=["_idx"], outputCols=["_oh"], dropLast=False).fit(idx.transform(df))
    out = enc.transform(idx.transform(df)).withColumn("_arr", vector_to_array("_oh"))
    for i, label in enumerate(idx.labels):
        out = out.withColumn(f"{prefix}{label}", F.col("_arr")[i])
    return out.drop("_idx", "_oh", "_arr")


def nominal_dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, idx): the distinct values of a column numbered from 0 in their order. A column
    of any number of values is numbered by many tasks; nothing goes to the driver."""
    from ordo.operators.ranking import group_rank
    values = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.lit(0).alias("_all"))
    ranked = group_rank(values, ["_all"], [F.col("value")], "_r", strategy="range")
    return ranked.select("value", (F.col("_r") - 1).alias("idx"))


def nominal_vectors(df: DataFrame, col: str, out_col: str, dictionary: DataFrame | None = None) -> DataFrame:
    """A10: ``out_col``, a sparse 0/1 vector with one place per value of ``col``.

    The plan has one join and one projection for any number of values. NULL, and a value that
    the ``dictionary`` (of the training rows, say) doesn't have, give a vector of zeros. Values
    that half the rows share are left to AQE's skew join: the dictionary has each value once."""
    import uuid
    from pyspark.ml.feature import OneHotEncoder
    from ordo.session import materialize
    tag = uuid.uuid4().hex
    words = materialize(nominal_dictionary(df, col) if dictionary is None else dictionary)
    if words.isEmpty():
        raise ValueError(f"column {col!r} has no values to encode")
    place = f"_i{tag}"
    coded = df.join(words.select(F.col("value").alias(f"_v{tag}"), F.col("idx").alias(place)), F.col(col) == F.col(f"_v{tag}"), "left")
    # An index past the last value is the encoder's invalid category, which dropLast makes all zeros.
    size = words.agg(F.max("idx")).first()[0] + 1
    coded = coded.withColumn(place, F.coalesce(F.col(place), F.lit(size)).cast("double"))
    enc = OneHotEncoder(inputCols=[place], outputCols=[out_col], handleInvalid="keep", dropLast=True)
    model = enc.fit(words.select(F.col("idx").cast("double").alias(place)))
    return model.transform(coded).drop(place, f"_v{tag}")
