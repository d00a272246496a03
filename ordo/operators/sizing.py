"""Size checks that gate broadcasts and plan choices.

A side is broadcast only when a *proven* bound on its row count is below a
limit; the bound is computed from a cheap source (a parquet row count, the
number of partitions, a literal parameter), never by materialising the side
twice. Beyond the limit the join stays a shuffled join and AQE decides at
runtime from real statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows a broadcast side may hold (a few hundred bytes each -> well under the
# 8 GiB broadcast hard limit and small enough to ship to 1000 executors).
MAX_BROADCAST_ROWS = 2_000_000


def broadcast_if_small(df: DataFrame, bound_rows: int | None = None,
                       max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` when ``bound_rows`` (an upper bound on its rows) is small.

    With no bound given the hint is left to AQE, which broadcasts at runtime
    from measured shuffle sizes (``spark.sql.adaptive.autoBroadcastJoinThreshold``).
    """
    if bound_rows is not None and bound_rows <= max_rows:
        return F.broadcast(df)
    return df


def row_count(df: DataFrame) -> int:
    """Row count of a *scan* (parquet answers from footers); do not call on derived plans."""
    return df.count()


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Round-robin a scan over all cores when it has fewer input partitions
    than the default parallelism (few large row groups), before CPU-heavy
    per-row work such as tokenising. On a cluster reading many files the
    input splits already outnumber the cores and this is a no-op. The probe
    plans the scan once per ``key`` (the table path); no file list is pulled
    to the driver."""
    want = df.sparkSession.sparkContext.defaultParallelism
    memo = (key, want)
    if key is None or memo not in _SPLITS:
        _SPLITS[memo] = df.rdd.getNumPartitions()
    if _SPLITS[memo] < want:
        return df.repartition(want)
    return df


_SPLITS: dict = {}   # (table path, parallelism) -> number of scan partitions
