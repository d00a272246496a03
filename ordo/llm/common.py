"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordo.session import materialize

__all__ = ["byte_slices", "documents", "let", "materialize", "prefix_sums", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Spark re-evaluates an outer expression for every element when it stands
    inside a lambda; a one-element ``transform`` binds it to a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(values: Column, block: int = 256) -> Column:
    """Inclusive running sums of an ``array<bigint>``, in about ``n * block / 2`` steps.

    Appending to one array copies it each time, so sums run inside blocks and
    a short array of block totals carries between them. An empty or null array
    gives an empty array."""
    zero = F.lit(0).cast("bigint")
    empty = F.array().cast("array<bigint>")
    append = lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), zero) + x))

    def sums(arr: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(arr) - 1) / block).cast("int")),
                            lambda b: F.slice(arr, b * block + 1, F.lit(block)))

        def joined(blocks: Column) -> Column:
            local = F.transform(blocks, lambda p: F.aggregate(p, empty, append))
            totals = F.transform(blocks, lambda p: F.aggregate(p, zero, lambda a, x: a + x))
            carry = let(totals, lambda t: F.aggregate(t, empty, append))
            return let(F.struct(local.alias("l"), carry.alias("c")), lambda s: F.flatten(F.transform(
                s["l"], lambda p, b: let(F.when(b == 0, zero).otherwise(F.get(s["c"], b - 1)),
                                         lambda base: F.transform(p, lambda x: x + base)))))
        return let(parts, joined)

    return F.when(F.size(values) > 0, let(values, sums)).otherwise(empty)


def byte_slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices whose ``column`` (string or binary) ends with the row that passes ``most`` bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto, low = np.cumsum(sizes, dtype=np.int64), 0
        while low < batch.num_rows:
            high = min(batch.num_rows, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + most)) + 1)
            yield batch.slice(low, high - low)
            low = high
