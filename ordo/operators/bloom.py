"""Bloom filter over 64-bit hashes, built by aggregation and tested before a shuffle.

The filter is an array of ``n_bits / 64`` longs. Bits set by different rows meet in ``bit_or`` with
map-side combining, and two filters of one size merge by ``bit_or`` as well. ``might_hold`` reads it
as a scalar subquery, so it reaches every task once and the test stays inside generated code.

A filter never says no to a hash that it holds; ``bits_for`` sizes it for about 0.3 % of false
hits. Its size is bounded by ``MAX_BITS`` whatever the data: beyond about 8 million hashes more false
hits pass, which the join that follows throws out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_EACH = 16
MIN_BITS = 1 << 10
MAX_BITS = 1 << 27          # 16 MB
SHIFTS = (0, 13, 26, 37)    # the bits of a hash that its places are taken from start here


def bits_for(n_hashes: int) -> int:
    """A power of two with about ``BITS_EACH`` bits a hash, inside the bounds."""
    return max(MIN_BITS, min(MAX_BITS, 1 << (n_hashes * BITS_EACH).bit_length()))


def _places(h: Column, n_bits: int) -> list[Column]:
    return [F.shiftrightunsigned(h, s).bitwiseAND(F.lit(n_bits - 1).cast("bigint")) for s in SHIFTS]


def _words(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def build(hashes: DataFrame, hash_col: str, n_bits: int) -> DataFrame:
    """One row, one column ``filter``: array<bigint> of ``n_bits / 64`` words. Null hashes set nothing."""
    if n_bits < 64 or n_bits & (n_bits - 1):
        raise ValueError("n_bits is a power of two of 64 or more")
    place = hashes.where(F.col(hash_col).isNotNull()).select(F.explode(F.array(*_places(F.col(hash_col), n_bits))).alias("p"))
    one = F.expr("shiftleft(1L, CAST(p % 64 AS INT))")
    found = _words(place.select(F.floor(F.col("p") / 64).alias("word"), one.alias("bits")))
    every = hashes.sparkSession.range(n_bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = _words(found.unionByName(every))
    return words.agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("filter"))


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The filter of both inputs' hashes; both have one size."""
    words = a.unionByName(b).select(F.posexplode("filter").alias("word", "bits"))
    return _words(words).agg(F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("filter"))


def might_hold(filters: DataFrame, h: Column, n_bits: int) -> Column:
    """False only for hashes that the one-row table ``filters`` (of ``build``) doesn't hold."""
    words = filters.select("filter").scalar()
    hit = F.lit(True)
    for p in _places(h, n_bits):
        hit = hit & (F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63).cast("bigint")).cast("int")) == 1)
    return hit
