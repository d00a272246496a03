"""Ordered ``key: value`` lines with their enclosing query and document.

The reference's text formats nest documents inside ``query:`` blocks. Read
as one record per block, a block with millions of results would be one row
and a block continued in the next part file would lose its header. Here
every line stays a row:

1. each line gets a global order key (file, split start, position in split);
2. ``repartitionByRange`` on that key gives contiguous slices; a vectorised
   forward fill per slice (``mapInPandas``) tags each line with the global
   position of the last ``query:`` line and of the last document-opening
   line (``url:``) after it;
3. lines before a slice's first header inherit the state at the end of the
   earlier slices, from a table with one row per slice (bounded by the
   partition count, broadcast).

Result: (gpos, q_id, query, d_id, key, val), where ``q_id`` / ``d_id`` are
the global positions of the query line and of the document's opening line.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordo.operators.sizing import broadcast_if_small

_SHIFT = 40   # gpos = slice << 40 | position in slice


def _fill(doc_key: str):
    """mapInPandas body: vectorised forward fill of the query / document state
    over a sorted slice, carrying the state from one Arrow batch to the next."""
    def run(batches):
        pos = 0
        q = qt = d = None
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            pid = int(pdf["_pid"].iloc[0])
            gpos = pd.Series((np.int64(pid) << _SHIFT) + np.arange(pos, pos + n, dtype=np.int64))
            pos += n
            is_q = (pdf["key"] == "query").reset_index(drop=True)
            is_d = (pdf["key"] == doc_key).reset_index(drop=True)
            vals = pdf["val"].reset_index(drop=True).astype("string")
            own_q = gpos.where(is_q).astype("Int64").ffill()
            own_qt = vals.where(is_q).ffill()
            lead = own_q.isna()
            if q is not None:
                own_q[lead] = q
                own_qt[lead] = qt
            # the document state restarts (-1) at every query line
            dm = gpos.where(is_d, other=np.int64(-1)).astype("Int64").where(is_d | is_q).ffill()
            lead_d = dm.isna()
            if d is not None:
                dm[lead_d] = d
            own_d = dm.mask(dm == -1)
            q = None if pd.isna(own_q.iloc[-1]) else int(own_q.iloc[-1])
            qt = None if q is None else own_qt.iloc[-1]
            d = None if pd.isna(own_d.iloc[-1]) else int(own_d.iloc[-1])
            out = pdf.drop(columns=["_pid"]).reset_index(drop=True)
            out["gpos"] = gpos
            out["own_q"] = own_q
            out["own_qt"] = own_qt
            out["own_d"] = own_d
            yield out
    return run


def read_ordered_lines(spark: SparkSession, path: str, doc_key: str = "url",
                       num_partitions: int | None = None, all_lines: bool = False) -> DataFrame:
    """Lines with a key, tagged. With ``all_lines`` blank lines and lines without a key stay in
    (their key is NULL), and each line also has its ``file`` and its text, ``value``."""
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    raw = spark.read.text(path).select(
        F.input_file_name().alias("_f"), F.input_file_block_start().alias("_s"),
        F.monotonically_increasing_id().alias("_m"), "value")
    has_key = F.instr("value", ":") > 0
    kv = raw.select("_f", "_s", "_m",
                    F.when(has_key, F.lower(F.trim(F.substring_index("value", ":", 1)))).alias("key"),
                    F.trim(F.expr("substr(value, instr(value, ':') + 1)")).alias("val"),
                    *(["value"] if all_lines else []))
    if not all_lines:
        kv = kv.filter(F.col("key").isNotNull())             # sources.quarantine reports the others
    order = ["_f", "_s", "_m"]
    sliced = (kv.repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("_pid", F.spark_partition_id()))
    schema = T.StructType([f for f in sliced.schema.fields if f.name != "_pid"] + [
        T.StructField("gpos", T.LongType()), T.StructField("own_q", T.LongType()),
        T.StructField("own_qt", T.StringType()), T.StructField("own_d", T.LongType())])
    filled = sliced.mapInPandas(_fill(doc_key), schema)
    # slice ends must come from these very slices (see ranking._range_rank)
    if spark.conf.get("spark.sql.exchange.reuse", "true").lower() != "true":
        from ordo.session import materialize
        filled = materialize(filled)
    # state at the end of each slice: its last query line and the last
    # document line that follows that query line (or, with no query line in
    # the slice, the last document line of the slice)
    slice_id = F.shiftright(F.col("gpos"), _SHIFT)
    ends = filled.groupBy(slice_id.alias("sl")).agg(
        F.max(F.when(F.col("key") == "query", F.col("gpos"))).alias("lq"),
        F.max_by(F.col("own_qt"), F.when(F.col("key") == "query", F.col("gpos"))).alias("lqt"),
        F.max(F.when(F.col("key") == doc_key, F.col("gpos"))).alias("ld"))
    # running maxima over the slices before; the table has one row per slice
    earlier = Window.orderBy("sl").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(F.col("sl").alias("a_sl"), F.max("lq").over(earlier).alias("cq"),
                        F.max(F.when(F.col("lq").isNotNull(), F.struct("lq", "lqt"))).over(earlier)["lqt"].alias("cqt"),
                        F.max("ld").over(earlier).alias("cd"))
    carry = carry.withColumn("cd", F.when(F.col("cd") > F.coalesce(F.col("cq"), F.lit(-1)), F.col("cd")))
    j = filled.join(broadcast_if_small(carry, n), slice_id == F.col("a_sl"), "left")
    before_header = F.col("own_q").isNull()
    source = [F.col("_f").alias("file"), F.col("value")] if all_lines else []
    return j.select(
        "gpos", "key", "val", *source,
        F.coalesce("own_q", "cq").alias("q_id"),
        F.when(before_header, F.col("cqt")).otherwise(F.col("own_qt")).alias("query"),
        F.when(before_header, F.coalesce("own_d", "cd")).otherwise(F.col("own_d")).alias("d_id"))
