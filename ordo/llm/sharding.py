"""Sharding through fixed virtual slots and a versioned slot map, DataFrame functions only.

A record hashes into one of ``n_slots`` virtual slots; that never changes. Bytes and
rows are summed up per slot, and a ``SlotMap`` says which shard holds each slot. A
first map gives the largest slots first, each to the lightest shard. Rebalancing
edits the map: it moves the fewest bytes that bring all shards to the mean and raises
the version. The map has ``n_slots`` entries whatever the input, so that is what
travels through the driver.

Law of the placement: ``bytes`` (shard sizes near equal).

A slot is the hash of id and text. Rows that are equal in both have no hash to tell them
apart; they are dealt over all slots in turn, so that one record on a third of the rows
loads no slot. So shards differ by one slot of distinct records at most, or by one record
where that is larger.

Edge cases: null text has no bytes (a record still takes ``OVERHEAD``); a null id
hashes by its text; an empty table gives an empty table and a map that deals slots out
evenly.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ordo.llm.common import materialize
from ordo.operators.sizing import broadcast_if_small

N_SLOTS = 4096
FEW_KEYS = 200_000             # repeated keys (16 bytes each) that may be broadcast
OVERHEAD = 8


@dataclass(frozen=True)
class SlotMap:
    version: int
    n_shards: int
    shard_of: tuple[int, ...]      # by slot

    @staticmethod
    def build(slot_bytes: list[int], n_shards: int) -> SlotMap:
        """Largest slot first, each to the lightest shard (fewest slots, then lowest number, on ties)."""
        load = [(0, 0, s) for s in range(n_shards)]
        shard_of = [0] * len(slot_bytes)
        for slot in sorted(range(len(slot_bytes)), key=lambda k: (-slot_bytes[k], k)):
            size, held, shard = heapq.heappop(load)
            shard_of[slot] = shard
            heapq.heappush(load, (size + slot_bytes[slot], held + 1, shard))
        return SlotMap(1, n_shards, tuple(shard_of))

    def rebalance(self, slot_bytes: list[int], n_shards: int | None = None) -> SlotMap:
        """The next version: slots leave shards over the mean (or shards that go) for the
        lightest shard, largest first, while that lowers the larger of the two loads."""
        n = n_shards or self.n_shards
        shard_of = list(self.shard_of)
        load = [0] * n
        loose = []
        for slot, shard in enumerate(shard_of):
            if shard < n:
                load[shard] += slot_bytes[slot]
            else:
                loose.append(slot)
        mean = sum(slot_bytes) / n
        for slot in sorted(range(len(shard_of)), key=lambda k: (-slot_bytes[k], k)):
            shard = shard_of[slot]
            if shard < n and load[shard] - slot_bytes[slot] >= mean:
                load[shard] -= slot_bytes[slot]
                loose.append(slot)
        for slot in sorted(loose, key=lambda k: (-slot_bytes[k], k)):
            shard = min(range(n), key=lambda s: (load[s], s))
            shard_of[slot] = shard
            load[shard] += slot_bytes[slot]
        return SlotMap(self.version + 1, n, tuple(shard_of))

    def moved(self, later: SlotMap) -> list[int]:
        return [k for k, (a, b) in enumerate(zip(self.shard_of, later.shard_of)) if a != b]

    def frame(self, spark: SparkSession) -> DataFrame:
        """(version, n_shards, slot, shard), one row per slot."""
        return spark.range(len(self.shard_of)).select(
            F.lit(self.version).alias("version"), F.lit(self.n_shards).alias("n_shards"),
            F.col("id").cast("int").alias("slot"), by_slot(self.shard_of, F.col("id")).cast("int").alias("shard"))

    def save(self, spark: SparkSession, path: str) -> None:
        """Append this version to the map table at ``path``; earlier versions stay readable."""
        self.frame(spark).coalesce(1).write.mode("append").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, the newest by default."""
        stored = spark.read.parquet(path)
        if version is None:
            version = stored.agg(F.max("version")).first()[0]
        rows = stored.where(F.col("version") == version).orderBy("slot").collect()
        if not rows:
            raise ValueError(f"no version {version} of the slot map at {path}")
        return SlotMap(version, rows[0]["n_shards"], tuple(r["shard"] for r in rows))


def by_slot(values: list[int] | tuple[int, ...], slot: Column) -> Column:
    """``values[slot]`` as bigint; the bounded table travels as one folded literal."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ","), slot.cast("int")).cast("bigint")


def slot_of(id_col: Column, text: Column, n_slots: int = N_SLOTS) -> Column:
    """The slot of a record that no other one equals."""
    return F.pmod(F.xxhash64(id_col, text), F.lit(n_slots)).cast("int")


def dealt(rows: DataFrame, n_slots: int) -> DataFrame:
    """``rows`` (key, turn, vslot, ...) with the slots of records that repeat a key dealt by their ``turn``."""
    several = materialize(rows.groupBy("key").count().where("count > 1").select("key", F.lit(True).alias("several")))
    if several.isEmpty():
        return rows
    few = broadcast_if_small(several, bound_rows=several.count(), max_rows=FEW_KEYS)
    return rows.join(few, "key", "left").withColumn("vslot", F.when(
        F.col("several"), F.pmod(F.xxhash64("turn"), F.lit(n_slots)).cast("int")).otherwise(F.col("vslot"))).drop("several")


def slot_loads(records: DataFrame, n_slots: int) -> tuple[list[int], list[int]]:
    """Bytes and rows by slot, from a frame with ``vslot`` and ``size`` (``n_slots`` rows at most)."""
    size, rows = [0] * n_slots, [0] * n_slots
    for r in records.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():
        size[r["vslot"]], rows[r["vslot"]] = r["b"], r["n"]
    return size, rows


def records(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, key, turn) of each row: ``key`` stands for id and text, ``turn`` tells equal rows apart."""
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return df.select(key.alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("bigint").alias("size"),
                     F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), slot_of(key, text, n_slots).alias("vslot"),
                     F.xxhash64(key, text).alias("key"), F.monotonically_increasing_id().alias("turn"))


def place(df: DataFrame, n_shards: int = 24, slot_map: SlotMap | None = None, id_col: str = "doc_id",
          text_col: str = "text", n_slots: int = N_SLOTS, map_path: str | None = None) -> DataFrame:
    """Shard and position of each row: doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version.

    ``slot`` is the row's place in its shard, gapless from 0: rows are numbered inside
    their virtual slot (thousands of groups), and each virtual slot starts where the
    one before it in the same shard ends. With ``map_path`` the map in use is stored there
    as its version, and placement reads it back."""
    rows = materialize(dealt(materialize(records(df, id_col, text_col, n_slots)), n_slots))
    size, count = slot_loads(rows, n_slots)
    slot_map = slot_map or SlotMap.build(size, n_shards)
    if map_path:
        slot_map.save(df.sparkSession, map_path)
        slot_map = SlotMap.load(df.sparkSession, map_path, slot_map.version)
    start, filled = [0] * n_slots, [0] * slot_map.n_shards
    for k, shard in enumerate(slot_map.shard_of):
        start[k] = filled[shard]
        filled[shard] += count[k]
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size"))
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        by_slot(slot_map.shard_of, F.col("vslot")).cast("int").alias("shard"),
        (by_slot(start, F.col("vslot")) + rank - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        "vslot", F.lit(slot_map.version).alias("map_version"))


def write_shards(df: DataFrame, slot_map: SlotMap, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole rows under ``path/shard=<n>/``. Rows go to tasks by virtual slot, so a
    shard is written by many tasks. Equal rows are dealt in turn, as ``place`` deals them; which of
    them goes where may differ."""
    n = len(slot_map.shard_of)
    own = {c: f"_{c}_{uuid.uuid4().hex}" for c in ("key", "turn", "vslot")}      # names that no column of df has
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    several = df.groupBy(F.xxhash64(key, text).alias(own["key"])).count().where("count > 1").select(own["key"], F.lit(True).alias(own["turn"]))
    few = broadcast_if_small(several, bound_rows=several.count(), max_rows=FEW_KEYS)
    slot = F.when(F.col(own["turn"]), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")).otherwise(slot_of(key, text, n))
    rows = df.withColumn(own["key"], F.xxhash64(key, text)).join(few, own["key"], "left").withColumn(own["vslot"], slot)
    (rows.withColumn("shard", by_slot(slot_map.shard_of, F.col(own["vslot"])).cast("int")).repartition(own["vslot"])
     .drop(*own.values()).write.mode("overwrite").partitionBy("shard").parquet(path))
