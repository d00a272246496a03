"""Exact top-k inner products without random access.

Vectors become integers, floor(256 * x). Candidates stand in blocks; each block keeps one
sorted list per dimension. Lists are read from the top, a stretch at a time: from the
largest value for a query component above 0, from the smallest for one below. Where the
reading stands, the last value of a list (its frontier) bounds all values not yet seen.
So a candidate's score lies between two sums: seen products plus the least the unseen
ones can be, and seen products plus frontiers. Reading stops for a query when its bar,
the best k-th score known, is above the upper bound of all but a few candidates; those
get their final scores, and ties at the bar stay in. A block whose heads alone stay under
the bar is not read at all.

Lists of large query components are read deeper than those of small ones: the four
quarters of the dimensions by size are read ``SPREAD`` of a list apart.

A vector belongs to the nearest of at most ``PIVOTS`` sampled vectors. Blocks hold vectors
of one such cell, so that close vectors give narrow lists. A query first reads one block of
its own cell, the one with its own part number; the k-th score there is its bar in all others. Cells of any size are cut
into blocks by a number given to each row, so repeated ids and equal vectors spread.

Seen values of a list are those on the near side of its frontier, so upper bounds of all
queries and candidates of a block are matrix products with clamped values, one for each
depth in use, and lower bounds are the same with unseen values replaced by the list's far
end. This costs more arithmetic than the plain product; ``entries_read`` tells how much of
the lists was read.

Query blocks meet candidate blocks in a grid, through an equi-join on the query block and a
strip of about ``STRIP`` candidate blocks, so that no task holds all candidates of a query
block; queries grow with the data, so they are never broadcast. A candidate block is shipped
once for every ``QUERIES`` queries, a query block once for every strip. Each pair of blocks gives at most k rows a query, none under its bar,
and a bounded ranking per query merges them.

Edge cases: vectors that are null, hold null or non-finite components, or have no id take
no part; vectors of another dimension than the query's are no candidates of it; with fewer
than k candidates all are listed; equal scores go to the smaller id; a repeated id takes
part as often as it stands, but never against itself; an empty table gives an empty
table. Sums are exact while all partial sums stay under 2^53; beyond that they are
computed as whole numbers of any size, and a score over 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordo.llm.common import materialize

K = 5
CANDIDATES = 4096         # vectors of a candidate block, about
QUERIES = 4096            # vectors of a query block, about
SLICE = 512               # queries of a block that are bounded together
PIVOTS = 256              # cells at most
PER_PIVOT = 512           # vectors that one cell is worth
STAGES = (0.25, 0.5, 0.625, 0.75, 1.0)     # mean share of the lists that has been read
SPREAD = 0.25             # how much deeper and shallower the outer quarters are read
FEW = 64                  # outsiders a query may resolve instead of reading on, or
FEW_SHARE = 0.125         # this share of the block
STRIP = 8                 # candidate blocks that meet one copy of a query block, about
MOST_TASKS = 20000        # tasks of the join of blocks at most
LOWEST = -(1 << 62)       # bar of a query that has none

FOUND = "q_row bigint, query_id bigint, vec_id bigint, score bigint, entries bigint, of bigint"


def bounds(q: np.ndarray, c: np.ndarray, lists: np.ndarray, depth: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper score bounds (queries x candidates) after ``depth`` values of each list.

    ``lists`` has each dimension's values in rising order; ``depth`` is one number or one
    per query and dimension."""
    depth = np.broadcast_to(np.asarray(depth), q.shape)
    lower, upper = np.zeros((len(q), len(c))), np.zeros((len(q), len(c)))
    far_low, far_top = lists[0], lists[-1]
    for d in np.unique(depth):
        up, down = np.where(depth == d, np.maximum(q, 0.0), 0.0), np.where(depth == d, np.minimum(q, 0.0), 0.0)
        if d == 0:                                                    # nothing seen: the heads bound all
            upper += (up @ far_top + down @ far_low)[:, None]
            lower += (up @ far_low + down @ far_top)[:, None]
            continue
        top, low = lists[len(lists) - d], lists[d - 1]                # frontiers of falling and rising lists
        upper += up @ np.maximum(c, top).T + down @ np.minimum(c, low).T
        lower += up @ np.where(c >= top, c, far_low).T + down @ np.where(c <= low, c, far_top).T
    return lower, upper


def depths(q: np.ndarray, n: int, share: float) -> np.ndarray:
    """Values read of each list (queries x dimensions) when ``share`` of them is read on average."""
    if share >= 1.0:
        return np.full(q.shape, n)
    place = np.argsort(np.argsort(-np.abs(q), axis=1, kind="stable"), axis=1, kind="stable")
    quarter = place * 4 // max(1, q.shape[1])
    return np.ceil(np.clip(share + SPREAD * (1 - 2 * quarter / 3), 0.0, 1.0) * n).astype(int)


def block_top(q_ids: np.ndarray, q: np.ndarray, bar: np.ndarray, c_ids: np.ndarray, c: np.ndarray, lists: np.ndarray, k: int
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(place of the query, candidate id, score) of each query's ``k`` best candidates of this block that reach its
    bar, and the number of list entries read."""
    n, dim = c.shape
    out_q, out_c, out_s, entries = [], [], [], 0
    heads = np.maximum(q, 0.0) @ lists[-1] + np.minimum(q, 0.0) @ lists[0]
    left = np.flatnonzero(heads >= bar)
    for share in STAGES:
        if not len(left):
            break
        depth = depths(q[left], n, share)
        lower, upper = bounds(q[left], c, lists, depth)
        own = q_ids[left, None] == c_ids
        lower[own] = -np.inf
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(left), -np.inf)
        may = (upper >= np.maximum(kth, bar[left])[:, None]) & ~own
        ended = may.sum(axis=1) <= max(FEW, k, FEW_SHARE * n) if share < 1.0 else np.ones(len(left), bool)
        for row in np.flatnonzero(ended):                             # resolve final scores
            who, at = np.flatnonzero(may[row]), left[row]
            entries += int(depth[row].sum()) + (len(who) * dim if share < 1.0 else 0)
            score = c[who] @ q[at]
            best = np.lexsort((c_ids[who], -score))[:k]
            best = best[score[best] >= bar[at]]
            out_q.append(np.full(len(best), at))
            out_c.append(c_ids[who[best]])
            out_s.append(score[best])
        left = left[~ended]
    none = [np.empty(0, "int64")]
    return np.concatenate(out_q or none), np.concatenate(out_c or none), np.concatenate(out_s or none), entries


def whole_numbers_top(q_ids, q, c_ids, c, k: int) -> tuple[list[int], list[int], list[int]]:
    """The same for components too large for exact floating sums, by plain whole numbers and without a bar."""
    found = []
    for at, (qi, qv) in enumerate(zip(q_ids.tolist(), q)):
        scores = sorted((-sum(int(a) * int(b) for a, b in zip(qv, cv)), ci) for ci, cv in zip(c_ids.tolist(), c) if ci != qi)
        found += [(at, ci, -s) for s, ci in scores[:k]]
    return tuple(map(list, zip(*found))) if found else ([], [], [])


def integers(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dim, v, row) of the vectors that take part, v as whole numbers in doubles, ``row`` a number of its own."""
    v, key = F.col(f"`{vector_col}`").cast("array<double>"), F.col(f"`{id_col}`").cast("bigint")
    return materialize(
        vectors.select(key.alias("vec_id"), v.alias("_v")).where(F.col("vec_id").isNotNull() & F.col("_v").isNotNull())
        .where(F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
        .select("vec_id", F.size("_v").alias("dim"), F.transform("_v", lambda x: F.floor(x * 256.0).cast("double")).alias("v"),
                F.monotonically_increasing_id().alias("row")))


def pivots(rows: DataFrame) -> dict[int, np.ndarray]:
    """At most ``PIVOTS`` different vectors of ``rows`` by dimension, sampled by row number."""
    wanted = min(PIVOTS, -(-rows.count() // PER_PIVOT))
    picked: dict[int, list] = {}
    for r in rows.orderBy(F.xxhash64("row"), "row").limit(wanted).select("dim", "v").collect():
        picked.setdefault(r["dim"], []).append(r["v"])
    return {dim: np.unique(np.array(vs, dtype="float64").reshape(len(vs), dim), axis=0) for dim, vs in picked.items()}


def celled(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with ``cell``, the place of the nearest centre of their dimension (0 if it has none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2048):
                batch = whole.slice(low, 2048)
                dims = batch.column("dim").to_numpy()
                cell = np.zeros(len(dims), "int32")
                for dim, centre in centres.items():
                    at = np.flatnonzero(dims == dim)
                    if len(at) and len(centre) > 1:
                        x = batch.column("v").take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim)
                        cell[at] = np.argmin((centre * centre).sum(axis=1) - 2.0 * (x @ centre.T), axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    return rows.mapInArrow(run, "vec_id bigint, dim int, v array<double>, row bigint, cell int")


def parted(rows: DataFrame, per_block: int) -> DataFrame:
    """``rows`` with ``part``, which cuts each cell into parts of about ``per_block``."""
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / per_block).alias("parts"))
    return rows.join(parts, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("row"), "parts")).drop("parts")


def _gathered(rows: DataFrame, keys: list[str], name: str, *more: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.collect_list("vec_id").alias(f"{name}_ids"), F.collect_list("row").alias(f"{name}_rows"),
                                   F.flatten(F.collect_list("v")).alias(f"{name}_v"), *[F.collect_list(m).alias(f"{name}_{m}") for m in more])


def _reader(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of blocks to found rows, and one row without ids for a pair with its counts of entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                get = lambda name: batch.column(name)[at].values.to_numpy(zero_copy_only=False)
                dim, c_ids, q_ids, q_rows, bar = batch.column("dim")[at].as_py(), get("c_ids"), get("q_ids"), get("q_rows"), get("q_bar")
                qv, cv = get("q_v").reshape(len(q_ids), dim), get("c_v").reshape(len(c_ids), dim)
                if "q_cell" in batch.schema.names:                    # a query's own block was read first
                    new = (get("q_cell") != batch.column("cell")[at].as_py()) | (get("q_part") != batch.column("part")[at].as_py())
                    q_ids, q_rows, bar, qv = q_ids[new], q_rows[new], bar[new], qv[new]
                lists = np.sort(cv, axis=0)
                for low in range(0, len(q_ids), SLICE):
                    ids, rows, v = q_ids[low:low + SLICE], q_rows[low:low + SLICE], qv[low:low + SLICE]
                    of = len(ids) * cv.size
                    most = float(np.abs(v).max(initial=0)) * float(np.abs(cv).max(initial=0)) * dim
                    if most < 2.0 ** 53:
                        places, found, score, entries = block_top(ids, v, bar[low:low + SLICE].astype("float64"), c_ids, cv, lists, k)
                        score = np.asarray(score).astype("int64")
                    else:
                        places, found, score = whole_numbers_top(ids, v, c_ids, cv, k)
                        entries = of
                    places, m = np.asarray(places, dtype="int64"), len(found)
                    cols = ([*rows[places], None], [*ids[places], None], [*found, None], [*score, None], [None] * m + [entries], [None] * m + [of])
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["q_row", "query_id", "vec_id", "score", "entries", "of"])

    return run


def _found(vectors: DataFrame, queries: DataFrame, k: int, id_col: str, vector_col: str) -> DataFrame:
    """Rows of ``FOUND``: what the blocks gave each query, at most k rows of each block, and the counts of entries."""
    all_rows = integers(vectors, id_col, vector_col)
    centres = pivots(all_rows)
    key = ["dim", "cell", "part"]
    c = materialize(_gathered(parted(celled(all_rows, centres), CANDIDATES), key, "c"))
    q = materialize(parted(celled(integers(queries, id_col, vector_col), centres), QUERIES))
    no_bar = F.transform("q_ids", lambda _: F.lit(LOWEST).cast("bigint"))
    first = materialize(c.join(_gathered(q, key, "q"), key).withColumn("q_bar", no_bar).mapInArrow(_reader(k), FOUND))
    bar = (first.where("q_row is not null").groupBy(F.col("q_row").alias("row"))
           .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bar")))
    count, strips = max(1, -(-q.count() // QUERIES)), max(1, -(-c.count() // STRIP))
    tasks, meet = min(count * strips, MOST_TASKS), ["dim", "q", "strip"]
    asked = q.join(bar, "row", "left").withColumn("bar", F.coalesce("bar", F.lit(LOWEST).cast("bigint")))
    q_blocks = _gathered(asked.withColumn("q", F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")), ["dim", "q"], "q", "bar", "cell", "part")
    q_side = q_blocks.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1)))).repartition(tasks, *meet)
    c_side = (c.withColumn("strip", F.pmod(F.xxhash64(*key), F.lit(strips)).cast("int"))
              .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).repartition(tasks, *meet))
    return first.unionByName(c_side.join(q_side, meet).mapInArrow(_reader(k), FOUND))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best other vectors."""
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (_found(vectors, queries, k, id_col, vector_col).where("q_row is not null")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def entries_read(vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row: list entries that ``search`` reads, final scores counted whole, and the entries of all lists for every query."""
    return (_found(vectors, queries, k, id_col, vector_col)
            .agg(F.coalesce(F.sum("entries"), F.lit(0)).alias("entries"), F.coalesce(F.sum("of"), F.lit(0)).alias("of")))
