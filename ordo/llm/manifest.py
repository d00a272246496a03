"""Merkle manifest of a dataset: places of leaves by bitmap rank, keyed slot arrays up to one root.

1. Each row's leaf is a SHA-256 over its columns. Rows are never sorted to find a leaf's place.
2. The ids of a group (a source) form a compressed bitmap: only words of 64 ids that hold an id
   exist, as rows (group, word, bits, n). Bitmaps of parts merge by ``bit_or``, already on the
   map side.
3. A popcount directory counts ids word by word: 1,024 words make a node, 1,024 nodes the next,
   up to one node a group. Going down again, each node starts where its parent starts plus what
   stands before it, so no sum ever runs over more than 1,024 rows.
4. The place of an id is its word's start plus the bits below its own: one equi-join on
   (group, word), 64 ids at most to a key.
5. Places cut into runs of 16 give (node, slot). Children meet as slot arrays keyed by slot,
   level by level, until one node is left: the group's subroot. Subroots make the tree of the
   groups, whose root covers the dataset.
6. Paths go from the root down: a child gets its siblings and its parent's path. Rows stand in
   the slot arrays of the lowest level, so proofs cost no further shuffle of the rows.

Edge cases: null ids stand before all others; rows that repeat an id lie side by side by leaf
digest (equal rows in any order), numbered by a range plan and joined by salts of 10,000, so
that one id may hold any share of the rows; null groups come first and are not the empty string;
null columns hash as ``-``, empty ones as ``0:``; other columns are not read; an empty table
gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordo.operators.ranking import group_rank
from ordo.operators.sizing import broadcast_if_small
from ordo.session import Generations

FAN = 16                      # children of a node
WORD_BITS = 6                 # ids of one bitmap word: 64
DIRECTORY_BITS = 10           # words or nodes under one directory node: 1,024
SALT_ROWS = 10_000            # rows of one repeated id that share a join key
FEW_IDS = 100_000             # repeated ids (some 40 bytes each) that may be broadcast
NULL_WORD = -(1 << 57) - 1    # word of null ids, below the word of any 64-bit id
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values: ``-`` for null, else UTF-8 byte count, colon, value."""
    parts = []
    for v in values:
        text = v.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaves(df: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "source",
           found: Column | None = None) -> DataFrame:
    """(id, grp, leaf, found) of every row: ``found`` is the leaf digest that an audit met, null where it met the same."""
    group = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit(""))    # null is no empty string, and first
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), group.alias("grp"),
                     digest([F.col(f"`{c}`") for c in columns]).alias("leaf"),
                     (F.lit(None).cast("string") if found is None else found).alias("found"))


def lowered_text(columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The digest of a tampered row: every fifth id (by crc32) has the letters A-Z of its text in lower case."""
    low = [F.translate(F.col(f"`{c}`"), _UPPER, _LOWER) if c == text_col else F.col(f"`{c}`") for c in columns]
    return F.when(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 5 == 0, digest(low))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with the bitmap word of the id and its bit."""
    return (rows.withColumn("word", F.coalesce(F.shiftright("id", WORD_BITS), F.lit(NULL_WORD)))
            .withColumn("low", F.coalesce(F.col("id").bitwiseAND(63), F.lit(0)).cast("int")))


def _bit(low: str) -> Column:
    return F.expr(f"shiftleft(1L, {low})")


def bitmap(rows: DataFrame) -> DataFrame:
    """(grp, word, bits, n) of ``rows`` (id, grp): the non-empty words of each group's bitmap and the rows under them."""
    return merge(_placed(rows).select("grp", "word", _bit("low").alias("bits"), F.lit(1).cast("bigint").alias("n")))


def merge(*parts: DataFrame) -> DataFrame:
    """One bitmap of the bitmaps of parts."""
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy("grp", "word").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))


def directory(words: DataFrame, gens: Generations) -> DataFrame:
    """``words`` with ``start`` (rows of the group before the word) and ``total`` (rows of the group)."""
    lo, hi = words.agg(F.min("word"), F.max("word")).first()
    if lo is None:
        zero = F.lit(0).cast("bigint")
        return words.withColumn("start", zero).withColumn("total", zero)
    levels = [words.withColumnRenamed("word", "key")]
    shift = 0
    while (lo >> shift) != (hi >> shift) and shift < 60:
        shift += DIRECTORY_BITS
        up = F.shiftright("key", DIRECTORY_BITS) if shift < 60 else F.lit(0).cast("bigint")
        levels.append(gens.keep(levels[-1].groupBy("grp", up.alias("key")).agg(F.sum("n").alias("n"))))
    above = levels[-1].select("grp", "key", F.lit(0).cast("bigint").alias("start"), F.col("n").alias("total"))
    for level in range(len(levels) - 2, -1, -1):
        up = F.shiftright("key", DIRECTORY_BITS) if (level + 1) * DIRECTORY_BITS < 60 else F.lit(0).cast("bigint")
        before = Window.partitionBy("grp", "up").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)    # 1,024 rows at most
        inside = levels[level].withColumn("up", up).withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0)))
        down = (inside.join(above.select("grp", F.col("key").alias("up"), F.col("start").alias("base"), "total"), ["grp", "up"])
                .withColumn("start", F.col("base") + F.col("inside")))
        above = down.select("grp", "key", "start", "total") if level else down.drop("up", "inside", "base")
    if len(levels) == 1:
        above = levels[0].withColumn("start", F.lit(0).cast("bigint")).withColumn("total", F.col("n"))
    return above.withColumnRenamed("key", "word")


def coordinates(rows: DataFrame, gens: Generations) -> DataFrame:
    """``rows`` (id, grp, leaf, ...) with ``place`` (from 0, in the group) and ``total`` (rows of the group)."""
    rows = _placed(rows)
    words = gens.keep(bitmap(rows))
    crowded = words.where(F.bit_count("bits") < F.col("n")).select("grp", "word")
    one = F.lit(1).cast("bigint")
    if crowded.isEmpty():
        rows = rows.withColumn("turn", one)
        index = directory(words, gens).withColumn("ties", F.lit(None).cast("array<struct<low:int,more:bigint>>")).withColumn("salt", F.lit(0).cast("bigint"))
    else:
        # Ids that stand in several rows: their rows are numbered among themselves, and the words know how many there are.
        near = rows.select("grp", "word", "low").groupBy("grp", "word", "low").count()
        ties = gens.keep(near.where("count > 1"))
        few = broadcast_if_small(ties.select("grp", "word", "low"), bound_rows=ties.count(), max_rows=FEW_IDS)
        # A null id has no place in a pandas integer column: word and low tell it.
        again = F.when(F.col("word") != NULL_WORD, F.expr("shiftleft(word, 6) | low")).alias("id")
        tied = group_rank(rows.join(few, ["grp", "word", "low"], "left_semi").drop("id"), ["grp", "word", "low"],
                          [F.col("leaf").asc()], "turn", "range").withColumn("id", again)
        rows = rows.join(few, ["grp", "word", "low"], "left_anti").withColumn("turn", one).unionByName(tied)
        more = ties.groupBy("grp", "word").agg(F.collect_list(F.struct("low", (F.col("count") - 1).alias("more"))).alias("ties"),
                                               F.max("count").alias("most"))
        last = F.floor((F.coalesce("most", F.lit(1)) - 1) / SALT_ROWS)
        index = (directory(words, gens).join(more, ["grp", "word"], "left")
                 .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("most"))
    below = F.bit_count(F.expr("bits & ~shiftleft(-1L, low)"))
    extra = F.aggregate(F.filter("ties", lambda t: t["low"] < F.col("low")), F.lit(0).cast("bigint"), lambda a, t: a + t["more"])
    return (rows.withColumn("salt", F.floor((F.col("turn") - 1) / SALT_ROWS))
            .join(index.select("grp", "word", "salt", "bits", "start", "total", "ties"), ["grp", "word", "salt"])
            .withColumn("place", F.col("start") + below + F.coalesce(extra, F.lit(0)) + F.col("turn") - 1)
            .drop("word", "low", "turn", "salt", "bits", "start", "ties"))


def _run(nodes: DataFrame, fan: int, carried: Sequence[str]) -> DataFrame:
    """One level up: (grp, place, total, kids, digest), ``kids`` the run's slot array of (digest, *carried)."""
    slot = (F.col("place") % fan).cast("int")
    gathered = (nodes.groupBy("grp", F.col("total").alias("below"), F.floor(F.col("place") / fan).alias("place"))
                .agg(F.map_from_entries(F.collect_list(F.struct(slot, F.struct("digest", *carried)))).alias("slots")))
    kids = F.transform(F.sequence(F.lit(0), F.size("slots") - 1), lambda k: F.col("slots")[k])
    return (gathered.select("grp", "place", F.ceil(F.col("below") / fan).alias("total"), kids.alias("kids"))
            .withColumn("digest", F.sha2(F.array_join(F.col("kids.digest"), "").cast("binary"), 256)))


def levels(nodes: DataFrame, most: int, gens: Generations, fan: int = FAN, carried: Sequence[str] = ()) -> list[DataFrame]:
    """All levels over ``nodes`` (grp, place, total, digest, *carried): a group stops at one node; ``most`` is the largest total."""
    found = [nodes]
    while most > 1:
        found.append(gens.keep(_run(found[-1].where("total > 1"), fan, carried if len(found) == 1 else ())))
        most = -(-most // fan)
    return found


def tops(found: Sequence[DataFrame]) -> DataFrame:
    """(grp, digest) of the one node that each group ends with."""
    out = None
    for level in found:
        top = level.where("total = 1").select("grp", "digest")
        out = top if out is None else out.unionByName(top)
    return out


_STEP = "struct<before:string,after:string>"


def paths(found: Sequence[DataFrame], of_tops: DataFrame, gens: Generations, fan: int = FAN) -> DataFrame:
    """(grp, place, kid, path, subroot) of every node of the lowest level, ``kid`` its struct of digest and
    carried columns; ``of_tops`` is (grp, path, subroot) of each group's last node. A path lists what stands
    before and after at each level, from the lowest up."""
    lowest = found[0]
    carried = [c for c in lowest.columns if c not in ("grp", "place", "total")]
    known = None
    for level in range(len(found) - 1, 0, -1):
        nodes = found[level]
        own = nodes.where("total = 1").join(of_tops, "grp").select("grp", "place", "kids", "path", "subroot")
        if known is not None:
            own = own.unionByName(nodes.where("total > 1").join(known, ["grp", "place"]).select("grp", "place", "kids", "path", "subroot"))
        side = lambda low, n: F.array_join(F.slice(F.col("kids.digest"), low, n), "")
        step = F.struct(side(F.lit(1), F.col("slot")).alias("before"),
                        side(F.col("slot") + 2, F.greatest(F.size("kids") - F.col("slot") - 1, F.lit(0))).alias("after"))
        known = (own.select("*", F.posexplode("kids").alias("slot", "kid"))
                 .select("grp", (F.col("place") * fan + F.col("slot")).alias("place"), "kid",
                         F.concat(F.array(step), F.col("path")).alias("path"), "subroot"))
        if level > 1:
            known = gens.keep(known.drop("kid"))
    alone = (lowest.where("total = 1").join(of_tops, "grp")
             .select("grp", "place", F.struct("digest", *[c for c in carried if c != "digest"]).alias("kid"), "path", "subroot"))
    return alone if known is None else known.unionByName(alone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf digest and a path lead to."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["before"], h, p["after"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, joined."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), "").cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """Trees of the groups and over the groups; ``root`` is None for an empty table."""
    inner: list[DataFrame]        # levels of the groups' trees: leaves first
    outer: list[DataFrame]        # levels of the tree over the subroots
    root: str | None

    def subroots(self) -> DataFrame:
        """(grp, digest): ``grp`` is ``=`` and the group's value, or empty for null."""
        return tops(self.inner)


def build(rows: DataFrame, gens: Generations, fan: int = FAN) -> Manifest:
    """The manifest of ``rows`` (id, grp, leaf, found)."""
    rows = gens.keep(rows)
    placed = gens.keep(coordinates(rows, gens).withColumnRenamed("leaf", "digest").select("grp", "place", "total", "digest", "id", "found"))
    gens.drop(rows)
    most = placed.agg(F.max("total")).first()[0] or 0
    inner = levels(placed, most, gens, fan, ("id", "found"))
    groups = gens.keep(tops(inner))
    n = groups.count()
    ranked = group_rank(groups.withColumn("one", F.lit(1)), ["one"], [F.col("grp").asc()], "place", "range")
    outer = levels(ranked.select(F.lit("").alias("grp"), (F.col("place") - 1).alias("place"), F.lit(n).cast("bigint").alias("total"),
                                 "digest", F.col("grp").alias("of")), n, gens, fan, ("of",))
    root = tops(outer).first()
    return Manifest(inner, outer, root["digest"] if root else None)


def verified(manifest: Manifest, gens: Generations, fan: int = FAN) -> DataFrame:
    """Every leaf with its proof, and the root that the leaf an audit found leads to:
    doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    start = manifest.outer[0].select("grp").limit(1).select("grp", F.array().cast(f"array<{_STEP}>").alias("path"), F.lit("").alias("subroot"))
    over = paths(manifest.outer, start, gens, fan)
    of_groups = gens.keep(over.select(F.col("kid.of").alias("grp"), "path", F.col("kid.digest").alias("subroot")))
    each = paths(manifest.inner, of_groups, gens, fan)
    folded = fold(F.coalesce("kid.found", "kid.digest"), F.col("path"))
    root = F.lit(manifest.root).cast("string")
    return each.select(F.col("kid.id").alias("doc_id"), F.col("kid.digest").alias("leaf"), "subroot", root.alias("root"),
                       proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"), (folded == root).alias("verified"))


def audit(df: DataFrame) -> DataFrame:
    """Manifest of ``df`` (doc_id, source, lang, n_chars, text) and a check of every row, tampered ones included."""
    gens = Generations(df.sparkSession, "manifest")
    return verified(build(leaves(df, found=lowered_text()), gens), gens)
