"""Near-duplicate groups: one-permutation MinHash, banded buckets, star edges, exact check.

1. Each text becomes its set of distinct shingle hashes, and one pass over the set fills a
   one-permutation signature: a shingle falls in the bin of its hash, the bin keeps its
   least value. Empty bins borrow from a bin that a fixed walk of their own number
   reaches (optimal densification), so equal bins keep meaning equal sets.
2. Equal sets are one class; its smallest id stands for it from here on.
3. ``rows`` consecutive bins make a band. Classes with the same band value share a bucket.
4. A bucket gives star edges: every member of fitting size to the bucket's hub, so pairs
   grow with members and not with their square. The hub is the member that meets most
   others over all buckets: of many edited copies of a text, the one nearest to all. Each
   edge is confirmed on the full sets, and confirmed links make components.
5. A bucket whose members are still in several components may hide a link that its hub did
   not see. It gets its next hub, compared with members of other components only, as long as
   a round confirms at least one in ``YIELD`` of its pairs. That only decides which way finds
   a link: what is left goes through step 6.
6. Members that share a bucket with another component and are of a size that could reach the
   similarity are settled by an exact join: shingles that stand in one component only come
   first, the others by rarity, and a pair that reaches the similarity has to share one of the
   first floor(n / 5) + 1 of each (prefix filter, at 80 percent). Where the shingle stands
   bounds what the pair can still share. All pairs that are left are confirmed on the full sets.

With 32 bands of 5 bins a pair of similarity 0.8 shares 10 buckets on average, and none
with probability (1 - 0.8^5)^32 = 3e-6. Every pair that shares a bucket is settled.

Tables of the rounds are written under ``spark.checkpoint.dir`` and removed when the next
round has its own.

Edge cases: null, empty and blank texts have the empty set and are linked with nothing;
a text of fewer words than a shingle is one shingle; repeated rows are linked like any
equal sets (a text without words: each id by itself); rows that share an id but not the
text are documents of their own; null ids take no part in links; an empty table gives an
empty table; other columns are not read, and ``keep_one`` returns them whatever their names.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.common import byte_slices
from ordo.operators.sizing import broadcast_if_small
from ordo.session import Generations, arrow_batch_bytes

BANDS, ROWS = 32, 5
YIELD = 10               # rounds of hubs go on while one in so many compared pairs is a link
SALT_MEMBERS = 1000      # members of one bucket that a salt of the hub join holds
SALT_ROWS = 256          # rows of one shingle that a salt of the exact join holds
FEW_IDS = 200_000        # ids (16 bytes each) that may be broadcast
BATCH_BYTES = 1 << 20    # text that a worker turns into sets at a time
MEMO_WORDS = 50_000      # words whose hashes a worker keeps
_MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found
        return found


def shingle_set(text: bytes, words_each: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of ``text`` (A-Z lower-cased)."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = min(words_each, len(words))
    total = np.full(len(words) - n + 1, np.uint64(n))
    for k in range(n):
        total = mixed(total * _MIX + h[k:len(h) - n + 1 + k])
    return np.unique(total)


def densified_walks(bins: int, steps: int = 64) -> np.ndarray:
    """For each bin the bins that it tries to borrow from, in turn; the same for all sets."""
    at = mixed(np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(1_000_003) + np.arange(1, steps + 1, dtype=np.uint64) * _MIX)
    return (at % np.uint64(bins)).astype(np.int64)


def signature(hashes: np.ndarray, bins: int, walks: np.ndarray) -> np.ndarray:
    """One-permutation signature of a non-empty set: the least hash of each bin, borrowed where a bin is empty."""
    value = mixed(hashes)
    at = ((value >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)    # by the high half
    sig = np.full(bins, np.iinfo(np.uint64).max, np.uint64)
    order = np.argsort(value)
    first = np.unique(at[order], return_index=True)
    sig[first[0]] = value[order][first[1]]
    filled = np.zeros(bins, bool)
    filled[first[0]] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        hit = filled[walks[empty]]
        step = hit.argmax(axis=1)
        source = walks[empty, step]
        lost = ~hit.any(axis=1)                      # the walk met no filled bin: take the next one round
        if lost.any():
            have = np.flatnonzero(filled)
            source[lost] = have[np.searchsorted(have, empty[lost]) % len(have)]
        sig[empty] = sig[source]
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64) * np.uint64(0x100000001B3)
    for k in range(rows):
        key = mixed(key * _MIX + sig.reshape(bands, rows)[:, k])
    return key.view(np.int64)


def sketches(docs: DataFrame, words_each: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_a, set_b, keys) of ``docs`` (doc_id, text); the set hash has two halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, walks = WordHashes(), densified_walks(bands * rows)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            n, a, b, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text or b"", words_each, memo)
                digest = xxhash.xxh128_digest(s.tobytes())
                n.append(len(s))
                a.append(int.from_bytes(digest[:8], "little", signed=True))
                b.append(int.from_bytes(digest[8:], "little", signed=True))
                keys.append(band_keys(signature(s, bands * rows, walks), bands, rows) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                 pa.array(b, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "text_hash", "n_shingles", "set_a", "set_b", "keys"])

    read = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(run, "doc_id bigint, text_hash bigint, n_shingles bigint, set_a bigint, set_b bigint, keys array<bigint>")


def full_sets(docs: DataFrame, words_each: int) -> DataFrame:
    """(doc_id, shingles) with the whole set of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            sets = [shingle_set(t or b"", words_each, memo).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.list_(pa.int64()))], ["doc_id", "shingles"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id bigint, shingles array<bigint>")


def rows_with(docs: DataFrame, ids: DataFrame, how: str, on: list[str]) -> DataFrame:
    """Semi or anti join. The ids are broadcast only when they are counted and few;
    beyond that both sides are shuffled."""
    return docs.join(broadcast_if_small(ids, bound_rows=ids.count(), max_rows=FEW_IDS), on, how)


class _Sets:
    """Full sets of the documents that stood in a pair so far, each read and shingled once."""

    def __init__(self, docs: DataFrame, words_each: int, gens: Generations, repeated: bool):
        self.docs, self.words_each, self.gens, self.repeated = docs, words_each, gens, repeated
        self.held: DataFrame | None = None

    def of(self, wanted: DataFrame) -> DataFrame:
        """(doc_id, shingles) that holds all of ``wanted`` (doc_id)."""
        if self.held is not None:
            wanted = wanted.join(self.held.select("doc_id"), "doc_id", "left_anti")
        wanted = self.gens.keep(wanted)
        if self.held is None or not wanted.isEmpty():
            new = full_sets(rows_with(self.docs, wanted, "left_semi", ["doc_id"]), self.words_each)
            with arrow_batch_bytes(self.docs.sparkSession, BATCH_BYTES):
                new = self.gens.keep(new.dropDuplicates(["doc_id"]) if self.repeated else new)
            self.held = new if self.held is None else self.held.unionByName(new)
        self.gens.drop(wanted)
        return self.held

    def links(self, pairs: DataFrame, percent: int) -> DataFrame:
        """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
        sets = self.of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
        both = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa")), "a")
                .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb")), "b")
                .withColumn("same", F.size(F.array_intersect("sa", "sb"))))
        linked = both.where(F.col("same") * 100 >= (F.size("sa") + F.size("sb") - F.col("same")) * percent)
        return self.gens.keep(linked.select("a", "b"))


def components(links: DataFrame, gens: Generations | None = None, known: DataFrame | None = None) -> DataFrame:
    """(id, root): the smallest id that each end of a link reaches; ``known`` roots go on.

    Min-label rounds with pointer jumping: a root takes the least root that a link of any
    member leads to, then labels follow their roots."""
    gens = gens or Generations(links.sparkSession, "components")
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    labels = ends.withColumn("root", F.col("id"))
    if known is not None:
        labels = known.unionByName(ends.join(known, "id", "left_anti").withColumn("root", F.col("id")))
    labels = gens.keep(labels)
    while True:
        ra = labels.select(F.col("id").alias("a"), F.col("root").alias("ra"))
        rb = labels.select(F.col("id").alias("b"), F.col("root").alias("rb"))
        across = gens.keep(links.join(ra, "a").join(rb, "b").where(F.col("ra") != F.col("rb"))
                           .select(F.least("ra", "rb").alias("lo"), F.greatest("ra", "rb").alias("hi")).distinct())
        if across.isEmpty():
            gens.drop(across)
            return labels
        # Hook each larger root to its least neighbour, then jump until the hooks are flat.
        hooks = gens.keep(across.groupBy("hi").agg(F.min("lo").alias("to"), F.lit(True).alias("moved")))
        gens.drop(across)
        while True:
            up = hooks.select(F.col("hi").alias("to"), F.col("to").alias("further"))
            jumped = gens.keep(hooks.select("hi", "to").join(up, "to", "left").select(
                "hi", F.coalesce("further", "to").alias("to"), F.col("further").isNotNull().alias("moved")))
            gens.drop(hooks)
            hooks = jumped
            if not hooks.agg(F.max("moved")).first()[0]:
                break
        new = gens.keep(labels.join(hooks.select(F.col("hi").alias("root"), "to"), "root", "left")
                        .select("id", F.coalesce("to", "root").alias("root")))
        gens.drop(labels, hooks)
        labels = new


def _compared(members: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of each hub with the members of its bucket that stand in another component
    and have a size that can reach the similarity. A large bucket's members are dealt by a
    salt, its hub is copied to each."""
    salts = F.floor(F.col("size") / SALT_MEMBERS)
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("id"), salts + 1))
    copied = hubs.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts))).drop("size")
    small, large = F.least("n", "hn"), F.greatest("n", "hn")
    return (dealt.join(copied, ["bucket", "salt"])
            .where((F.col("id") != F.col("h")) & (F.col("root") != F.col("hr")) & (small * 100 >= large * percent))
            .select(F.least("h", "id").alias("a"), F.greatest("h", "id").alias("b")))


def prefix_pairs(held: DataFrame, percent: int, gens: Generations | None = None) -> DataFrame:
    """Pairs (a, b) over ``held`` (id, root, shingles) that hold all pairs of different
    components that reach the similarity: step 6.

    The order of shingles is one for all sets. Those of one component only stand in front
    of the others, so that they use up the prefix without a pair. The rows of a common
    shingle are dealt by a salt of the one side and met by copies of the other."""
    gens = gens or Generations(held.sparkSession, "prefix")
    each = held.select("id", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("sh"))
    many = (each.groupBy("sh").agg(F.count(F.lit(1)).alias("f"), F.min("root").alias("lo"), F.max("root").alias("hi"))
            .where("lo != hi").select("sh", "f"))
    ordered = (each.join(many, "sh").groupBy("id", "root", "n")
               .agg(F.sort_array(F.collect_list(F.struct("f", "sh"))).alias("s")))
    front = ordered.select("id", "root", "n", (F.col("n") - F.size("s")).alias("own"), F.posexplode("s").alias("k", "s")).select(
        "id", "root", "n", F.col("s.sh").alias("sh"), (F.col("own") + F.col("k")).cast("bigint").alias("at"))
    front = gens.keep(front.where(F.col("at") * 100 <= F.col("n") * (100 - percent)))
    salts = (front.groupBy("sh").agg(F.count(F.lit(1)).alias("f"), F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where("lo != hi").select("sh", F.ceil(F.col("f") / SALT_ROWS).alias("salts")))
    met = gens.keep(front.join(salts, "sh"))
    one = met.withColumn("salt", F.pmod(F.xxhash64("id"), "salts")).drop("salts")
    other = met.select("sh", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"),
                       F.col("id").alias("b"), F.col("root").alias("rb"), F.col("n").alias("nb"), F.col("at").alias("atb"))
    most = F.least(F.col("n") - F.col("at"), F.col("nb") - F.col("atb"))      # what the pair can share from here on
    pairs = gens.keep(one.join(other, ["sh", "salt"]).where(
        (F.col("id") < F.col("b")) & (F.col("root") != F.col("rb")) & (most * (100 + percent) >= (F.col("n") + F.col("nb")) * percent))
        .select(F.col("id").alias("a"), "b").distinct())
    gens.drop(front, met)
    return pairs


def _unsettled(open_: DataFrame, percent: int) -> DataFrame:
    """(doc_id, root) of the members that share a bucket with a member of another component whose size
    could reach the similarity: sizes fall in classes as wide as that, and a pair shares a class or its neighbour."""
    width = max(0.01, math.log(100 / percent) * 1.0001)
    c = F.floor(F.log("n") / width)
    sized = open_.select("bucket", "id", "root", F.explode(F.array(c, c + 1)).alias("c"))
    spans = sized.groupBy("bucket", "c").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("bucket", "c")
    return sized.join(spans, ["bucket", "c"]).select(F.col("id").alias("doc_id"), "root").distinct()


def settled(members: DataFrame, docs: DataFrame, words_each: int, percent: int, repeated: bool = False) -> DataFrame:
    """Components (id, root) over the classes in ``members`` (bucket, id, n): steps 4 to 6. ``docs`` (doc_id, text)
    has the text of each id, in several equal rows if ``repeated``."""
    gens = Generations(members.sparkSession, "neardup")
    sets = _Sets(docs, words_each, gens, repeated)
    size = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    some = gens.keep(members.join(size, "bucket"))
    near = some.groupBy("id").agg(F.sum(F.col("size") - 1).alias("near"))
    members = gens.keep(some.join(near, "id"))
    gens.drop(some)
    open_ = members.withColumn("root", F.col("id"))
    roots = tried = used = None
    while True:
        free = open_ if used is None else open_.join(used, ["bucket", "id"], "left_anti")
        hub = gens.keep(free.groupBy("bucket").agg(F.max_by(F.struct("id", "n", "root", "size"), F.struct("near", -F.col("id"))).alias("h"))
                        .select("bucket", F.col("h.id").alias("h"), F.col("h.n").alias("hn"), F.col("h.root").alias("hr"), F.col("h.size").alias("size")))
        pairs = _compared(open_, hub, percent).distinct()
        new = gens.keep(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        compared = new.count()
        links = sets.links(new, percent)
        found = links.count()
        if found or roots is None:
            roots = _replaced(gens, roots, components(links, gens, roots))
        mine = hub.select("bucket", F.col("h").alias("id"))
        tried = new if tried is None else tried.unionByName(new)
        used = mine if used is None else used.unionByName(mine)
        gens.drop(links)
        # What is left: buckets over several components.
        held = members.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
        several = held.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("bucket")
        open_ = _replaced(gens, open_, gens.keep(held.join(several, "bucket")))
        if found * YIELD < compared or not compared:
            break
    left = gens.keep(_unsettled(open_, percent))
    if not left.isEmpty():
        held = left.join(sets.of(left.select("doc_id")), "doc_id").withColumnRenamed("doc_id", "id")
        new = prefix_pairs(held, percent, gens)
        links = sets.links(new.join(tried, ["a", "b"], "left_anti"), percent)
        if not links.isEmpty():
            roots = _replaced(gens, roots, components(links, gens, roots))
        gens.drop(new, links)
    gens.keep_only(roots)
    return roots


def _replaced(gens: Generations, old: DataFrame | None, new: DataFrame) -> DataFrame:
    gens.drop(old)
    return new


def _told_apart(docs: DataFrame, seen: DataFrame, gens: Generations) -> tuple[DataFrame, DataFrame, bool]:
    """``docs`` with a ``doc_id`` that belongs to one text only, ``seen`` with it as ``node``, and whether rows repeat.

    An id with several texts is replaced by a hash of id and text; should one be another node already, the next seed is taken."""
    several = gens.keep(seen.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id")
                        .agg(F.count(F.lit(1)).alias("c"), (F.min("text_hash") != F.max("text_hash")).alias("differ")).where("c > 1"))
    if several.isEmpty():
        return docs, seen.withColumn("node", F.col("doc_id")), False
    differ = several.where("differ").select("doc_id", F.lit(True).alias("differ"))
    few = broadcast_if_small(differ, bound_rows=differ.count(), max_rows=FEW_IDS)
    docs = docs.withColumn("text_hash", F.xxhash64("text")).join(few, "doc_id", "left")
    seen = seen.join(few, "doc_id", "left")
    seed = 0
    while True:
        node = F.when(F.col("differ"), F.xxhash64("doc_id", "text_hash", F.lit(seed))).otherwise(F.col("doc_id"))
        told = gens.keep(seen.withColumn("node", node).drop("differ"))
        texts = told.where("n_shingles > 0 and doc_id is not null").select("node", "doc_id", "text_hash").distinct()
        if texts.groupBy("node").count().where("count > 1").isEmpty():
            return docs.select(node.alias("doc_id"), "text"), told, True
        gens.drop(told)
        seed += 1


def _grouped(docs: DataFrame, words_each: int, percent: int, bands: int, rows: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, root, component_id of every row of ``docs`` (doc_id, text); no root without an id or words."""
    gens = Generations(docs.sparkSession, "classes")
    with arrow_batch_bytes(docs.sparkSession, BATCH_BYTES):
        seen = gens.keep(sketches(docs, words_each, bands, rows))
    docs, seen, repeated = _told_apart(docs, seen, gens)
    some = seen.where("n_shingles > 0 and node is not null")
    classes = gens.keep(some.groupBy("set_a", "set_b").agg(
        F.min("node").alias("id"), F.min("doc_id").alias("least"), F.min("n_shingles").alias("n"), F.min_by("keys", "node").alias("keys")))
    members = classes.select("id", "n", F.posexplode("keys").alias("band", "key")).select(
        F.xxhash64("band", "key").alias("bucket"), "id", "n").distinct()
    rooted = (classes.join(settled(members, docs, words_each, percent, repeated), "id", "left")
              .select("set_a", "set_b", F.coalesce("root", "id").alias("root"), "least"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = rooted.drop("least").join(least, "root")
    return (seen.join(by_class, ["set_a", "set_b"], "left")
            .withColumn("root", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("root")))
            .select("doc_id", "text_hash", "n_shingles", "root",
                    F.when(F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def _read(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 5, percent: int = 80,
           bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; the component of a null id is null, and it is kept."""
    return (_grouped(_read(df, id_col, text_col), words_each, percent, bands, rows)
            .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_each: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, with all its columns: the one with the smallest id (of several texts
    under that id the one with the least hash; of equal rows any).

    Rows without words or without an id are no group and stay."""
    gens = Generations(docs.sparkSession, "kept")
    found = gens.keep(_grouped(_read(docs, id_col, text_col), words_each, percent, BANDS, ROWS).where("root is not null"))
    first = found.where("doc_id = component_id").groupBy("root").agg(F.min("text_hash").alias("first"))
    told = found.join(first, "root").withColumn("kept", (F.col("doc_id") == F.col("component_id")) & (F.col("text_hash") == F.col("first")))
    told = gens.keep(told.groupBy("doc_id", "text_hash", "kept").agg(F.count(F.lit(1)).alias("rows")))
    key = [f"_{k}_{uuid.uuid4().hex}" for k in ("id", "hash")]       # names that no column of docs has
    named = lambda t: t.select(F.col("doc_id").alias(key[0]), F.col("text_hash").alias(key[1]))
    gone, repeated = named(told.where("not kept")), named(told.where("kept and rows > 1"))
    rows = docs.withColumn(key[0], F.col(f"`{id_col}`").cast("bigint")).withColumn(key[1], F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    left = rows_with(rows, gone, "left_anti", key)
    if not repeated.isEmpty():
        left = rows_with(left, repeated, "left_anti", key).unionByName(rows_with(left, repeated, "left_semi", key).dropDuplicates(key))
    return left.select(*[f"`{c}`" for c in docs.columns])
