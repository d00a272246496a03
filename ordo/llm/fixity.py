"""Merkle fixity audit of web archives.

An archive is a run of WARC files, each a run of records. A record's leaf holds its
number, offset, length and SHA-256. A node of the tree covers ``2 ** BITS`` numbers of
the level below and hashes its children in order, each with its length, so a node stands
for an ordered range of offsets. Numbers, not places, tie the trees of two replicas
together: a lost or added record changes its own branch and no other.

``audit`` compares the roots and goes down only into branches whose hashes differ, level
by level, with a join on the parents that differ. What it returns are the damaged
records: altered, truncated, missing or extra.

Below a number stand the nodes of its parts, cut by the start of the records' digests, so
that a number which very many records share is never gathered in one place.

Edge cases: null payloads are empty; null numbers stand under -1; records that repeat a
number make one branch, whatever their order; an empty archive has no nodes, and all
records of the other one are missing or extra.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordo.llm.common import materialize
from ordo.operators.ranking import group_rank

BITS = 4                 # a node has 16 children at most
PART_DIGITS = 3          # a number's records are cut by so many hex digits of their digest
STRETCH = 1 << 16        # copies of one record that are written out together
PER_FILE = 1000          # record numbers of one WARC file
EXTRA = 1 << 24          # what a planted extra record adds to its number


def warc_record(number: Column, url: Column, payload: Column) -> Column:
    """A response record up to its closing line ends."""
    body = F.coalesce(payload, F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:record:"),
                    F.coalesce(number.cast("string"), F.lit("-1")), F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(number, record) of every row."""
    number = F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(-1).cast("bigint"))
    return pages.select(number.alias("number"), warc_record(F.col(f"`{id_col}`"), F.col(f"`{url_col}`"), F.col(f"`{payload_col}`")).alias("record"))


def write_archive(recs: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """WARC files under ``path/file_no=<n>/``, records in order of their numbers."""
    parts = recs.withColumn("file_no", F.floor(F.col("number") / per_file))
    order = ("file_no", "number", "_d")           # as ``leaves`` places them
    (parts.withColumn("_d", F.sha2(F.col("record").cast("binary"), 256)).repartition("file_no").sortWithinPartitions(*order)
     .select("file_no", F.expr("substring(record, 1, char_length(record) - 1)").alias("value"))       # the writer ends it by \\n
     .write.mode("overwrite").partitionBy("file_no").option("lineSep", "\n").text(path))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, offset, number, record) of every record under ``path``, cut by Content-Length; .gz files too."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                data = gzip.decompress(raw) if name.endswith(".gz") else raw
                out, at = [], 0
                while at < len(data):
                    head_end = data.find(b"\r\n\r\n", at)
                    if head_end < 0:
                        head_end = len(data)
                    head = dict(x.split(b":", 1) for x in data[at:head_end].split(b"\r\n") if b":" in x)
                    length = int(head.get(b"Content-Length", b"0"))
                    number = head.get(b"WARC-Record-ID", b"").strip(b" <>").rpartition(b":")[2]
                    end = min(len(data), head_end + 4 + length + 4)
                    out.append((name, at, int(number) if number.lstrip(b"-").isdigit() else -1, data[at:end]))
                    at = end
                cols = list(zip(*out)) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                                                 ["file", "offset", "number", "record"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(parse, "file string, offset bigint, number bigint, record binary")


def leaves(recs: DataFrame, per_file: int = PER_FILE) -> DataFrame:
    """(number, file_no, offset, length, digest, n, part): offsets run inside each file.

    Records of a file lie by number, then digest; ``n`` equal ones are one row, with the offset of
    the first. A number's records are told apart by the start of their digest, so the offsets of
    a number that very many rows share (null ones, say) are summed by part, then inside each part."""
    cut = recs.select("number", F.octet_length("record").cast("bigint").alias("length"), F.sha2(F.col("record").cast("binary"), 256).alias("digest"))
    same = materialize(cut.groupBy("number", "length", "digest").agg(F.count(F.lit(1)).alias("n"))
                       .withColumn("file_no", F.floor(F.col("number") / per_file)).withColumn("part", F.substring("digest", 1, PART_DIGITS)))
    size, zero = F.col("length") * F.col("n"), F.lit(0).cast("bigint")
    in_file = Window.partitionBy("file_no").orderBy("number", "part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (same.groupBy("file_no", "number", "part").agg(F.sum(size).alias("_l"))
              .select("number", "part", F.coalesce(F.sum("_l").over(in_file), zero).alias("_start")))
    in_part = Window.partitionBy("number", "part").orderBy("digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = same.withColumn("_at", F.coalesce(F.sum(size).over(in_part), zero)).join(starts, ["number", "part"])
    return placed.select("number", "file_no", (F.col("_start") + F.col("_at")).alias("offset"), "length", "digest", "n", "part")


def _node(children: Column) -> Column:
    """Digest of (key, length, digest, count) children in order."""
    line = F.transform(F.sort_array(children), lambda x: F.concat_ws(
        ":", x["key"].cast("string"), x["length"].cast("string"), x["digest"], x["n"].cast("string")))
    return F.sha2(F.array_join(line, ","), 256)


def tree(leaf_rows: DataFrame, low: int, high: int, bits: int = BITS) -> tuple[DataFrame, list[DataFrame]]:
    """The nodes of each number's parts (number, part, length, digest, n), and levels of (key, length,
    digest, n) from the numbers to one root; ``low`` to ``high`` are the numbers they may have."""
    leaf = F.struct(F.col("number").alias("key"), "length", "digest", "n")
    parts = materialize(leaf_rows.groupBy("number", "part").agg(
        F.collect_list(leaf).alias("c"), F.sum(F.col("length") * F.col("n")).alias("length"), F.sum("n").alias("n"))
        .select("number", "part", "length", _node(F.col("c")).alias("digest"), "n"))
    levels = [materialize(_upper(parts.withColumnRenamed("part", "key"), F.col("number")))]
    shift = 0
    while (high >> shift) != (low >> shift) and shift < 60:
        shift += bits
        levels.append(materialize(_upper(levels[-1], F.shiftright("key", bits))))
    levels.append(materialize(_upper(levels[-1], F.lit(0).cast("bigint"))))
    return parts, levels


def _upper(rows: DataFrame, key: Column) -> DataFrame:
    return (rows.withColumn("_k", key).groupBy("_k").agg(
        F.collect_list(F.struct("key", "length", "digest", "n")).alias("c"), F.sum("length").alias("length"),
        F.sum("n").alias("n")).select(F.col("_k").alias("key"), "length", _node(F.col("c")).alias("digest"), "n"))


def _differing(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
    pair = x.select(*keys, F.col("digest").alias("da")).join(y.select(*keys, F.col("digest").alias("db")), keys, "full")
    return materialize(pair.where(~F.col("da").eqNullSafe(F.col("db"))).select(*keys))


def _left_over(rows: DataFrame, others: DataFrame) -> DataFrame:
    """The records of ``rows`` beyond those that ``others`` holds under the same number and digest, one row each,
    numbered inside each number. Very many copies of one record are written out in stretches."""
    held = others.select("number", "digest", F.col("n").alias("_held"))
    over = rows.join(held, ["number", "digest"], "left").withColumn("_held", F.coalesce("_held", F.lit(0))).where("n > _held")
    cut = over.withColumn("_low", F.explode(F.sequence("_held", F.col("n") - 1, F.lit(STRETCH).cast("bigint"))))
    each = cut.withColumn("_i", F.explode(F.sequence("_low", F.least(F.col("_low") + STRETCH, F.col("n")) - 1)))
    single = each.select("number", "file_no", (F.col("offset") + F.col("_i") * F.col("length")).alias("offset"), "length", "digest")
    return group_rank(single, ["number"], [F.col("digest"), F.col("offset")], "_r", strategy="range")


def audit(stored: DataFrame, replica: DataFrame, per_file: int = PER_FILE, bits: int = BITS) -> DataFrame:
    """The damaged records of ``replica`` against ``stored``, both (number, record):
    number, file_no, offset, length, digest, found_length, found_digest, kind.

    Records that repeat a number are matched by digest first; what is left on both sides is
    paired in the order of the digests."""
    a, b = materialize(leaves(stored, per_file)), materialize(leaves(replica, per_file))
    span = a.select("number").unionByName(b.select("number")).agg(F.min("number").alias("lo"), F.max("number").alias("hi")).first()
    lo, hi = span["lo"] or 0, span["hi"] or 0
    (pa_, ta), (pb, tb) = tree(a, lo, hi, bits), tree(b, lo, hi, bits)
    wrong = None                                       # keys that differ at the level above
    for level in range(len(ta) - 1, -1, -1):
        x, y = ta[level], tb[level]
        if wrong is not None:
            up = F.lit(0).cast("bigint") if level == len(ta) - 2 else F.shiftright("key", bits)
            above = wrong.withColumnRenamed("key", "_up")
            x, y = (t.withColumn("_up", up).join(above, "_up", "left_semi") for t in (x, y))
        wrong = _differing(x, y, ["key"])
        if wrong.isEmpty():
            break
    bad = wrong.withColumnRenamed("key", "number")
    spot = _differing(pa_.join(bad, "number", "left_semi"), pb.join(bad, "number", "left_semi"), ["number", "part"])
    mine, other = (t.join(spot, ["number", "part"], "left_semi") for t in (a, b))
    lost = _left_over(mine, other)
    found = _left_over(other, mine).select("number", "_r", F.col("file_no").alias("f2"), F.col("offset").alias("o2"),
                                           F.col("length").alias("found_length"), F.col("digest").alias("found_digest"))
    kind = (F.when(F.col("found_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra")
            .when(F.col("found_length") < F.col("length"), "truncated").otherwise("altered"))
    return lost.join(found, ["number", "_r"], "full").select(
        "number", F.coalesce("file_no", "f2").alias("file_no"), F.coalesce("offset", "o2").alias("offset"), "length", "digest",
        "found_length", "found_digest", kind.alias("kind"))


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica of ``pages`` with planted faults, by number: one in 97 altered, one in 101 cut
    to half, one in 211 lost, one in 307 kept under a new number as well."""
    n = F.col("page_id")
    html = (F.when(n % 97 == 13, F.concat(F.lit("#"), F.expr("substring(html, 2)")))
            .when(n % 101 == 7, F.expr("substring(html, 1, char_length(html) div 2)")).otherwise(F.col("html")))
    kept = pages.where(F.coalesce(n % 211 != 5, F.lit(True))).select("page_id", "url", html.alias("html"))
    extra = pages.where(n % 307 == 3).select((n + F.lit(EXTRA)).alias("page_id"), "url", "html")
    return kept.unionByName(extra)
