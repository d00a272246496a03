"""Pattern packing: few-document length patterns fitted to the length histogram.

1. Texts are tokenised once; an over-long document is cut into full pieces, the first
   may be shorter. Only (doc_id, piece, start, length, checksum) goes on.
2. The histogram has ``max_len`` entries at most, so it travels to the driver, whatever
   the input. There ``plan`` enumerates all patterns of one to three lengths that fill
   a sequence exactly, fits their repeat counts to the histogram by non-negative least
   squares, and rounds them down to what the histogram has.
3. The residual histogram is packed best-fit, longest first, by counts: many equal
   sequences at once.
4. The plan says, for each length, which of its pieces (by rank) go where. Pieces are
   ranked inside (length, bucket) groups with bucket offsets, so a length that holds a
   third of all pieces is spread over many tasks, and each looks up its place.

Edge cases: null and empty texts are one end token; repeated rows are packed each on
their own; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordo.llm.common import byte_slices, materialize
from ordo.session import arrow_batch_bytes

MAX_LEN = 1024
END_ID = 2
BUCKET_ROWS = 20_000          # pieces of one length that a task ranks together
MEMO_WORDS = 200_000          # words whose ids a worker keeps
BATCH_BYTES = 1 << 20         # text that a worker encodes at a time
FIT_STEPS = 300

# The split of the byte-level BPE vocabulary, for texts of ASCII and Latin-1 letters.
# Any other text, and one that holds an added token's content, is encoded as a whole.
_L, _S = "A-Za-zÀ-ÖØ-öø-ÿ", "\t-\r "
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[0-9]+| ?[^{_S}{_L}0-9]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_OTHER = re.compile(rf"[^{_S}!-~{_L}]")


class WordIds(dict):
    """Word -> its ids as little-endian unsigned 32-bit bytes, filled as words come up.

    Merges never cross the words of the vocabulary's split, so a text's ids are its
    words' ids in turn. The memo is emptied when it is full."""

    def __init__(self, tokenizer_path: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.letters = {b: chr(b) for b in plain} | {b: chr(0x100 + k) for k, b in enumerate(rest)}

    def __missing__(self, word: str) -> bytes:
        letters = word.encode("utf-8").decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(letters)]
        found = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = found
        return found

    def encode(self, text: str) -> bytes:
        if _OTHER.search(text) or any(t in text for t in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join(map(self.__getitem__, _WORD.findall(text)))


def cuts(n: int, max_len: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; the first takes the remainder."""
    first = n % max_len or max_len
    return [(0, first), *((s, max_len) for s in range(first, n, max_len))]


def tokenise(df: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID, id_col: str = "doc_id",
             text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32[, ids]) of every document."""
    end = struct.pack("<I", end_id)
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordIds(tokenizer_path)
        for batch in byte_slices(batches, "text", BATCH_BYTES):
            row, out, ids = [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                raw = memo.encode(text or "") + end
                for p, (start, length) in enumerate(cuts(len(raw) // 4, max_len)):
                    part = raw[4 * start:4 * (start + length)]
                    row.append(k)
                    out.append((p, start, length, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<i4"))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [batch.column("doc_id").take(pa.array(row, pa.int64())),
                      *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(pieces, schema)


def patterns(max_len: int) -> np.ndarray:
    """All multisets of one to three lengths with sum ``max_len``; unused places are 0."""
    found = [(max_len, 0, 0)]
    found += [(a, max_len - a, 0) for a in range((max_len + 1) // 2, max_len)]
    for a in range(-(-max_len // 3), max_len - 1):
        rest = max_len - a
        b = np.arange(-(-rest // 2), min(a, rest - 1) + 1)
        found += [(a, int(x), rest - int(x)) for x in b]
    return np.array(found, dtype=np.int64)


def fit(hist: np.ndarray, pats: np.ndarray, steps: int = FIT_STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that make the patterns' lengths meet the histogram, least squares.

    Accelerated projected gradient on the sparse pattern matrix. Lengths weigh by their
    square root share: a long piece that is left over costs more than a short one."""
    weight = np.sqrt(np.arange(len(hist)) / (len(hist) - 1))
    weight[0] = 0.0
    scale = max(1.0, float(hist.max()))
    want = weight * hist / scale

    def lengths(x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(hist))
        for c in range(pats.shape[1]):
            total += np.bincount(pats[:, c], x, len(hist))
        return weight * total

    def back(r: np.ndarray) -> np.ndarray:
        r = weight * r
        return r[pats].sum(axis=1)

    v = np.ones(len(pats))
    for _ in range(20):                    # largest squared singular value, for the step
        v = back(lengths(v))
        v /= np.linalg.norm(v)
    step = 1.0 / (1.05 * float(v @ back(lengths(v))))
    x = y = np.zeros(len(pats))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - step * back(lengths(y) - want))
        t_new = (1.0 + np.sqrt(1.0 + 4.0 * t * t)) / 2.0
        if (y - new) @ (new - x) > 0:      # overshoot: restart the momentum
            y, t = new, 1.0
        else:
            y, t = new + (t - 1.0) / t_new * (new - x), t_new
        x = new
    return x * scale


def best_fit(left: np.ndarray, max_len: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) that pack the histogram ``left``, longest first, each into the
    open sequence with the least room that holds it. Equal sequences go together."""
    done: list[tuple[tuple[int, ...], int]] = []
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(lengths: tuple[int, ...], n: int) -> None:
        room = max_len - sum(lengths)
        if room == 0:
            done.append((lengths, n))
            return
        if room not in open_by_room:
            open_by_room[room] = []
            insort(rooms, room)
        open_by_room[room].append((lengths, n))

    for length in range(max_len, 0, -1):
        n = int(left[length])
        while n:
            k = int(np.searchsorted(rooms, length))
            if k == len(rooms):
                per = max_len // length
                if n >= per:
                    put((length,) * per, n // per)
                if n % per:
                    put((length,) * (n % per), 1)
                break
            room = rooms[k]
            lengths, have = open_by_room[room].pop()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(k)
            per = min(room // length, n)
            take = min(have, n // per)
            if have > take:
                if room not in open_by_room:
                    open_by_room[room] = []
                    insort(rooms, room)
                open_by_room[room].append((lengths, have - take))
            put(lengths + (length,) * per, take)
            n -= take * per
    return done + [x for group in open_by_room.values() for x in group]


@dataclass(frozen=True)
class Plan:
    """Where the pieces of each length go: the r-th piece (from 0) of a length falls in the
    last interval with ``low <= r``; the intervals of a length stand from ``first[length]``
    to ``first[length + 1]``."""

    first: np.ndarray
    low: np.ndarray
    sequence: np.ndarray     # number of the interval's first sequence
    per: np.ndarray          # pieces of this length in one sequence
    offset: np.ndarray       # place of the first of them
    n_sequences: int
    fitted: int              # sequences that came from fitted patterns

    def look_up(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.empty(len(length), np.int64)
        for x in np.unique(length):
            here = length == x
            a, b = self.first[x], self.first[x + 1]
            at[here] = a + np.searchsorted(self.low[a:b], rank[here], "right") - 1
        inside = rank - self.low[at]
        return self.sequence[at] + inside // self.per[at], self.offset[at] + inside % self.per[at] * length


def plan(hist: np.ndarray, max_len: int = MAX_LEN) -> Plan:
    """Fit, round, pack the rest; ``hist[length]`` counts pieces of that length."""
    hist = np.asarray(hist, dtype=np.int64)
    pats = patterns(max_len)
    pats = pats[((hist[pats] > 0) | (pats == 0)).all(axis=1)]      # only lengths that occur
    left, used = hist.copy(), []
    if len(pats):
        counts = fit(hist, pats)
        for k in np.argsort(-counts, kind="stable"):
            n = int(counts[k])
            if n == 0:
                break
            lengths, times = np.unique(pats[k][pats[k] > 0], return_counts=True)
            n = min(n, int((left[lengths] // times).min()))
            if n:
                left[lengths] -= n * times
                used.append((tuple(int(x) for x in pats[k] if x), n))
    fitted = sum(n for _, n in used)
    used += best_fit(left, max_len)
    by_length: list[list[tuple[int, int, int, int]]] = [[] for _ in range(max_len + 2)]
    taken, sequences = np.zeros(max_len + 2, np.int64), 0
    for lengths, n in used:
        offset = 0
        for x in sorted(set(lengths), reverse=True):
            per = lengths.count(x)
            by_length[x].append((int(taken[x]), sequences, per, offset))
            taken[x] += n * per
            offset += per * x
        sequences += n
    rows = np.array([r for group in by_length for r in group], np.int64).reshape(-1, 4)
    first = np.concatenate([[0], np.cumsum([len(g) for g in by_length])])
    return Plan(first, rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], sequences, fitted)


def histogram(pieces: DataFrame, max_len: int) -> np.ndarray:
    """Pieces by length; ``max_len`` numbers reach the driver at most."""
    hist = np.zeros(max_len + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        hist[r["length"]] = r["count"]
    return hist


def place(pieces: DataFrame, the_plan: Plan, hist: np.ndarray, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add sequence_id and offset to each piece by its rank among the pieces of its length."""
    buckets = int(max(64, -(-int(hist.max(initial=0)) // bucket_rows)))
    keyed = pieces.withColumn("_b", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = (keyed.withColumn("_r", inside).join(starts, ["length", "_b"])
              .withColumn("sequence_id", (F.col("_start") + F.col("_r") - 1).cast("bigint"))
              .withColumn("offset", F.lit(0).cast("bigint")).select(*pieces.columns, "sequence_id", "offset"))
    schema, names = ranked.schema, pieces.columns

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = the_plan.look_up(batch.column("length").to_numpy(zero_copy_only=False),
                                                batch.column("sequence_id").to_numpy(zero_copy_only=False))
            arrays = [batch.column(c) for c in names] + [pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(found, schema)


def pack(df: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    with arrow_batch_bytes(df.sparkSession, BATCH_BYTES):
        pieces = materialize(tokenise(df, tokenizer_path, max_len, end_id, id_col, text_col))
    hist = histogram(pieces, max_len)
    return place(pieces, plan(hist, max_len), hist, bucket_rows)


def sequences(placed: DataFrame, df: DataFrame, tokenizer_path: str, max_len: int = MAX_LEN, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed training sequences: sequence_id, ids, doc_ids and lengths by offset.

    Needs distinct doc_ids. A group is one sequence, ``max_len`` ids at most."""
    ids = tokenise(df, tokenizer_path, max_len, end_id, id_col, text_col, with_ids=True).select("doc_id", "piece", "ids")
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    return (placed.join(ids, ["doc_id", "piece"]).groupBy("sequence_id").agg(parts.alias("p"))
            .select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"),
                    F.col("p.length").alias("lengths")))
