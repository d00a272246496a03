"""Language of a text by prediction by partial matching (PPM) over bytes.

Each language has a context tree: for contexts of 0 to ``ORDER`` bytes, how often each next byte
followed. The trees are counted by Spark on a sample of labelled rows and frozen. The code length
of a byte is that of PPM with escape method C: take the longest context that the tree knows; with
``t`` occurrences and ``d`` distinct next bytes, a byte seen ``c`` times has probability
``c / (t + d)``, any other costs the escape ``d / (t + d)`` and the next shorter context decides;
under the empty context a byte costs 8 bits. A text is preceded by ``ORDER`` zero bytes. A code
length is a whole number of 2^-16 bits, so the sum over a text depends on neither order nor
batches. The language with the least sum is predicted (ties: the smallest name by code point).

Scoring reads every byte of every text. In a batch each distinct run of ``ORDER`` + 1 bytes is
looked up once, for all languages together.

The sample: ``ROWS_EACH`` rows at most of a language, one of each of as many hash classes (the
least hash), and a window of ``WINDOW`` bytes of each, at a place given by the hash. So the trees,
which pass through the driver, hold at most ``ROWS_EACH * WINDOW`` bytes of a language (0.5 MB),
whatever the input.

Edge cases: null texts and texts without a letter are ``und`` with score 0; null ids are neither
held out nor learned from; null labels are not learned from; without any labelled row all is
``und``; repeated rows count once in the sample and get equal results; an empty table gives an
empty table; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.llm.common import byte_slices

ORDER = 4                    # bytes of the longest context
ROWS_EACH = 256              # rows of a language that are learned from, at most
WINDOW = 2048                # bytes of each
FOLDS, HELD_OUT = 4, 2       # rows with crc32(id) mod 4 = 2 are never learned from
UNIT = 1 << 16               # code lengths count in parts of a bit
UNKNOWN = "und"
BATCH_BYTES = 1 << 20        # text that is scored together
RESULT = "doc_id bigint, held_out boolean, lang_pred string, score double"


def held_out(id_col: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def sample(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
           rows_each: int = ROWS_EACH, window: int = WINDOW) -> DataFrame:
    """(lang, part): the windows that are learned from, ``rows_each`` a language at most."""
    ident, text, label = F.col(f"`{id_col}`").cast("bigint"), F.col(f"`{text_col}`").cast("string"), F.col(f"`{label_col}`").cast("string")
    rows = (df.where(ident.isNotNull() & ~held_out(ident) & label.isNotNull() & (F.length(text) > 0))
            .select(label.alias("lang"), text.alias("text"), F.xxhash64(ident, text).alias("h")))
    least = rows.groupBy("lang", F.pmod("h", F.lit(rows_each)).alias("c")).agg(F.min("h").alias("h")).select("lang", "h")
    # ``least`` has rows_each rows a language at most; labels that are no languages would make it large, then it is shuffled.
    n = least.count()
    picked = rows.join(F.broadcast(least) if n <= 64 * rows_each else least, ["lang", "h"])
    raw = F.encode("text", "UTF-8")
    at = F.pmod(F.xxhash64("h"), F.greatest(F.octet_length("text") - window, F.lit(0)) + 1).cast("int")
    return picked.select("lang", "h", F.substring(raw, at + 1, F.lit(window)).alias("part")).groupBy("lang", "h").agg(
        F.first("part").alias("part")).select("lang", "part")


def packed(data: bytes, starts: np.ndarray, order: int = ORDER) -> np.ndarray:
    """For each byte the number made of the ``order`` bytes before it and itself; texts begin at
    ``starts`` (with zero bytes before them) and lie end to end."""
    b = np.frombuffer(data, np.uint8)
    gram = b.astype(np.int64)
    since = np.arange(len(b)) - np.repeat(starts, np.diff(np.append(starts, len(b))))
    for k in range(1, order + 1):
        before = np.zeros(len(b), np.int64)
        before[k:] = b[:-k] if k < len(b) else 0
        gram |= np.where(since >= k, before, 0) << (8 * k)
    return gram


def counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, k, gram, n): how often each byte follows each context of k bytes, over ``rows`` (lang, part)."""
    schema = pa.schema([("lang", pa.string()), ("k", pa.int64()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, part in zip(batch.column("lang").to_pylist(), batch.column("part").to_pylist()):
                if not part:
                    continue
                grams = packed(part, np.zeros(1, np.int64), order)
                for k in range(order + 1):
                    g, n = np.unique(grams & ((1 << (8 * (k + 1))) - 1), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g)), pa.array(np.full(len(g), k)), pa.array(g), pa.array(n)], schema=schema)

    return rows.mapInArrow(run, "lang string, k bigint, gram bigint, n bigint").groupBy("lang", "k", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Trees:
    """The frozen trees of all languages, one table of contexts and one of next bytes per order."""
    langs: list[str]
    grams: list[np.ndarray]       # by order: context and next byte, ascending
    hit: list[np.ndarray]         # by order: (gram, language) code length of the byte, -1 where it was not seen
    contexts: list[np.ndarray]    # by order: contexts, ascending
    escape: list[np.ndarray]      # by order: (context, language) code length of the escape, 0 where the context is unknown

    def lengths(self, grams: np.ndarray) -> np.ndarray:
        """(gram, language) code length of the last byte of each gram after the others."""
        total = np.zeros((len(grams), len(self.langs)), np.int64)
        open_ = np.ones(total.shape, bool)
        for k in range(len(self.grams) - 1, -1, -1):
            part = grams & ((1 << (8 * (k + 1))) - 1)
            for keys, table, seen in ((self.grams[k], self.hit[k], True), (self.contexts[k], self.escape[k], False)):
                wanted = part if seen else part >> 8
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                cost = np.where((keys[at] == wanted)[:, None], table[at], -1 if seen else 0)
                now = open_ & (cost >= 0)
                total[now] += cost[now]
                if seen:
                    open_ &= cost < 0
        return total + np.where(open_, 8 * UNIT, 0)


def bits(p: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(p) * UNIT).astype(np.int64)


def grow(rows: list[tuple[str, int, int, int]], order: int = ORDER) -> Trees | None:
    """The trees of counts (lang, k, gram, n); None where there are none."""
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    number = {lang: i for i, lang in enumerate(langs)}
    lang, k, gram, n = (np.array(c, np.int64) for c in zip(*((number[r[0]], r[1], r[2], r[3]) for r in rows)))
    found = Trees(langs, [], [], [], [])
    for o in range(order + 1):
        mine = k == o
        grams, g = np.unique(gram[mine], return_inverse=True)
        contexts, c = np.unique(gram[mine] >> 8, return_inverse=True)
        seen = np.zeros((len(contexts), len(langs)), np.int64)
        distinct = np.zeros_like(seen)
        np.add.at(seen, (c, lang[mine]), n[mine])
        np.add.at(distinct, (c, lang[mine]), 1)
        hit = np.full((len(grams), len(langs)), -1, np.int64)
        hit[g, lang[mine]] = bits(n[mine] / (seen + distinct)[c, lang[mine]])
        escape = np.where(seen > 0, bits(np.maximum(distinct, 1) / np.maximum(seen + distinct, 1)), 0)
        for held, value in zip((found.grams, found.hit, found.contexts, found.escape), (grams, hit, contexts, escape)):
            held.append(value)
    return found


def learn(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", order: int = ORDER,
          rows_each: int = ROWS_EACH, window: int = WINDOW) -> Trees | None:
    """The trees of the languages in ``label_col``; what is collected is bounded by the sample."""
    found = counts(sample(df, id_col, text_col, label_col, rows_each, window), order).toArrow()
    return grow(list(zip(*(found.column(c).to_pylist() for c in ("lang", "k", "gram", "n")))), order)


def code_lengths(trees: Trees, texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """(text, language) code length of whole texts, in parts of a bit."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.zeros((len(texts), len(trees.langs)), np.int64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = np.cumsum(sizes[some]) - sizes[some]
        grams, inverse = np.unique(packed(b"".join(texts), starts, order), return_inverse=True)
        table = trees.lengths(grams)
        for lang in range(out.shape[1]):
            out[some, lang] = np.add.reduceat(table[:, lang][inverse], starts)
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def predicted(lengths: np.ndarray, langs: list[str]) -> list[tuple[str, float]]:
    """(language, its posterior under equal priors) of each row of code lengths."""
    best = lengths.argmin(axis=1)
    behind = (lengths - lengths.min(axis=1, keepdims=True)) / UNIT
    share = 1.0 / np.exp2(-np.minimum(behind, 1000.0)).sum(axis=1)
    return [(langs[b], float(s)) for b, s in zip(best, share)]


def predict(df: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """RESULT of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
    ident = F.col(f"`{id_col}`").cast("bigint")
    docs = df.select(ident.alias("doc_id"), held_out(ident).alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shared = df.sparkSession.sparkContext.broadcast(trees)       # bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in byte_slices(batches, "text", BATCH_BYTES):
            texts = part.column("text").to_pylist()
            spoken = [k for k, t in enumerate(texts) if model is not None and t and has_letter(t)]
            result: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
            if spoken:
                for k, r in zip(spoken, predicted(code_lengths(model, [texts[k].encode() for k in spoken]), model.langs)):
                    result[k] = r
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array([r[0] for r in result], pa.string()),
                                              pa.array([r[1] for r in result], pa.float64())], schema=schema)

    return docs.mapInArrow(run, RESULT)


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Trees learned from the rows that are not held out, and the prediction of every row."""
    return predict(df, learn(df, id_col, text_col, label_col), id_col, text_col)
