"""Periodic runs of words: seeds from an index of word grams, extended along diagonals.

A run of smallest period q repeats itself at lag q over length - q words, at least
``max(6, 4q) - q``: the guaranteed overlap. Lags are taken in classes [2^j, 2^(j+1)); the gram
of a class is the least overlap that its runs guarantee: 5, 6, 12, 24, ... words, never fewer
than a period of the class.

1. Grams of a document are indexed: occurrences of one gram in the order of the text. A gram at
   least as long as the period returns inside a run after exactly one period, so neighbouring
   occurrences are all the pairs that are needed, and pairs never grow with the square of a
   gram's occurrences. A pair whose lag is of the gram's class is a seed.
2. A longer gram only recurs where a shorter one does: after the first class, only documents in
   which a gram recurs go on.
3. Seeds of a lag are taken by position. A table holds for each lag how far the text is covered;
   a seed inside is passed over, any other is extended word by word to both sides.

Words are compared as numbers that are exact inside a batch; grams by 64-bit hashes, which only
choose where to look.

Edge cases: null, empty and blank texts have no words and no runs; a null id plants nothing; a
text is searched whole, however long, and a batch is cut by bytes; repeated rows give equal
results; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordo.llm.common import byte_slices

LEAST, TIMES = 6, 4          # a run has at least this many words, and this many periods
BATCH_BYTES = 2 << 20        # text of the documents that are searched together
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

RESULT = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
          "runs_sha256 string, collapsed_sha256 string")


def overlap(q: int) -> int:
    """Words over which a run of period q agrees with itself at lag q, at the least."""
    return max(LEAST, TIMES * q) - q


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring grams; the order counts."""
    x = a * _A + (b ^ (b >> np.uint64(29))) * _B
    x = (x ^ (x >> np.uint64(32))) * _A
    return x ^ (x >> np.uint64(29))


class _Grams:
    """Hashes of the grams of any length at every place of ``x``; lengths double as they are asked for."""

    def __init__(self, x: np.ndarray):
        first = x.astype(np.uint64) + np.uint64(1)
        self._of = {1: _joined(first, first)}

    def __call__(self, k: int) -> np.ndarray:
        if k not in self._of:
            left = k // 2 if k % 2 == 0 else k - 1
            a, b = self(left), self(k - left)
            shifted = np.zeros_like(b)
            shifted[:len(b) - left] = b[left:]
            self._of[k] = _joined(a, shifted)
        return self._of[k]


def _recurring(grams: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, next places) of neighbouring occurrences of one gram in one document; ``at`` ascends."""
    key = _joined(grams[at], doc[at].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    key, place = key[order], at[order]
    same = key[1:] == key[:-1]
    return place[:-1][same], place[1:][same]


def seeds(x: np.ndarray, doc: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, lags) class by class, over documents laid end to end: ``doc`` is the document of each
    word, ``end`` the place at which that document ends."""
    grams, at, low, home = _Grams(x), np.arange(len(x)), 1, None
    while len(at):
        k = overlap(low)                                   # the least of the class
        at = at[at + k <= end[at]]
        i, j = _recurring(grams(k), at, doc)
        lag = j - i
        mine = (lag >= low) & (lag < 2 * low)
        yield (i if home is None else home[i])[mine], lag[mine]
        at = np.unique(np.concatenate([i, j]))
        if home is None and len(at):                       # only documents in which a gram recurs go on
            some = np.zeros(int(doc[-1]) + 1, bool)
            some[doc[at]] = True
            home = np.flatnonzero(some[doc])
            new = np.cumsum(some[doc]) - 1
            end, at = new[end[home] - 1] + 1, new[at]
            x, doc = x[home], doc[home]
            grams = _Grams(x)
        low *= 2


def _agree(x: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``lag`` further, up to ``stop`` - lag."""
    step = 32
    while at + lag < stop:
        n = min(step, stop - lag - at)
        off = np.flatnonzero(x[at:at + n] != x[at + lag:at + lag + n])
        if len(off):
            return at + int(off[0])
        at, step = at + n, step * 2
    return at


def _agree_back(x: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The least place up to ``at`` from which on all words agree with those ``lag`` further, down to ``stop``."""
    step = 32
    while at > stop:
        n = min(step, at - stop)
        off = np.flatnonzero(x[at - n:at] != x[at - n + lag:at + lag])
        if len(off):
            return at - n + int(off[-1]) + 1
        at, step = at - n, step * 2
    return at


def runs(x: np.ndarray, doc: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of every run, by document, start and period; start counts from the document's first word.

    ``begin`` and ``end`` hold the first place and the end of each document."""
    found, last = [], end[doc] if len(x) else end[:0]
    for places, lags in seeds(x, doc, last):
        order = np.lexsort((places, lags))
        covered: dict[int, int] = {}                       # lag -> how far the diagonal is covered
        for at, lag in zip(places[order].tolist(), lags[order].tolist()):
            if at < covered.get(lag, 0):
                continue
            d = int(doc[at])
            lo, hi = int(begin[d]), int(end[d])
            left, right = _agree_back(x, at, lag, lo), _agree(x, at, lag, hi)
            covered[lag] = max(right, at + 1)
            if right + lag - left >= max(LEAST, TIMES * lag):
                found.append((d, left - lo, right + lag - left, lag))
    return sorted(set(found), key=lambda r: (r[0], r[1], r[3]))


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with a period planted in one of ten documents, by its id."""
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * (-(-(n - a) // p)))[:n - a]


def _report(doc_id: int | None, words: list[bytes], mine: list[tuple[int, int, int]]) -> tuple:
    """A row of RESULT for the runs (start, length, period) of a document."""
    listed = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in mine).encode()).hexdigest()
    kept, best = words, (None, None, None)
    if mine:
        change = np.zeros(len(words) + 1, np.int64)
        best = mine[0]
        for s, n, q in mine:
            change[s + q] += 1
            change[s + n] -= 1
            if n * best[2] > best[1] * q:                  # by start and period, so the first of equals stays
                best = (s, n, q)
        kept = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    milli = None if not mine else 1000 * best[1] // best[2]
    return doc_id, len(mine), best[0], best[1], best[2], milli, listed, hashlib.sha256(b" ".join(kept)).hexdigest()


class _Numbers(dict):
    """Word -> its number in the batch."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def search(ids: list[int | None], texts: list[bytes | None], plant: bool = True) -> list[tuple]:
    """Rows of RESULT for documents that are searched together."""
    numbers, words = _Numbers(), [(t or b"").split() for t in texts]
    if plant:
        words = [planted(w, i) for i, w in zip(ids, words)]
    lengths = np.array([len(w) for w in words], np.int64)
    end = np.cumsum(lengths)
    x = np.empty(int(end[-1]) if len(end) else 0, np.int64)
    for w, e in zip(words, end.tolist()):
        x[e - len(w):e] = np.fromiter(map(numbers.__getitem__, w), np.int64, len(w))
    doc = np.repeat(np.arange(len(words)), lengths)
    mine: dict[int, list[tuple[int, int, int]]] = {}
    for d, s, n, q in runs(x, doc, end - lengths, end):
        mine.setdefault(d, []).append((s, n, q))
    return [_report(i, w, mine.get(d, [])) for d, (i, w) in enumerate(zip(ids, words))]


def detect(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """Runs of every whole text: a row of RESULT per row; ``plant`` puts periods into one of ten documents first."""
    schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in RESULT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text", BATCH_BYTES):
            rows = search(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), plant)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    return docs.mapInArrow(run, RESULT)
