"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes go through ``filters`` learned filters of ``width`` bytes at every
``stride`` bytes. Filter outputs are max-pooled over overlapping chunks (two
neighbouring hops each) that cover the whole text, averaged over the chunks, and a
small dense layer makes one probability of it. A filter is a byte embedding times a
weight matrix; for scoring that product is one table (256 x filters) per byte place,
so a text costs look-ups and additions only.

The network is fitted on the driver on a bounded sample: at most ``max_rows`` labelled
rows, those with the smallest hash of their id (one text of a repeated id), a window of at
most ``max_window`` bytes of each per epoch, out of ``SAMPLE_CHARS`` characters at a place given
by the hash: what is collected is bounded by these. Scoring runs over every byte of every text. Only the text is
an input; ids choose the held-out fifth, and labels the target.

Edge cases: null and empty texts are a text of no bytes (one chunk of padding); with no
labelled row every score is 0.5, with one class it is the smoothed rate; the label of a
repeated id is the rounded mean of its labels; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.session import Generations, arrow_batch_bytes

WIDTH, STRIDE, HOP = 8, 2, 128
FILTERS, EMBED, HIDDEN = 24, 8, 16
MAX_ROWS, MAX_WINDOW, EPOCHS, BATCH = 4000, 4096, 24, 64
MIN_STEPS = 400
SAMPLE_CHARS = 16_384        # of a labelled text that may be learned from
THRESHOLD = 0.3
SLICE_BYTES = 1 << 17
BATCH_BYTES = 1 << 20        # text that goes to a worker at a time


@dataclass
class Network:
    emb: np.ndarray      # 256 x EMBED
    conv: np.ndarray     # WIDTH x EMBED x FILTERS
    bias: np.ndarray     # FILTERS
    dense: np.ndarray    # FILTERS x HIDDEN
    dense_b: np.ndarray
    out: np.ndarray      # HIDDEN
    out_b: np.ndarray    # 1
    constant: float | None = None

    @staticmethod
    def start(seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        n = lambda *s, v=1.0: (r.standard_normal(s) * v).astype(np.float32)
        return Network(n(256, EMBED), n(WIDTH, EMBED, FILTERS, v=(WIDTH * EMBED) ** -0.5), np.zeros(FILTERS, np.float32),
                       n(FILTERS, HIDDEN, v=FILTERS ** -0.5), np.zeros(HIDDEN, np.float32),
                       n(HIDDEN, v=HIDDEN ** -0.5), np.zeros(1, np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.emb, self.conv, self.bias, self.dense, self.dense_b, self.out, self.out_b]

    def tables(self) -> np.ndarray:
        return np.einsum("be,kef->kbf", self.emb, self.conv).astype(np.float32)


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array, each behind ``WIDTH`` zeros and filled up by zeros to whole
    hops, and their hop counts. So no filter sees two texts."""
    hops = np.array([-(-(len(t) + WIDTH) // HOP) for t in texts], np.int64)
    buf = np.zeros(int(hops.sum()) * HOP + WIDTH, np.uint8)
    at = 0
    for t, h in zip(texts, hops):
        buf[at + WIDTH:at + WIDTH + len(t)] = np.frombuffer(t, np.uint8)
        at += int(h) * HOP
    return buf, hops


def pooled(buf: np.ndarray, n_hops: int, tables: np.ndarray, with_place: bool = False):
    """Largest output of each filter in each hop (and where it was)."""
    n = n_hops * (HOP // STRIDE)
    total = tables[0][buf[0:n * STRIDE:STRIDE]]
    for k in range(1, WIDTH):
        total += tables[k][buf[k:k + n * STRIDE:STRIDE]]
    total = total.reshape(n_hops, HOP // STRIDE, -1)
    if not with_place:
        return total.max(axis=1)
    place = total.argmax(axis=1)
    return np.take_along_axis(total, place[:, None, :], 1)[:, 0], place


def chunk_starts(hops: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First hop and second hop of each chunk, and chunks by text: a chunk is two
    neighbouring hops, or the only one."""
    chunks = np.maximum(hops - 1, 1)
    first = np.cumsum(hops) - hops
    owner = np.repeat(np.arange(len(hops)), chunks)
    a = np.arange(len(owner)) - np.repeat(np.cumsum(chunks) - chunks, chunks) + first[owner]
    return a, np.minimum(a + 1, first[owner] + hops[owner] - 1), chunks


def predict(texts: list[bytes], net: Network, tables: np.ndarray) -> np.ndarray:
    """Probability of label 1 of each text, from all of its bytes."""
    if net.constant is not None:
        return np.full(len(texts), net.constant)
    buf, hops = laid_out(texts)
    total = int(hops.sum())
    step = SLICE_BYTES // HOP
    m = np.concatenate([pooled(buf[s * HOP:min(s + step, total) * HOP + WIDTH], min(step, total - s), tables)
                        for s in range(0, total, step)])
    a, b, chunks = chunk_starts(hops)
    z = np.maximum(np.maximum(m[a], m[b]) + net.bias, 0.0)
    mean = np.add.reduceat(z, np.cumsum(chunks) - chunks, axis=0) / chunks[:, None]
    logit = np.tanh(mean @ net.dense + net.dense_b) @ net.out + net.out_b
    return 1.0 / (1.0 + np.exp(-np.clip(logit.astype(np.float64), -30, 30)))


def gradients(texts: list[bytes], labels: np.ndarray, net: Network) -> list[np.ndarray]:
    """Cross-entropy gradients by weight; only the pooled place of a chunk carries them back."""
    buf, hops = laid_out(texts)
    m, place = pooled(buf, int(hops.sum()), net.tables(), with_place=True)
    a, b, chunks = chunk_starts(hops)
    hop = np.where(m[a] >= m[b], a[:, None], b[:, None])                     # chunk x filter
    pre = np.maximum(m[a], m[b]) + net.bias
    z = np.maximum(pre, 0.0)
    starts = np.cumsum(chunks) - chunks
    mean = np.add.reduceat(z, starts, axis=0) / chunks[:, None]
    h = np.tanh(mean @ net.dense + net.dense_b)
    p = 1.0 / (1.0 + np.exp(-np.clip(h @ net.out + net.out_b, -30, 30)))
    d = ((p - labels) / len(labels)).astype(np.float32)
    d_h = d[:, None] * net.out * (1.0 - h * h)
    d_mean = d_h @ net.dense.T
    d_pre = np.repeat(d_mean / chunks[:, None], chunks, axis=0) * (pre > 0)
    at = (hop * (HOP // STRIDE) + np.take_along_axis(place, hop, 0)) * STRIDE
    f = np.broadcast_to(np.arange(FILTERS), at.shape)
    d_tab = np.stack([np.bincount((buf[at + k].astype(np.int64) * FILTERS + f).ravel(), d_pre.ravel(), 256 * FILTERS)
                      for k in range(WIDTH)]).reshape(WIDTH, 256, FILTERS).astype(np.float32)
    return [np.einsum("kbf,kef->be", d_tab, net.conv), np.einsum("be,kbf->kef", net.emb, d_tab), d_pre.sum(axis=0),
            mean.T @ d_h, d_h.sum(axis=0), h.T @ d, np.array([d.sum()])]


def fit(texts: list[bytes], labels: list[int], epochs: int = EPOCHS, max_window: int = MAX_WINDOW, seed: int = 7) -> Network:
    """Adam on minibatches; the seed fixes the result."""
    net = Network.start(seed)
    y = np.array(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        net.constant = float((y.sum() + 1.0) / (len(y) + 2.0))
        return net
    r = np.random.default_rng(seed)
    rounds = max(epochs, -(-MIN_STEPS // -(-len(y) // BATCH)))       # a small sample is seen more often
    moment = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    t, total = 0, rounds * -(-len(y) // BATCH)
    for _ in range(rounds):
        order = r.permutation(len(y))
        for low in range(0, len(y), BATCH):
            pick = order[low:low + BATCH]
            seen = []
            for k in pick:
                start = int(r.integers(0, max(1, len(texts[k]) - max_window + 1)))
                seen.append(texts[k][start:start + max_window])
            t += 1
            rate = 0.01 * 0.5 * (1.0 + np.cos(np.pi * t / total)) + 1e-4
            for w, g, (m, v) in zip(net.weights(), gradients(seen, y[pick], net), moment):
                g = g + 1e-5 * w
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1.0 - 0.9 ** t)) / (np.sqrt(v / (1.0 - 0.999 ** t)) + 1e-8)
    return net


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, mod 5; 0 marks the held-out fifth."""
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(5))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(doc_id, text, quality) of at most about ``max_rows`` labelled rows out of the held-out fifth."""
    marked = (labels.where(F.col("quality").isNotNull() & (remainder(F.col(id_col)) != 0))
              .groupBy(F.col(id_col).alias("_id")).agg(F.round(F.avg("quality")).cast("int").alias("quality"))
              .withColumn("_h", F.xxhash64("_id")))
    last = marked.select("_h").orderBy("_h").limit(max_rows).agg(F.max("_h")).first()[0]
    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("text"))
    few = marked.where(F.col("_h") <= (last if last is not None else 0))
    at = F.pmod(F.xxhash64("_h"), F.greatest(F.char_length("text") - SAMPLE_CHARS, F.lit(0)) + 1).cast("int")
    part = F.substring("text", at + 1, F.lit(SAMPLE_CHARS))
    return (texts.join(few, "_id").select("_id", "quality", part.alias("part"))
            .groupBy("_id", "quality").agg(F.min("part").alias("text")).select(F.col("_id").alias("doc_id"), "text", "quality"))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text",
          epochs: int = EPOCHS, max_window: int = MAX_WINDOW) -> Network:
    rows = training_rows(docs, labels, max_rows, id_col, text_col).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"] or ""))
    return fit([(r["text"] or "").encode() for r in rows], [r["quality"] for r in rows], epochs, max_window)


def score(text: Column, net: Network) -> Column:
    """Probability of label 1 of a text column."""
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = net.tables()
        for series in batches:
            texts = [(t or "").encode() for t in series]
            out, low, size = [], 0, 0
            for k, t in enumerate(texts):          # a slice of about SLICE_BYTES at a time
                size += len(t)
                if size >= SLICE_BYTES or k == len(texts) - 1:
                    out.append(predict(texts[low:k + 1], net, tables))
                    low, size = k + 1, 0
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return F.pandas_udf(scored, "double")(F.coalesce(text.cast("string"), F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    net = train(docs, labels, id_col=id_col, text_col=text_col)
    return (docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(remainder(F.col(f"`{id_col}`")) == 0, F.lit(False)).alias("held_out"),
                        score(F.col(f"`{text_col}`"), net).alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns; written here, so that
    texts go to the workers in small batches."""
    net = train(docs, labels, id_col=id_col, text_col=text_col)
    found = f"_score_{uuid.uuid4().hex}"           # a name that no column of docs has
    good = docs.withColumn(found, score(F.col(f"`{text_col}`"), net)).where(F.col(found) >= THRESHOLD).drop(found)
    with arrow_batch_bytes(docs.sparkSession, BATCH_BYTES):
        return Generations(docs.sparkSession, "good").keep(good)
