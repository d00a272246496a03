import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ordo.llm import mixing, quality
from ordo.llm.common import table

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(size, weights=(1, 2, 3), most=3):
    keys = sorted(size, key=lambda s: (s is None, s or ""))
    w = {k: weights[i % len(weights)] for i, k in enumerate(keys)}
    total, capped, unit = sum(size.values()), set(), 0.0
    while len(capped) < len(keys):
        unit = (total - sum(most * size[k] for k in capped)) / sum(w[k] for k in keys if k not in capped)
        new = {k for k in keys if k not in capped and w[k] * unit >= most * size[k]}
        if not new:
            break
        capped |= new
    return {k: most * size[k] if k in capped else w[k] * unit for k in keys}


def check_mix(rows, docs):
    size, taken, target = collections.Counter(), collections.Counter(), {}
    source = {r["doc_id"]: r["source"] for r in docs}
    text = {r["doc_id"]: r["text"] or "" for r in docs}
    biggest = collections.Counter()
    for r in rows:
        assert r["size"] == len(WORDS.findall(text[r["doc_id"]])) and r["taken"] <= 3 * r["size"]
        s = source[r["doc_id"]]
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        biggest[s] = max(biggest[s], r["size"])
    for s, want in brute_targets(size).items():
        assert target[s] == pytest.approx(want, rel=1e-9, abs=1e-6)
        assert abs(taken[s] - want) <= max(0.02 * want, 0.5 * biggest[s])
    assert all(r["source_size"] == size[source[r["doc_id"]]] for r in rows)


def test_mix_meets_targets_and_repeats(spark, docs):
    rows = mixing.mix(docs).drop("source_key").collect()
    check_mix(rows, docs.collect())
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(3)).drop("source_key").collect())


def test_mix_with_a_hot_source_limits_and_null(spark, docs):
    skew = docs.withColumn("source", F.when(F.col("doc_id") % 20 == 0, "tiny").when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise("hot"))
    rows = mixing.mix(skew).collect()
    check_mix(rows, skew.collect())
    tiny = [r for r in rows if r["doc_id"] % 20 == 0]
    assert all(r["taken"] == 3 * r["size"] for r in tiny)        # at its limit


def test_rates_are_an_exponential_tilt(spark, docs):
    rows = mixing.sized(docs, "doc_id", "text", "source")
    cells = rows.groupBy("source_key", "size").agg(F.count(F.lit(1)).alias("n"))
    goals = mixing.targets(cells.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")))
    duals = {r["source_key"]: r for r in mixing.solve(cells, goals).collect()}
    sums = collections.Counter()
    for r in cells.collect():
        d = duals[r["source_key"]]
        sums[r["source_key"]] += r["n"] * r["size"] * min(3.0, np.exp(d["dual"] * r["size"] / d["scale"]) if d["dual"] < 1e9 else 3.0)
    for r in goals.collect():
        assert sums[r["source_key"]] == pytest.approx(r["target"], rel=1e-5)


def test_mixed_corpus_holds_the_copies(spark, docs):
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in out.collect()) == collections.Counter({k: v for k, v in want.items() if v})


def test_mix_odd_rows(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    assert mixing.mix(none).count() == 0
    out = mixing.apply_mix(odd)
    assert out.columns == odd.columns
    assert out.count() == sum(r["copies"] for r in rows)


def test_pooling_covers_every_byte():
    net = quality.Network.start(3)
    tables = net.tables()
    text = bytes(np.random.default_rng(0).integers(1, 256, 1000, dtype=np.uint8))
    buf, hops = quality.laid_out([text])
    got = quality.pooled(buf, int(hops[0]), tables).max(axis=0)
    pad = bytes(quality.WIDTH) + text + bytes(quality.WIDTH * 40)
    want = np.max([sum(tables[k][pad[i + k]] for k in range(quality.WIDTH)) for i in range(0, len(buf) - quality.WIDTH, quality.STRIDE)], axis=0)
    assert np.allclose(got, want, atol=1e-4)


def test_gradients_equal_differences():
    net = quality.Network.start(5)
    for w in net.weights():
        w[...] = w.astype(np.float32)
    texts = [b"some plain words here. " * 20, b"###&&& junk%%% " * 30, b"x"]
    y = np.array([1, 0, 1], np.float32)

    def loss():
        p = quality.predict(texts, net, net.tables())
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    found = quality.gradients(texts, y, net)
    for w, g in zip(net.weights(), found):
        flat, at = w.reshape(-1), int(np.abs(g).reshape(-1).argmax())
        old, eps = flat[at], 2e-3
        flat[at] = old + eps
        up = loss()
        flat[at] = old - eps
        down = loss()
        flat[at] = old
        assert (up - down) / (2 * eps) == pytest.approx(float(g.reshape(-1)[at]), rel=0.1, abs=2e-4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels")).join(table(spark, sf, "labels"), "doc_id").collect()
    out = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in out]) >= 0.93
    good = [r["score"] for r in out if r["quality"] == 1]
    bad = [r["score"] for r in out if r["quality"] == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.97
    assert np.mean([g >= 0.3 for g in good]) >= 0.98


def test_scores_do_not_depend_on_batches_or_other_columns(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 0), (9, 0, 1), (5, None, 0), (4, 1, 0)], "doc_id bigint, quality int, toxic int")
    net = quality.fit([b"plain words", b"### junk ###"] * 10, [1, 0] * 10, epochs=2)
    texts = [b"a b c", b"", b"###" * 5000]
    alone = [quality.predict([t], net, net.tables())[0] for t in texts]
    assert np.allclose(alone, quality.predict(texts, net, net.tables()), atol=1e-6)
    rows = quality.classify(odd, labels).collect()
    assert len(rows) == odd.count() and all(0.0 <= r["score"] <= 1.0 for r in rows)
    assert quality.keep_good(odd, labels).columns == odd.columns
    empty = labels.limit(0)
    assert {r["score"] for r in quality.classify(odd, empty).collect()} == {0.5}
    assert quality.classify(none, labels).count() == 0
