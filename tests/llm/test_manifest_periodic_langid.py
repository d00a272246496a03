"""Merkle manifest, periodic runs and language identification against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ordo.llm import langid, manifest, periodic
from ordo.llm.common import byte_slices
from ordo.llm.queries import ORACLES, QUERIES
from ordo.session import Generations


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda t: tuple((x is not None, x) for x in t))


# Manifest

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    leaf = lambda r: sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in r])
    low = lambda s: None if s is None else re.sub("[A-Z]", lambda m: m[0].lower(), s)
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append(r)

    def tree(ls):
        lv = [ls]
        while len(lv[-1]) > 1:
            lv.append([sha(*lv[-1][i:i + 16]) for i in range(0, len(lv[-1]), 16)])
        return lv

    def path(lv, i):
        out = []
        for level in lv[:-1]:
            b = i // 16 * 16
            out.append((level[b:i], level[i + 1:b + 16]))
            i //= 16
        return out

    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            p = path(trees[s], i) + path(top, k)
            h = leaf((*r[:4], low(r[4]))) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else leaf(r)
            for a, b in p:
                h = sha(*a, h, *b)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], sha(*[x for a, b in p for x in (*a, *b)]), h, h == top[-1][0]))
    return out


FIVE = "doc_id long, source string, lang string, n_chars long, text string"


def test_manifest_query_and_sql_equal_brute_force(spark, sf):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    want = brute_manifest(con.sql("select doc_id, source, lang, n_chars, text from documents").fetchall())
    assert ordered(QUERIES["op11_merkle_manifest"](spark, sf).collect()) == ordered(want)
    assert ordered(con.sql(ORACLES["op11_merkle_manifest"]).fetchall()) == ordered(want)
    assert {r[6] for r in want} == {True, False}


@pytest.mark.parametrize("hot", [0, 12_000])
def test_manifest_of_nulls_ties_extreme_ids_and_a_hot_id(spark, hot):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 7, 7, -5, 2 ** 62, -2 ** 63, 2 ** 63 - 1, rnd.randrange(-10 ** 6, 10 ** 6), rnd.randrange(50)]),
             rnd.choice([None, "", "a", "é", f"s{k}"]), rnd.choice([None, "en"]), rnd.choice([None, 3]),
             rnd.choice([None, "", "Abc", f"x{rnd.randrange(3)}"])) for k in range(600)]
    rows += [(7, "a", "en", 1, f"T{k % 700}") for k in range(hot)]
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], FIVE + ", total int, place int, leaf int, grp int")
    assert ordered(manifest.audit(df).collect()) == ordered(brute_manifest(rows))


def test_manifest_of_odd_and_empty_tables(spark, odd, none):
    rows = [tuple(r) for r in odd.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert ordered(manifest.audit(odd).collect()) == ordered(brute_manifest(rows))
    assert manifest.audit(none).collect() == []


def test_bitmaps_of_parts_merge_to_the_bitmap_of_all(spark):
    rows = spark.range(5000).select((F.col("id") * 37 % 9000).alias("id"), F.concat(F.lit("="), F.col("id") % 3).alias("grp"))
    whole = manifest.bitmap(rows)
    parts = manifest.merge(*[manifest.bitmap(rows.where(F.col("id") % 2 == k)) for k in range(2)])
    assert ordered(whole.collect()) == ordered(parts.collect())
    gens = Generations(spark, "test")
    start = manifest.directory(whole, gens).collect()
    ids = defaultdict(list)
    for r in rows.collect():
        ids[r["grp"]].append(r["id"])
    assert all(r["start"] == sum(i < r["word"] * 64 for i in ids[r["grp"]]) and r["total"] == len(ids[r["grp"]]) for r in start)


# Periodic runs

def brute_runs(text, doc_id, plant=True):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text or b"")
    n = len(w)
    if doc_id is not None and plant:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length, seg = i + q - s, w[s:i + q]
            if length >= max(6, 4 * q) and not any(all(seg[t] == seg[t + r] for t in range(length - r)) for r in range(1, q)):
                found.append((s, length, q))
    found.sort(key=lambda r: (r[0], r[2]))
    gone = {t for s, length, q in found for t in range(s + q, s + length)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for t, x in enumerate(w) if t not in gone)).hexdigest())


def test_runs_equal_brute_force_on_random_texts():
    rnd = random.Random(1)
    for _ in range(120):
        ids, texts = [], []
        for _ in range(12):
            n, letters, w = rnd.choice([0, 1, 3, 6, 7, 20, 60, 120]), rnd.choice([1, 2, 3, 30]), []
            while len(w) < n:
                if rnd.random() < .5:
                    w += [str(rnd.randrange(letters)) for _ in range(rnd.randint(1, 9))]
                else:
                    p = [str(rnd.randrange(letters)) for _ in range(rnd.choice([1, 2, 3, 5, 8, 13]))]
                    w += p * rnd.randint(2, 7) + p[:rnd.randrange(len(p))]
            ids.append(rnd.choice([None, rnd.randrange(10 ** 6)]))
            texts.append(rnd.choice([" ", "\n", " \t "]).join(w[:n]).encode() if rnd.random() > .05 else None)
        assert periodic.search(ids, texts) == [brute_runs(t, i) for t, i in zip(texts, ids)]


def test_runs_query_equals_brute_force(spark, sf, docs):
    short = docs.where(F.length("text") < 1500)          # brute force takes the square of a text
    want = [brute_runs(r["text"].encode(), r["doc_id"]) for r in short.collect()]
    got = QUERIES["op12_periodic_runs"](spark, sf).join(short.select("doc_id"), "doc_id", "left_semi").collect()
    assert len(want) > 50 and ordered(got) == ordered(want)
    assert QUERIES["op12_periodic_runs"](spark, sf).count() == docs.count()


def test_runs_of_very_long_texts():
    one = b"a " * 200_000
    cycle = b" ".join(b"w%d" % (i % 5000) for i in range(200_000))
    nested = b" ".join([b"x y x y x y x y z"] * 4000)
    got = periodic.search([1, 2, 3], [one, cycle, nested], plant=False)
    assert [r[1:6] for r in got[:2]] == [(1, 0, 200_000, 1, 200_000_000), (1, 0, 200_000, 5000, 40_000)]
    assert got[2][1:6] == (4001, 0, 36_000, 9, 4_000_000)


def test_runs_of_odd_and_empty_tables(spark, odd, none):
    got = {(r["doc_id"], r["n_runs"]) for r in periodic.detect(odd).collect()}
    assert (1, 0) in got and (2, 0) in got and (None, 0) in got and (5, 1) in got and len(got) == 10
    assert periodic.detect(odd).count() == odd.count()
    assert periodic.detect(none).collect() == []


def test_byte_slices_cut_by_bytes_and_keep_every_row():
    import pyarrow as pa
    texts = ["x" * n for n in (5, 0, 9, 30, 1, 1, 1)] + [None]
    parts = list(byte_slices([pa.RecordBatch.from_pydict({"text": texts})], "text", 10))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts
    assert [p.num_rows for p in parts] == [3, 1, 4]


# Language identification

def brute_length(parts, text, order):
    """Code length of ``text`` in 2^-16 bits, straight from the definition, for a tree over ``parts``."""
    tree = defaultdict(Counter)
    for p in parts:
        data = b"\0" * order + p
        for i in range(order, len(data)):
            for k in range(order + 1):
                tree[data[i - k:i]][data[i]] += 1
    total, data = 0, b"\0" * order + text
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = tree.get(data[i - k:i])
            if seen is None:
                continue
            whole = sum(seen.values()) + len(seen)
            hit = data[i] in seen
            total += round(-math.log2((seen[data[i]] if hit else len(seen)) / whole) * 65536)
            if hit:
                break
        else:
            total += 8 * 65536
    return total


def test_code_lengths_equal_the_definition(spark):
    rnd = random.Random(5)
    word = lambda s: bytes(rnd.choice(s) for _ in range(rnd.randrange(1, 60)))
    parts = {"a": [word(b"abc ") for _ in range(20)], "b": [word(b"abcdef ") for _ in range(20)], "c": [word(bytes(range(256))) for _ in range(9)]}
    rows = spark.createDataFrame([(lang, bytearray(p)) for lang, ps in parts.items() for p in ps], "lang string, part binary")
    found = langid.counts(rows).collect()
    trees = langid.grow([tuple(r) for r in found])
    texts = [word(b"abcdefgh ") for _ in range(30)] + [b"", b"\0\0a", bytes(range(256))]
    want = [[brute_length(parts[lang], t, langid.ORDER) for lang in "abc"] for t in texts]
    assert langid.code_lengths(trees, texts).tolist() == want
    assert np.concatenate([langid.code_lengths(trees, [t]) for t in texts]).tolist() == want


def test_held_out_texts_get_their_language(spark, sf, docs):
    got = QUERIES["op13_ppm_language"](spark, sf)
    assert got.count() == docs.count()
    both = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert {r["doc_id"] for r in both if r["held_out"]} == {r["doc_id"] for r in both if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    held = [r["lang"] == r["lang_pred"] for r in both if r["held_out"]]
    assert sum(held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in both)


def test_nothing_of_held_out_rows_is_learned_and_the_sample_is_bounded(spark, docs):
    least = langid.sample(docs, rows_each=8, window=64)
    assert {r["lang"]: r["count"] for r in least.groupBy("lang").count().collect()}.keys() == {"en", "de", "fr", "es"}
    assert all(len(r["part"]) <= 64 for r in least.collect())
    assert max(r["count"] for r in least.groupBy("lang").count().collect()) <= 8
    changed = docs.withColumn("text", F.when(langid.held_out(F.col("doc_id")), F.lit("zzz")).otherwise(F.col("text")))
    assert ordered((r["lang"], bytes(r["part"])) for r in least.collect()) == ordered(
        (r["lang"], bytes(r["part"])) for r in langid.sample(changed, rows_each=8, window=64).collect())


def test_languages_of_odd_and_empty_tables(spark, odd, none, docs):
    trees = langid.learn(docs)
    got = langid.predict(odd, trees).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (1, 2, 3)) and by[7]["lang_pred"] != "und"
    digits = spark.createDataFrame([(1, "12 34 ... 5"), (2, "²³½"), (3, "日本")], "doc_id long, text string")
    assert [r["lang_pred"] == "und" for r in langid.predict(digits, trees).orderBy("doc_id").collect()] == [True, True, False]
    assert langid.identify(none).collect() == []
    bare = docs.limit(5).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify(bare).collect()} == {"und"}
    same = langid.identify(odd).collect()
    assert len(same) == odd.count() and len({(r["lang_pred"], r["score"]) for r in same if r["doc_id"] == 7}) == 1
