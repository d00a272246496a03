import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ordo.llm import fixity, neardup, sketch, topk
from ordo.llm.common import table
from ordo.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(sets, percent=80):
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def planted(seed, groups=12, chain=6):
    """Chains of near copies, texts that share a passage, exact copies and short texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(4))
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(groups):
        w = [word() for _ in range(r.choice([3, 6, 20, 60]))]
        for _ in range(chain):
            out.append(" ".join(w))
            w = w[:]
            w[r.randrange(len(w))] = word()
        out.append(" ".join(passage + [word() for _ in range(r.choice([8, 20, 60]))]))
        out.append(out[-2].upper())
    r.shuffle(out)
    return out


@pytest.mark.parametrize("words_each", [2, 5])
def test_components_equal_brute_force(spark, words_each):
    texts = dict(enumerate(planted(words_each)))
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sets = {k: shingles(t, words_each) for k, t in texts.items()}
    want = brute_components(sets)
    for r in neardup.groups(df, words_each=words_each).collect():
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])


def test_query_equals_brute_force(spark, sf, texts):
    sets = {k: shingles(t, 2) for k, t in texts.items()}
    want = brute_components(sets)
    assert {r["doc_id"]: r["component_id"] for r in QUERIES["op8_minhash_neardup"](spark, sf).collect()} == want


@pytest.mark.parametrize("copies", [10, 30])
def test_one_bucket_with_a_stranger_and_a_chain(spark, copies):
    # The stranger is like nothing; each text of the chain is like its neighbours only.
    base = [f"w{k}" for k in range(40)]
    texts = {0: " ".join(f"x{k}" for k in range(40))}
    for k in range(1, copies):
        base = [*base[:k % 40], f"n{k}", *base[k % 40 + 1:]]
        texts[k] = " ".join(base)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    sets = {k: shingles(t, 2) for k, t in texts.items()}
    members = docs.select(F.lit(1).cast("bigint").alias("bucket"), F.col("doc_id").alias("id"), F.lit(39).cast("bigint").alias("n"))
    roots = {r["id"]: r["root"] for r in neardup.settled(members, docs, 2, 80).collect()}
    want = brute_components(sets)
    got = {k: roots.get(k, k) for k in texts}
    assert len(set(want.values())) == 2 and got[0] == 0 and got[1] != 0
    assert got == want


@pytest.mark.parametrize("others", [0, 60])
def test_a_large_bucket_whose_hubs_link_to_nothing(spark, others):
    # The hubs of the first rounds (smallest ids) are strangers to all; only two late members are alike.
    texts = {k: " ".join(f"s{k}x{j}" for j in range(40)) for k in range(38)}
    base = [f"w{j}" for j in range(40)]
    texts[38], texts[39] = " ".join(base), " ".join([*base[:39], "edit"])
    bucket = {k: 1 for k in texts}
    # Unrelated groups of other buckets: chains that link round after round.
    for g in range(others // 20):
        w = [f"g{g}x{j}" for j in range(40)]
        for k in range(20):
            w = [*w[:k], f"g{g}n{k}", *w[k + 1:]]
            texts[100 + 20 * g + k], bucket[100 + 20 * g + k] = " ".join(w), 2 + g
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    members = spark.createDataFrame([(b, k, 39) for k, b in bucket.items()], "bucket bigint, id bigint, n bigint")
    roots = {r["id"]: r["root"] for r in neardup.settled(members, docs, 2, 80).collect()}
    want = brute_components({k: shingles(t, 2) for k, t in texts.items()})
    assert {k: roots.get(k, k) for k in texts} == want
    assert want[39] == 38 and len({want[k] for k in range(40)}) == 39


def test_prefix_pairs_hold_every_link(spark, monkeypatch):
    monkeypatch.setattr(neardup, "SALT_ROWS", 3)
    r = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    texts = {}
    for k in range(70):
        w = base[:r.choice([45, 50, 60, 60])]
        for at in r.sample(range(len(w)), r.choice([1, 2, 3, 4])):
            w[at] = f"e{k}x{at}"
        texts[k] = " ".join(w)
    sets = {k: shingles(t, 2) for k, t in texts.items()}
    links = {(a, b) for a in sets for b in sets if a < b and a % 5 != b % 5
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    held = neardup.full_sets(docs, 2).selectExpr("doc_id as id", "doc_id % 5 as root", "shingles")
    got = neardup.prefix_pairs(held, 80).collect()
    assert links and links <= {(x["a"], x["b"]) for x in got} and len(got) < 70 * 69 / 2 * 0.8


def test_a_center_joins_its_edited_copies(spark):
    # Copies are like the center and not like one another; the center has the largest id.
    r = random.Random(4)
    base = [f"w{k}" for k in range(100)]
    texts = {}
    for k in range(80):
        w = base[:]
        for at in r.sample(range(0, 100, 2), 5):
            w[at] = f"e{k}x{at}"
        texts[k] = " ".join(w)
    texts[80] = " ".join(base)
    want = brute_components({k: shingles(t, 2) for k, t in texts.items()})
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert {x["doc_id"]: x["component_id"] for x in neardup.groups(df, words_each=2).collect()} == want


def test_equal_bins_mean_similar_sets():
    r = np.random.default_rng(1)
    walks = neardup.densified_walks(160)
    agree = []
    for _ in range(60):
        both, a, b = (np.unique(r.integers(0, 2 ** 63, n).astype(np.uint64)) for n in (40, 5, 5))
        x, y = (neardup.signature(np.unique(np.concatenate([both, s])), 160, walks) for s in (a, b))
        agree.append((x == y).mean())
    assert np.mean(agree) == pytest.approx(40 / 50, abs=0.03)
    one = neardup.signature(np.array([7], np.uint64), 160, walks)
    assert len(set(one.tolist())) == 1


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    x, y, z = (" ".join(f"{c}{k}" for k in range(50)) for c in "xyz")
    near = x.replace("x49", "other")
    rows = [(1, x, 0), (2, x, 1), (2, y, 2), (3, near, 3), (4, y, 4), (5, z, 5), (5, z, 6), (5, "", 7), (5, None, 8), (None, x, 9), (1, y + " tail", 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, root int")
    got = {r["root"] for r in neardup.keep_one(df).collect()}
    assert got in ({0, 10, 5, 7, 8, 9}, {0, 10, 6, 7, 8, 9})      # x, near: row 0; y and its near copies: row 10; z: one of two
    of = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in neardup.groups(df).collect()}
    assert of[(2, 46)] in (1, 2) and of[(3, 46)] == 1 and of[(4, 46)] == 1 and of[(1, 47)] == 1 and of[(5, 46)] == 5


def test_keep_one_with_another_id_column_and_clashing_names(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(7, "a", text, 1), (8, "b", text, 2), (9, "c", "else", 3)], "key bigint, doc_id string, body string, _rows int")
    kept = neardup.keep_one(df, id_col="key", text_col="body")
    assert kept.columns == df.columns and sorted(r["key"] for r in kept.collect()) == [7, 9]


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(300)] + [(1000, 1500), (1500, 1200)]
    got = {r["id"]: r["root"] for r in neardup.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert all(got[k] == 0 for k in range(301)) and {got[k] for k in (1000, 1200, 1500)} == {1000}


def test_neardup_odd_rows(spark, odd, none):
    rows = neardup.groups(odd, words_each=2).collect()
    got = collections.defaultdict(set)
    for r in rows:
        got[r["doc_id"]].add(r["component_id"])
    assert len(rows) == odd.count()
    assert got[1] == {1} and got[2] == {2} and got[3] == {3} and got[8] == {7} and got[6] == {5} and got[None] == {None}
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda k: (k is None, k))
    assert ids == [1, 2, 3, 4, 5, 7, 9, None, None]
    assert neardup.groups(none).count() == 0 and neardup.keep_one(none).count() == 0


def brute_top(vectors, queries, k):
    v = {i: [int(np.floor(256 * float(x))) for x in e] for i, e in vectors}
    out = {}
    for q in queries:
        s = sorted((-sum(a * b for a, b in zip(v[q], e)), i) for i, e in v.items() if i != q)
        out[q] = [(i, -x) for x, i in s[:k]]
    return out


def test_topk_query_equals_brute_force(spark, sf):
    rows = table(spark, sf, "embeddings").collect()
    want = brute_top([(r["vec_id"], r["embedding"]) for r in rows], [r["vec_id"] for r in rows if r["vec_id"] % 50 == 0], 5)
    got = collections.defaultdict(list)
    for r in sorted(QUERIES["op6_no_random_access_topk"](spark, sf).collect(), key=lambda r: r["rank"]):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got == want


def test_topk_ties_blocks_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 37)
    monkeypatch.setattr(topk, "QUERIES", 5)
    monkeypatch.setattr(topk, "FEW", 6)
    r = np.random.default_rng(2)
    good = [(k, [float(x) for x in r.integers(-2, 3, 4) / 256 * 3]) for k in range(300)]
    bad = [(1000, None), (1001, [1.0, None, 0.0, 0.0]), (1002, [float("nan"), 0.0, 0.0, 0.0]), (1003, [float("inf"), 0.0, 0.0, 0.0]),
           (None, [9.0, 9.0, 9.0, 9.0]), (1004, [1.0, 1.0]), (1006, [2.0, 2.0])]
    df = spark.createDataFrame(good + bad, "vec_id bigint, embedding array<double>")
    got = collections.defaultdict(list)
    for x in sorted(topk.search(df, df.where("vec_id % 50 = 0 or vec_id = 1004"), 5).collect(), key=lambda x: x["rank"]):
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    want = brute_top(good, range(0, 300, 50), 5) | {1004: [(1006, 256 * 512 * 2)]}
    assert got == want
    assert topk.search(df.limit(0), df.limit(0)).count() == 0


def numpy_top(rows, queries, k):
    ids, v = np.array([i for i, _ in rows]), np.floor(256 * np.array([e for _, e in rows]))
    out = collections.defaultdict(list)
    for qi in queries:
        who = np.flatnonzero(ids != qi)
        score = v[who] @ v[np.flatnonzero(ids == qi)[0]]
        out[qi] = [(int(ids[who[j]]), int(score[j])) for j in np.lexsort((ids[who], -score))[:k]]
    return out


@pytest.mark.parametrize("kind", ["even", "clustered", "hot"])
def test_topk_reads_only_part_of_the_lists(spark, kind):
    r = np.random.default_rng(7)
    v = r.standard_normal((3000, 24)) / 5
    if kind == "clustered":
        v = (r.standard_normal((12, 24)) * 2)[r.integers(0, 12, 3000)] + v / 10
    if kind == "hot":
        v[r.random(3000) < 0.34] = v[0]
    rows = [(int(i), [float(x) for x in e]) for i, e in enumerate(v)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    got = collections.defaultdict(list)
    for x in sorted(topk.search(df, df.where("vec_id % 50 = 0")).collect(), key=lambda x: x["rank"]):
        got[x["query_id"]].append((x["vec_id"], x["score"]))
    assert got == numpy_top(rows, range(0, 3000, 50), 5)
    read = topk.entries_read(df, df.where("vec_id % 50 = 0")).first()
    assert 0 < read["entries"] < (0.5 if kind == "clustered" else 0.95) * read["of"] and read["of"] == 60 * 3000 * 24


def test_topk_reads_only_part_of_the_embeddings(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    read = topk.entries_read(df, df.where("vec_id % 50 = 0")).first()
    assert 0 < read["entries"] < read["of"] == 40 * 2000 * 64


def test_topk_repeated_ids_and_clashing_names(spark):
    rows = [(0, [1.0, 0.0])] + [(7, [float(x), 1.0]) for x in range(40)] + [(8, [38.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    df = df.withColumn("row", F.lit("x")).withColumn("dim", F.lit(1)).withColumn("cell", F.lit(2)).withColumn("_v", F.lit(3))
    got = [(r["vec_id"], r["score"]) for r in sorted(topk.search(df, df.where("vec_id = 0")).collect(), key=lambda r: r["rank"])]
    assert got == [(7, 39 * 65536), (7, 38 * 65536), (8, 38 * 65536), (7, 37 * 65536), (7, 36 * 65536)]


def test_bounds_hold_and_tighten():
    r = np.random.default_rng(3)
    c, q = np.floor(r.standard_normal((200, 8)) * 50), np.floor(r.standard_normal((6, 8)) * 50)
    lists, exact, last = np.sort(c, axis=0), q @ c.T, None
    for depth in (1, 20, 100, 199, 200):
        lower, upper = topk.bounds(q, c, lists, depth)
        assert (lower <= exact).all() and (exact <= upper).all()
        if last is not None:
            assert (lower >= last[0]).all() and (upper <= last[1]).all()
        last = lower, upper
    assert (last[0] == exact).all() and (last[1] == exact).all()


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 3.0]), (1, [1e6, 1.0]), (50, [1e6, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.search(df, df.where("vec_id = 0")).collect()}
    assert got == {(0, 1): (50, 256 ** 2 * (10 ** 12 + 6)), (0, 2): (1, 256 ** 2 * (10 ** 12 + 3))}


def brute_sketch(text, k, n=5):
    h = lambda b, seed=42: xxhash.xxh64_intdigest(b, seed)
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    words = [h(w.encode()) for w in WORD.findall(text)]

    def chain(hs):
        seed = 42
        for x in hs:
            seed = xxh64_long(x, seed)
        return seed
    if not words:
        return []
    if len(words) < n:
        return [signed(h(",".join(str(signed(w)) for w in words).encode()))]
    return sorted({signed(chain(words[i:i + n])) for i in range(len(words) - n + 1)})[:k]


def xxh64_long(value, seed):
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed)


def test_sketch_equals_brute_force_and_estimates(spark, docs, texts):
    order = sorted(texts, reverse=True)
    following = dict(zip(order, order[1:] + order[:1]))
    errors = []
    for r in sketch.fingerprints(docs).collect():
        t, n = texts[r["doc_id"]], texts[following[r["doc_id"]]]
        half = len(t) // 2
        new = t[:len(t) - half] + n[:half]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        for text, found in ((t, r["fingerprint"]), (new, r["edited_fingerprint"])):
            assert found == "".join(f"{x & (1 << 64) - 1:016x}" for x in brute_sketch(text, sketch.K))
        case = lambda x: {tuple(w) for w in zip(*[WORD.findall(x)[i:] for i in range(5)])}
        a, b = case(t), case(new)
        if len(a) >= 5:
            errors.append(r["near_edited"] - len(a & b) / len(a | b))
            assert r["n_shingles"] == pytest.approx(len(a), rel=0.4)
    assert np.std(errors) < 0.05


def test_sketches_merge(spark, docs):
    parts = docs.select(F.pmod("doc_id", F.lit(3)).alias("g"), sketch.sketch(F.col("text")).alias("sketch"))
    whole = {r["g"]: r["sketch"] for r in sketch.merge_parts(parts, ["g"]).collect()}
    pieces = collections.defaultdict(set)
    for r in parts.collect():
        pieces[r["g"]] |= set(r["sketch"])
    assert whole == {g: sorted(s)[:sketch.K] for g, s in pieces.items()}


def test_fingerprints_odd_rows(spark, odd, none):
    rows = sketch.fingerprints(odd).collect()
    assert len(rows) == odd.count() and sketch.fingerprints(none).count() == 0
    by = collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        assert 0.0 <= r["near_edited"] <= 1.0 and 0.0 <= r["near_next"] <= 1.0
    assert by[1][0]["fingerprint"] == "" == by[2][0]["fingerprint"]
    assert len({r["fingerprint"] for r in by[7] + by[8]}) == 1
    one = sketch.fingerprints(odd.where("doc_id = 4")).first()
    assert one["near_next"] == 1.0 and one["n_chars"] == 3


def test_next_text_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(sketch, "BUCKET_DOCS", 3)
    ids = [-50, -3, -2, 0, 1, 2, 9, 10, 11, 12, 400, 401, 90_000, 2 ** 62]
    df = spark.createDataFrame([(k, f"t{k}") for k in ids], "doc_id bigint, text string")
    got = {r["doc_id"]: r["next_text"] for r in sketch.with_next(df).collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}


def test_next_text_with_hot_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(sketch, "BUCKET_DOCS", 6)
    big = 2 ** 62
    data = ([(5, f"five {k}") for k in range(60)] + [(None, f"none {k}") for k in range(40)] + [(k, f"t{k}") for k in range(-20, 21)]
            + [(big, "big"), (big + 1, "bigger"), (big + 1, "bigger")] + [(5, "five 1")] * 5 + [(2 ** 63 - 1, f"top {k}") for k in range(40)])
    df = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    cuts, parts, null_parts = sketch._cuts(df.select("doc_id"))
    place = {r["doc_id"]: r["p"] for r in df.select("doc_id", sketch._place(F.col("doc_id"), cuts).alias("p")).collect() if r["doc_id"] is not None}
    assert place == {k: sum(c <= k for c in cuts) for k in place}
    assert parts[place[5]] > 5 and parts[place[2 ** 63 - 1]] > 3 and null_parts > 3 and place[big] != place[5] != place[6]
    hashes = {r["text"]: r["h"] for r in df.select("text", F.shiftrightunsigned(F.xxhash64("text"), 33).alias("h")).collect()}
    order = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]], r[1]))
    want = sorted(((a[0] is None, a[0] or 0, a[1], b[1]) for a, b in zip(order, order[1:] + order[:1])))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"], r["next_text"]) for r in sketch.with_next(df).collect())
    assert got == want


def test_audit_matches_records_of_one_number_by_digest(spark):
    rows = lambda xs: spark.createDataFrame(xs, "number bigint, record string")
    got = fixity.audit(rows([(1, "aaa"), (1, "ccc")]), rows([(1, "aaa")])).collect()
    assert [(r["kind"], r["length"]) for r in got] == [("missing", 3)]
    got = fixity.audit(rows([(1, "a")] * 5 + [(1, "b")]), rows([(1, "a")] * 2 + [(1, "b"), (1, "c")])).collect()
    assert sorted(r["kind"] for r in got) == ["altered", "missing", "missing"]
    hot = [(-1, f"record {k}") for k in range(3000)] + [(7, "x")]
    copy = [(n, r) for n, r in hot if r not in ("record 5", "record 77")] + [(-1, "new"), (9, "y")]
    copy = [(n, "record 9!" if r == "record 9" else r) for n, r in copy]
    found = fixity.audit(rows(hot), rows(copy)).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    lost = sorted((sha(x), len(x)) for x in ("record 5", "record 77", "record 9"))
    new = sorted((sha(x), len(x)) for x in ("new", "record 9!"))
    want = [(-1, a[0], b[0], "truncated" if b[1] < a[1] else "altered") for a, b in zip(lost, new)]
    want += [(-1, lost[2][0], None, "missing"), (9, None, sha("y"), "extra")]
    got = {(r["number"], r["digest"], r["found_digest"], r["kind"]) for r in found}
    assert len(found) == 4 and got == set(want)


def test_offsets_of_repeated_numbers(spark):
    data = [(n, f"{n}:{k}" * (k % 3 + 1)) for n in (1, 1, 2, 25) for k in range(40)]
    got = {(r["number"], r["digest"]): (r["file_no"], r["offset"], r["n"])
           for r in fixity.leaves(spark.createDataFrame(data, "number bigint, record string"), 20).collect()}
    at, want = {}, {}
    for n, record in sorted(data, key=lambda r: (r[0], hashlib.sha256(r[1].encode()).hexdigest())):
        d, f = hashlib.sha256(record.encode()).hexdigest(), n // 20
        first = want.get((n, d), (f, at.get(f, 0), 0))
        want[n, d] = (f, first[1], first[2] + 1)
        at[f] = at.get(f, 0) + len(record)
    assert got == want


def test_audit_finds_planted_faults_only(spark, sf):
    pages = table(spark, sf, "pages").unionByName(spark.createDataFrame([(3000, "u", "<p>x</p>"), (None, None, None)], "page_id bigint, url string, html string"))
    good = fixity.records(pages)
    assert fixity.audit(good, good.repartition(3)).count() == 0
    found = {r["number"]: r["kind"] for r in fixity.audit(good, fixity.records(fixity.damaged_copy(pages))).collect()}
    want = {}
    for r in pages.collect():
        n = r["page_id"]
        if n is None:
            continue
        if n % 307 == 3:
            want[n + fixity.EXTRA] = "extra"
        if n % 211 == 5:
            want[n] = "missing"
        elif n % 97 == 13:
            want[n] = "altered"
        elif n % 101 == 7:
            want[n] = "truncated"
    assert found == want


def test_audit_of_empty_and_repeating_archives(spark, none):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (-1, "x"), (20, "")], "number bigint, record string")
    empty = rows.limit(0)
    assert {r["kind"] for r in fixity.audit(rows, empty).collect()} == {"missing"}
    assert fixity.audit(empty, rows).count() == 5 and fixity.audit(empty, empty).count() == 0
    fewer = spark.createDataFrame([(1, "a"), (1, "b"), (-1, "x"), (20, "")], "number bigint, record string")
    assert [r["kind"] for r in fixity.audit(rows, fewer).collect()] == ["missing"]
    assert fixity.audit(rows, rows.orderBy(F.desc("record"))).count() == 0


def test_archive_files_round_trip(spark, sf, tmp_path):
    recs = fixity.records(table(spark, sf, "pages"))
    fixity.write_archive(recs, str(tmp_path / "w"), per_file=20)
    back = fixity.read_archive(spark, str(tmp_path / "w"))
    assert fixity.audit(recs, back.select("number", "record")).count() == 0
    assert back.select("file").distinct().count() == 3
    offsets = {(r["number"]): r["offset"] for r in fixity.leaves(recs, 20).collect()}
    assert {r["number"]: r["offset"] for r in back.collect()} == offsets
