import collections
import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from ordo.llm import secrets, sharding
from ordo.llm.common import prefix_sums


def base_spans(text):
    out = []
    for m in re.finditer(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def entropy_windows(cand, bits):
    w = secrets.WINDOW
    f = lambda c: round(c * math.log2(c) * secrets.SCALE)
    most = round(w * math.log2(w) * secrets.SCALE) - math.ceil(bits * w * secrets.SCALE)
    return [i for i in range(len(cand) - w + 1) if sum(f(c) for c in collections.Counter(cand[i:i + w]).values()) <= most]


PATH = r"^/?(?:[A-Z]?[a-z0-9_-]+|[A-Z0-9_-]+)(?:/(?:[A-Z]?[a-z0-9_-]+|[A-Z0-9_-]+))+/?$"    # the rule in one pattern


def all_spans(text):
    base = base_spans(text)
    for k, c in enumerate(secrets.ENTROPY_CLASSES):
        for m in re.finditer(c.pattern, text):
            cand = m.group()
            if not all(re.search(p, cand) for p in c.must) or any(re.search(p, cand) for p in (*secrets.ALLOW_LIST, PATH)):
                continue
            hot = entropy_windows(cand, c.bits)
            if hot:
                a, b = m.start() + hot[0], m.start() + hot[-1] + secrets.WINDOW
                if not any(s < b and a < e for s, _, _, e in base_spans(text)):
                    base.append((a, 3 + k, c.kind, b))
    return sorted(base)


def listed(spans):
    return ",".join(f"{k}:{a}:{e}" for a, _, k, e in spans)


CASES = [
    None, "", "token", "token=abc", "token=abcdef", 'PASSWORD : "a.b-c=d/e+f" api_key=xyzxyz apikey:  zzzzzz',
    "é日本 secret='" + "Q" * 30 + "' x", "AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 11, "0" * 24 + "g" + "a" * 23,
    "key tR9zQ2mX7vB4nL8wK1cP5dF3 end", "blob aaaaaaaaaaaaaaaaaaaa1B" + "tR9zQ2mX7vB4nL8wK1cP5dF3" + "aaaaaaaaaaaaaaaaaaaa",
    "EXAMPLEtR9zQ2mX7vB4nL8wK1c", "550E8400-E29B-41D4-A716-446655440000", "9F86D081884C7D659A2FEAA0C55AD015 upper hex",
    "token = tR9zQ2mX7vB4nL8wK1cP5dF3", "token=" * 700 + "abcdefgh", "secret=abcdef " * 600,
]


def test_spans_equal_brute_force(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id bigint, text string")
    for r in secrets.digest(df).collect():
        text = CASES[r["doc_id"]] or ""
        base = base_spans(text)
        assert r["base_sha256"] == hashlib.sha256(listed(base).encode()).hexdigest()
        assert r["spans"] == listed(all_spans(text)), text
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(o == k for _, o, _, _ in base) for k in range(3))


def test_method_finds_random_strings_and_leaves_placeholders(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "doc_id bigint, text string")
    kinds = {r["doc_id"]: r["spans"] for r in secrets.digest(df).collect()}
    assert "entropy_b64" in kinds[9] and "entropy_hex" in kinds[13]
    assert kinds[11] == "" and kinds[12] == ""


def test_slashed_base64_and_lower_case_tokens_are_found(spark):
    aws, low, deep = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYq8Zk2LmT0Va", "q7x0v2m9k4t8z1b6n3c5w8r2", "tR9zQ2mX7vB4nL8wK1cP5dF3"
    texts = [f"aws_secret_access_key = {aws}", f"key: {low}", "see /usr/local/Lib/python3/site-packages/numpy here", f"example/{deep}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in secrets.digest(df).collect():
        assert r["spans"] == listed(all_spans(texts[r["doc_id"]]))
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert got == {0: "aws_secret_access_key = [SECRET]", 1: "key: [SECRET]", 2: texts[2], 3: "example/[SECRET]"}


def test_query_equals_brute_force(spark, docs, texts):
    for r in secrets.digest(docs).collect():
        assert r["spans"] == listed(all_spans(texts[r["doc_id"]]))


def test_redaction_and_odd_rows(spark, odd, none):
    out = secrets.redacted(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    text = out.where("doc_id = 9").first()
    assert text["text"] == "[SECRET]\" größe 日本語 naïve" and text["n_chars"] == len(text["text"])
    assert out.where("doc_id = 1").first()["text"] is None
    assert secrets.digest(odd).count() == odd.count() and secrets.digest(none).count() == 0


def test_overlapping_spans_become_one_mask(spark):
    df = spark.createDataFrame([(1, "x token=" + "a" * 30 + " y")], "doc_id bigint, text string")
    assert secrets.redact(df).first()["text"] == "x [SECRET] y"


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 1500])
def test_prefix_sums(spark, n):
    row = spark.range(1).select(prefix_sums(F.expr(f"transform(slice(sequence(0, {max(n, 1)}), 1, {n}), x -> cast(x * 3 as bigint))")).alias("p")).first()
    want, total = [], 0
    for k in range(n):
        total += 3 * k
        want.append(total)
    assert row["p"] == want


def test_shards_are_even_gapless_and_repeatable(spark, docs, texts):
    a = sharding.place(docs, 24).collect()
    shards = collections.defaultdict(list)
    size = collections.Counter()
    for r in a:
        shards[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 8
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    biggest = max(r["size"] for r in a)
    assert max(size.values()) - min(size.values()) <= biggest
    assert sorted(a) == sorted(sharding.place(docs.repartition(5), 24).collect())


def test_slot_map_versions_and_rebalance(spark, tmp_path):
    loads = [(k * 7919) % 1000 for k in range(sharding.N_SLOTS)]
    first = sharding.SlotMap.build(loads, 24)
    grown = first.rebalance(loads, 25)
    per = collections.Counter()
    for k, s in enumerate(grown.shard_of):
        per[s] += loads[k]
    assert grown.version == 2 and set(grown.shard_of) == set(range(25))
    assert max(per.values()) - min(per.values()) <= 2 * max(loads)
    assert len(first.moved(grown)) < 0.1 * len(loads)
    fewer = grown.rebalance(loads, 20)
    assert set(fewer.shard_of) == set(range(20))
    path = str(tmp_path / "map")
    first.save(spark, path)
    grown.save(spark, path)
    assert sharding.SlotMap.load(spark, path) == grown and sharding.SlotMap.load(spark, path, 1) == first


def test_shard_files_and_odd_rows(spark, odd, none, tmp_path):
    rows = sharding.place(odd, 24)
    assert rows.count() == odd.count() and sharding.place(none, 24).count() == 0
    m = sharding.SlotMap.build([1] * sharding.N_SLOTS, 4)
    sharding.write_shards(odd.drop("shard"), m, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == odd.count()


def test_long_paths_are_scanned_and_not_secret(spark):
    """A path of 100,000 pieces takes no stack, and a random string between slashes is still found."""
    key = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYq8Zk2LmT0Va"
    texts = [(1, "ab/" * 100_000), (2, "/usr/Local/share/LIB/python3/site-packages/x"), (3, f"x {key} y"), (4, "a9B/" * 3000 + "Ab1CD2ef3GH4ij5KL6mn7")]
    got = {r["doc_id"]: r["spans"] for r in secrets.digest(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()}
    assert got[1] == "" and got[2] == "" and got[3].startswith("entropy_b64_slash:") and "entropy" in got[4]


def test_redaction_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "token = abcdef123456", 20, "was", "spans")], "doc_id bigint, text string, n_chars int, _was string, _spans string")
    out = secrets.redacted(df)
    r = out.first()
    assert out.columns == df.columns and (r["_was"], r["_spans"]) == ("was", "spans") and "abcdef" not in r["text"]


@pytest.mark.parametrize("text", ["same words in every row", None])
def test_one_id_on_a_third_of_the_rows_keeps_the_law(spark, text):
    rows = [(k, "w" * (k % 300)) for k in range(2000)] + [(7, text or f"text {k}") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sharding.place(df, n_shards=8).collect()
    load, slots = {}, {}
    for r in got:
        load[r["shard"]] = load.get(r["shard"], 0) + r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(got) == 3000 and max(load.values()) - min(load.values()) <= 2 * max(r["size"] for r in got)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
