import collections
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ordo.llm import licenses, packing

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    hits = [(i, label) for i in range(len(words)) for phrase, label in licenses.BASE_PHRASES.items()
            if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({x for _, x in hits})))


@given(st.lists(st.sampled_from(["mit", "license", "MIT", "apache", "general", "public", "größe", "ÿ", " ", " ", "-", "\n", "\x85", "x1"]), max_size=30))
@settings(max_examples=200, deadline=None)
def test_base_scan_equals_brute_force(parts):
    text = " ".join(parts)
    assert licenses.scan_text(text, licenses.automaton())[:5] == base(text)


def test_query_equals_brute_force(spark, docs, texts):
    for r in licenses.scan(docs).collect():
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == base(texts[r["doc_id"]])
        assert 0.0 <= r["score"] <= 1.0 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def brute_value(tokens):
    """Least restrictive choice of an expression by recursive descent."""
    def alternative():
        v = both()
        while tokens and tokens[0] == "or":
            tokens.pop(0)
            v = min(v, both())
        return v

    def both():
        v = unit()
        while tokens and tokens[0] == "and":
            tokens.pop(0)
            v = max(v, unit())
        return v

    def unit():
        if tokens[0] == "(":
            tokens.pop(0)
            v = alternative()
            tokens.pop(0)
        else:
            v = licenses.RESTRICTIVE.get(licenses.family(tokens.pop(0)), licenses.UNKNOWN)
        if tokens and tokens[0] == "with":
            tokens.pop(0)
            tokens.pop(0)
            v *= licenses.EXCEPTION_FACTOR
        return v
    return alternative()


EXPRESSIONS = st.recursive(st.sampled_from(["mit", "gpl-3.0-only", "apache-2.0", "lgpl-2.1 with classpath-exception-2.0", "foo"]),
                           lambda x: st.one_of(st.tuples(x, st.sampled_from([" and ", " or "]), x).map("".join), x.map(lambda e: f"({e})")),
                           max_leaves=8)


@given(EXPRESSIONS)
@settings(max_examples=200, deadline=None)
def test_shunting_yard_equals_recursive_descent(expression):
    assert licenses.evaluate(expression)[1] == pytest.approx(brute_value(re.findall(r"[()]|[^\s()]+", expression)))


@pytest.mark.parametrize("broken", ["", "and", "mit and", "(mit", "mit)", "mit gpl", "()", "mit or ( and gpl"])
def test_broken_expressions(broken):
    with pytest.raises(ValueError):
        licenses.postfix(broken)


def test_tags(spark, odd, none):
    scan = lambda t: licenses.scan_text(t, licenses.automaton())
    assert scan("// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0\nrest")[5] == "apache,gpl,mit"
    assert scan("# SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note and more prose here")[5] == "gpl,more"
    assert scan("SPDX-License-Identifier: MIT. The rest")[5:7] == ("mit", 0.95)
    assert "invalid-expression" in scan("SPDX-License-Identifier: MIT AND")[5]
    assert scan("")[5:7] == ("", 0.0) and scan(None)[0] == 0
    assert licenses.scan(odd).count() == odd.count() and licenses.scan(none).count() == 0


def check_pack(rows, texts, sample, max_len=1024):
    tok = Tokenizer.from_file(TOKENIZER)
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        seqs[r["sequence_id"]].append(r)
    for k in sample:
        ids = np.array(tok.encode(texts[k] or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for p, r in enumerate(sorted(by[k], key=lambda r: r["piece"])):
            assert (r["piece"], r["start"]) == (p, at)
            assert zlib.crc32(ids[at:at + r["length"]].tobytes()) == r["ids_crc32"]
            assert r["length"] == max_len or p == 0
            at += r["length"]
        assert at == len(ids)
    for group in seqs.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= max_len
    return len(seqs)


def test_pack_round_trip(spark, docs, texts):
    rows = packing.pack(docs, TOKENIZER, bucket_rows=3).collect()
    used = check_pack(rows, texts, texts)
    hist = np.bincount([r["length"] for r in rows], minlength=1025)
    assert used <= 1.01 * sum(n for _, n in packing.best_fit(hist, 1024)) + 1
    assert sorted(rows) == sorted(packing.pack(docs.repartition(3), TOKENIZER, bucket_rows=3).collect())


def test_sequences_hold_the_ids(spark, docs, texts):
    few = docs.limit(20)
    placed = packing.pack(few, TOKENIZER)
    ids = {(r["sequence_id"]): r for r in packing.sequences(placed, few, TOKENIZER).collect()}
    for r in placed.collect():
        s = ids[r["sequence_id"]]
        part = np.array(s["ids"][r["offset"]:r["offset"] + r["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == r["ids_crc32"]


def test_pack_odd_rows(spark, odd, none):
    rows = packing.pack(odd, TOKENIZER).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] in (1, 2)) == 2
    assert sum(1 for r in rows if r["doc_id"] == 7) == 2
    assert packing.pack(none, TOKENIZER).count() == 0


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=60, deadline=None)
def test_plan_places_every_piece_once(lengths):
    hist = np.bincount(lengths, minlength=41) if lengths else np.zeros(41, int)
    plan = packing.plan(hist, 40)
    length = np.repeat(np.arange(41), hist)
    rank = np.concatenate([np.arange(n) for n in hist]) if lengths else np.zeros(0, int)
    seq, off = plan.look_up(length, rank)
    filled = collections.defaultdict(list)
    for s, o, n in zip(seq, off, length):
        filled[s].append((o, n))
    assert len(filled) == plan.n_sequences
    for parts in filled.values():
        ends = list(itertools.accumulate(n for _, n in sorted(parts)))
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 40


@pytest.mark.parametrize("text", ["I'll don't", "a b", "x\x1cy", "  two\n\n three \t", "½ ² ৩ 12", "<|endoftext|>", "a <|endoftext|> b", "日本語 größe ñ", "é", "a_b__c", "\x85z", "\x00"])
def test_word_memo_equals_the_tokenizer(text):
    tok = Tokenizer.from_file(TOKENIZER)
    want = np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert packing.WordIds(TOKENIZER).encode(text) == want


def test_patterns_are_all_that_fill_a_sequence():
    want = {tuple(sorted(p, reverse=True)) for n in (1, 2, 3) for p in itertools.combinations_with_replacement(range(1, 25), n) if sum(p) == 24}
    assert {tuple(int(x) for x in p if x) for p in packing.patterns(24)} == want
