"""Licence scan: one Aho-Corasick pass over the words, a shunting-yard parser for tags.

A text becomes its lower-case words joined by single spaces. One automaton holds every
notice phrase and the identifier tag, each between spaces, so a hit is a run of whole
words. Behind an identifier tag the rest of the line is a licence expression with
``and``, ``or``, ``with`` and brackets. The shunting-yard algorithm turns it into
postfix order, which is evaluated to the restrictiveness that a user has to accept:
the least over ``or``, the greatest over ``and``, and a reduced one ``with`` an exception.

Edge cases: null text is empty (no words, labels '', score 0); a broken expression keeps
the labels of the identifiers in it and adds ``invalid-expression``; repeated rows give
repeated results; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the base scan.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

# Further notice phrases with label and evidence weight.
NOTICE_PHRASES = {
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl", 0.9),
    "eclipse public license": ("epl", 0.9),
    "bsd license": ("bsd", 0.8),
    "bsd 2 clause": ("bsd", 0.8),
    "bsd 3 clause": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "boost software license": ("bsl", 0.9),
    "cc by": ("cc-by", 0.8),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc0": ("cc0", 0.8),
    "creative commons": ("cc", 0.7),
    "this is free and unencumbered software released into the public domain": ("unlicense", 0.95),
    "permission is hereby granted free of charge to any person obtaining a copy": ("mit", 0.95),
    "redistribution and use in source and binary forms": ("bsd", 0.95),
    "all rights reserved": ("all-rights-reserved", 0.5),
    "public domain": ("public-domain", 0.5),
}
BASE_WEIGHT = 0.8
TAG = "spdx license identifier"
TAG_WEIGHT = 0.95
TAG_LINE = re.compile(r"spdx[^a-z0-9\n]*license[^a-z0-9\n]*identifier[^a-z0-9(\n]*([^\n]*)")

# Restrictiveness of a licence family, 0 free to use to 1 not to be used.
RESTRICTIVE = {
    "mit": 0.1, "apache": 0.1, "bsd": 0.1, "isc": 0.1, "bsl": 0.1, "cc0": 0.0, "unlicense": 0.0, "public-domain": 0.0,
    "cc-by": 0.2, "cc": 0.4, "mpl": 0.4, "epl": 0.4, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.7, "agpl": 0.9,
    "cc-by-nc": 0.9, "cc-by-nd": 0.9, "all-rights-reserved": 1.0,
}
UNKNOWN = 0.6
EXCEPTION_FACTOR = 0.6

# Bytes of a word: digits, letters and everything beyond ASCII.
_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_TOKEN = re.compile(r"[()]|[^\s()]+")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    """Label of an identifier such as ``gpl-3.0-or-later``: the longest known family that it starts with."""
    name = identifier.rstrip("+.,;:")
    known = [k for k in RESTRICTIVE if name == k or name.startswith(f"{k}-")]
    return max(known, key=len) if known else name


def postfix(expression: str) -> list[str]:
    """Operands and operators in postfix order; raises ValueError for a broken expression."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression.lower()):
        if token == "(":
            if not operand_next:
                raise ValueError("operator expected before (")
            stack.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("operand expected before )")
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ValueError(") without (")
            stack.pop()
        elif token in _PRECEDENCE:
            if operand_next:
                raise ValueError(f"operand expected before {token}")
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        else:
            if not operand_next:
                raise ValueError(f"operator expected before {token}")
            out.append(token)
            operand_next = False
    if operand_next:
        raise ValueError("operand expected at the end")
    while stack:
        if stack[-1] == "(":
            raise ValueError("( without )")
        out.append(stack.pop())
    return out


def evaluate(expression: str) -> tuple[set[str], float]:
    """Labels in the expression and the restrictiveness that its user has to accept."""
    labels: set[str] = set()
    values: list[float] = []
    after_with = False
    order = postfix(expression)
    for k, token in enumerate(order):
        if token in _PRECEDENCE:
            right, left = values.pop(), values.pop()
            values.append({"or": min(left, right), "and": max(left, right), "with": left * EXCEPTION_FACTOR}[token])
            continue
        after_with = k + 1 < len(order) and order[k + 1] == "with"
        if after_with:
            values.append(0.0)      # the name of an exception is no licence
        else:
            label = family(token)
            labels.add(label)
            values.append(RESTRICTIVE.get(label, UNKNOWN))
    return labels, values[0]


def expression_in(line: str) -> str:
    """The licence expression at the start of a tag line; prose behind it is cut."""
    kept: list[str] = []
    operand_next, depth = True, 0
    for token in _TOKEN.findall(line):
        word = token.strip("*/#\"'`,;<>-").rstrip(".") if token not in "()" else token
        if not word:
            break
        if word == "(" and operand_next:
            depth += 1
        elif word == ")" and not operand_next and depth:
            depth -= 1
        elif word in _PRECEDENCE:
            operand_next = True
        elif operand_next and word not in "()":
            operand_next = False
        else:
            break
        kept.append(word)
    return " ".join(kept)


def automaton() -> ahocorasick.Automaton:
    """Phrases between spaces -> (phrase, label, evidence weight, base)."""
    found = ahocorasick.Automaton()
    for phrase, (label, weight) in NOTICE_PHRASES.items():
        found.add_word(f" {phrase} ", (phrase, label, weight, False))
    for phrase, label in BASE_PHRASES.items():
        found.add_word(f" {phrase} ", (phrase, label, BASE_WEIGHT, True))
    found.add_word(f" {TAG} ", (TAG, None, TAG_WEIGHT, False))
    found.make_automaton()
    return found


def scan_text(text: str | None, phrases: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, restrictiveness."""
    low = (text or "").encode("utf-8", "replace").lower()
    words = low.translate(_WORDS).split()
    joined = f" {b' '.join(words).decode('latin-1')} "       # one character a byte: spaces keep their places
    base: list[int] = []
    base_labels: set[str] = set()
    labels: set[str] = set()
    miss, restrict, tagged = 1.0, 0.0, False
    seen, at = 0, 0      # spaces before ``at``; hits come by their end
    for end, (phrase, label, weight, is_base) in phrases.iter(joined):
        if label is None:
            tagged = True
            continue
        if is_base:
            seen, at = seen + joined.count(" ", at, end), end
            base.append(seen - len(phrase.split()))
            base_labels.add(label)
        labels.add(label)
        miss *= 1.0 - weight
        restrict = max(restrict, RESTRICTIVE.get(label, UNKNOWN))
    if tagged:
        for line in TAG_LINE.findall(low.decode("utf-8", "replace")):
            expression = expression_in(line)
            miss *= 1.0 - TAG_WEIGHT
            try:
                got, value = evaluate(expression)
            except ValueError:
                got = {family(t) for t in _TOKEN.findall(expression) if t not in _PRECEDENCE and t not in "()"}
                got, value = got | {"invalid-expression"}, 1.0
            labels |= got
            restrict = max(restrict, value)
    return (len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted(labels)), min(1.0, 1.0 - miss), restrict)


FOUND = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
         "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "restrictiveness": pa.float64()}
SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
          "labels string, score double, restrictiveness double")


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases = automaton()
    for batch in batches:
        rows = [scan_text(t, phrases) for t in batch.column("text").to_pylist()]
        found = zip(*rows) if rows else [[]] * len(FOUND)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, kind) for c, kind in zip(found, FOUND.values())]],
            ["doc_id", *FOUND])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: word count, base places, labels, ``score`` (evidence of a
    licence notice, 0 to 1) and ``restrictiveness`` (0 free to 1 not to be used)."""
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(_scan_batches, SCHEMA)
