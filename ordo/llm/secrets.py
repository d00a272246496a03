"""Secret scan: pattern kinds plus sliding-window Shannon entropy, DataFrame functions only.

Base kinds come from fixed patterns. The entropy kinds take candidate strings of one
character class, slide a window of ``WINDOW`` characters over each, and keep the
window's character counts up to date by adding the entering and removing the leaving
character. With ``f(c) = c * log2(c)`` the window's entropy is
``log2(W) - sum(f(c)) / W``; the sum changes by table differences only. The table
holds integers (millionths of a bit), so the running sum has no rounding drift.
A candidate's span runs from its first to its last window at or over the class's
threshold. Allow-listed candidates, and those that overlap a base span, are dropped.
Spans of two entropy kinds may overlap; the mask covers both.

Edge cases: null text is empty text (no spans); repeated rows give repeated results;
positions are code points, end exclusive; an empty table gives an empty table. A candidate
may be as long as its text. Other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordo.llm.common import let, prefix_sums

WINDOW = 20
SCALE = 1_000_000

# Base kinds in the order their spans are listed.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)(?-i)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"


@dataclass(frozen=True)
class EntropyClass:
    kind: str
    pattern: str        # maximal runs of the class, WINDOW characters at least
    alphabet: str
    bits: float         # least entropy of a window
    must: tuple[str, ...] = ()   # patterns that a candidate has to contain


ENTROPY_CLASSES = (
    EntropyClass("entropy_hex", r"(?<![A-Za-z0-9+_-])[0-9A-F]{20,}(?![A-Za-z0-9+_-])", "0123456789ABCDEF", 2.8,
                 ("[0-9]", "[A-F]")),
    EntropyClass("entropy_b64", r"[A-Za-z0-9+_-]{20,}={0,2}",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+_-=", 3.6,
                 ("[0-9]", "[a-z]", "[A-Z]")),
    # Base64 strings with slashes; plain paths are on the allow-list. The class before still sees each piece.
    EntropyClass("entropy_b64_slash", r"[A-Za-z0-9+/_-]{20,}={0,2}",
                 "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=", 3.6,
                 ("/", "[0-9]", "[a-z]", "[A-Z]")),
    EntropyClass("entropy_lower", r"(?<![A-Za-z0-9])[a-z0-9]{20,}(?![A-Za-z0-9])", "abcdefghijklmnopqrstuvwxyz0123456789", 3.6,
                 ("[0-9]", "[a-z]")),
)

# Candidates that look random but are public or placeholders.
ALLOW_LIST = (
    r"(?i)example|sample|dummy|placeholder|changeme|redacted",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(?i)0123456789|abcdefghij",
    r"(?i)^(sha1|sha256|sha384|sha512|md5)[-_]",
)
# A candidate is a path if all its pieces between slashes are words of one of these forms.
PATH_WORDS = (r"^[A-Z]?[a-z0-9_-]+$", r"^[A-Z0-9_-]+$")

_SPANS = "array<struct<start:bigint,ord:int,end:bigint,kind:string>>"


def _located(text: Column, pattern: str, kind: str, order: int, keep) -> Column:
    """Spans of the leftmost non-overlapping matches that ``keep(match)`` accepts.

    ``split`` cuts at the same matches that ``regexp_extract_all`` returns, so the
    lengths of pieces and matches, summed up in turn, give the positions."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.char_length(p).cast("bigint"))

    def spans(s: Column) -> Column:
        steps = F.zip_with(s["m"], F.slice(s["g"], F.lit(1), F.size(s["m"])),
                           lambda m, g: F.char_length(m).cast("bigint") + g)
        return let(F.struct(prefix_sums(steps).alias("e"), s["m"].alias("m")), lambda t: F.filter(
            F.transform(t["m"], lambda m, i: F.when(keep(m), F.struct(
                (F.get(t["e"], i) - F.char_length(m)).alias("start"), F.lit(order).alias("ord"),
                F.get(t["e"], i).alias("end"), F.lit(kind).alias("kind")))),
            lambda x: x.isNotNull()))

    return F.when(F.rlike(text, F.lit(pattern)), let(F.struct(found.alias("m"), gaps.alias("g")), spans)
                  ).otherwise(F.array()).cast(_SPANS)


def _hot_range(candidate: Column, cls: EntropyClass) -> Column:
    """(first, last) start of a window at or over the threshold, -1 if there is none."""
    table = F.array(*[F.lit(round(c * math.log2(c) * SCALE) if c else 0).cast("bigint") for c in range(WINDOW + 2)])
    full = round(WINDOW * math.log2(WINDOW) * SCALE)
    most = full - math.ceil(cls.bits * WINDOW * SCALE)      # sum of f(c) must not exceed this
    size = len(cls.alphabet)

    def scan(codes: Column) -> Column:
        start = F.struct(F.array_repeat(F.lit(0), size).alias("n"), F.lit(0).cast("bigint").alias("s"),
                         F.lit(-1).alias("first"), F.lit(-1).alias("last"))

        def step(acc: Column, i: Column) -> Column:
            into = F.get(codes, i)
            out = F.when(i >= WINDOW, F.get(codes, i - WINDOW)).otherwise(F.lit(-1))

            def moved(v: Column) -> Column:
                same = v["into"] == v["out"]
                a = F.get(acc["n"], v["into"])
                gain = F.get(table, a + 1) - F.get(table, a)
                b = F.get(acc["n"], F.greatest(v["out"], F.lit(0)))
                loss = F.when(v["out"] >= 0, F.get(table, b - 1) - F.get(table, b)).otherwise(F.lit(0).cast("bigint"))
                total = F.when(same, acc["s"]).otherwise(acc["s"] + gain + loss)
                counts = F.transform(acc["n"], lambda c, k: c + F.when(k == v["into"], 1).otherwise(0)
                                     - F.when(k == v["out"], 1).otherwise(0))
                hot = (i >= WINDOW - 1) & (total <= most)
                at = i - (WINDOW - 1)
                return F.struct(counts.alias("n"), total.alias("s"),
                                F.when(hot & (acc["first"] < 0), at).otherwise(acc["first"]).alias("first"),
                                F.when(hot, at).otherwise(acc["last"]).alias("last"))
            return let(F.struct(into.alias("into"), out.alias("out")), moved)

        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step,
                           lambda acc: F.struct(acc["first"].alias("first"), acc["last"].alias("last")))

    codes = F.transform(F.split(candidate, ""), lambda ch: F.instr(F.lit(cls.alphabet), ch) - 1)
    return let(F.filter(codes, lambda c: c >= 0), scan)


def _is_path(candidate: Column) -> Column:
    """Two words or more between slashes. Pieces are matched one by one: a pattern of repeated
    groups would take a stack frame for each."""
    pieces = F.split(F.regexp_replace(candidate, "^/|/$", ""), "/")
    word = lambda p: F.rlike(p, F.lit(PATH_WORDS[0])) | F.rlike(p, F.lit(PATH_WORDS[1]))
    return let(pieces, lambda ps: (F.size(ps) > 1) & F.forall(ps, word))


def _entropy_spans(text: Column, cls: EntropyClass, order: int, allow: tuple[str, ...]) -> Column:
    def keep(m: Column) -> Column:
        ok = F.lit(True)
        for p in cls.must:
            ok = ok & F.rlike(m, F.lit(p))
        for p in allow:
            ok = ok & ~F.rlike(m, F.lit(p))
        return ok & ~_is_path(m)

    def narrowed(span: Column) -> Column:
        cand = F.substring(text, (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        return let(_hot_range(cand, cls), lambda h: F.when(h["first"] >= 0, F.struct(
            (span["start"] + h["first"]).alias("start"), span["ord"].alias("ord"),
            (span["start"] + h["last"] + WINDOW).alias("end"), span["kind"].alias("kind"))))

    return F.filter(F.transform(_located(text, cls.pattern, cls.kind, order, keep), narrowed),
                    lambda x: x.isNotNull()).cast(_SPANS)


def scan(df: DataFrame, text_col: str = "text", allow_list: tuple[str, ...] = ALLOW_LIST,
         out_col: str = "secret_spans") -> DataFrame:
    """Add ``out_col``: array<struct<start, ord, end, kind>> by start, kind order, end.

    ``ord`` is 0, 1, 2 for the base kinds assign, access, hex and 3.. for entropy kinds."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    long_value = lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= 6
    always = lambda m: F.lit(True)
    base = F.concat(_located(text, ASSIGN, "assign", 0, long_value), _located(text, ACCESS, "access", 1, always),
                    _located(text, HEX, "hex", 2, always))
    more = F.concat(*[_entropy_spans(text, c, 3 + k, allow_list) for k, c in enumerate(ENTROPY_CLASSES)])
    both = let(F.struct(base.alias("b"), more.alias("m")), lambda s: F.sort_array(F.concat(s["b"], F.filter(
        s["m"], lambda x: ~F.exists(s["b"], lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))))))
    return df.withColumn(out_col, both)


def listed(spans: Column) -> Column:
    """Comma-joined ``kind:start:end``."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(df: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """Replace every span that ``scan`` finds by ``mask``; overlapping spans become one mask.

    All other columns stay; a text without spans is returned as it was (null stays null)."""
    col, spans = F.col(f"`{text_col}`"), f"_spans_{uuid.uuid4().hex}"      # a name that no column of df has
    merged = F.aggregate(
        F.col(spans),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.when(x["end"] <= acc["at"], acc).otherwise(F.struct(
            x["end"].alias("at"),
            F.concat(acc["out"], F.when(x["start"] >= acc["at"], F.array(F.substring(
                col, (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")), F.lit(mask)))
                .otherwise(F.array().cast("array<string>"))).alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""),
                             F.substring(col, (acc["at"] + 1).cast("int"), F.char_length(col))))
    return (scan(df, text_col, out_col=spans)
            .withColumn(text_col, F.when(F.size(spans) > 0, merged).otherwise(col)).drop(spans))


def redacted(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """Redact a document table; ``size_col``, where there is one, follows a changed text."""
    was = f"_was_{uuid.uuid4().hex}"
    out = redact(docs.withColumn(was, F.col(f"`{text_col}`")), text_col)
    if size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        out = out.withColumn(size_col, F.when(F.col(f"`{text_col}`") != F.col(was), F.char_length(f"`{text_col}`").cast(kind))
                             .otherwise(F.col(f"`{size_col}`")))
    return out.drop(was)


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: span counts by base kind, digest of the base spans, all spans."""
    found = scan(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")))
    base = F.filter("secret_spans", lambda x: x["ord"] < 3)
    count = lambda o: F.size(F.filter("secret_spans", lambda x: x["ord"] == o)).cast("bigint")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secret_spans")).alias("spans"))
