"""Registered queries of the training-data operators, with their DuckDB SQL where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ordo.llm import fixity, langid, licenses, manifest, mixing, neardup, packing, periodic, quality, secrets, sharding, sketch, topk
from ordo.llm.common import documents, table
from ordo.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(documents(spark, sf_dir))


@query
def op2_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source_key")


@query
def op3_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query
def op6_no_random_access_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query
def op7_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.fingerprints(documents(spark, sf_dir))


@query
def op8_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(documents(spark, sf_dir), words_each=2)


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = f"{ensure_checkpoint_dir(spark).rstrip('/')}/slot-maps/{uuid.uuid4().hex}"
    return sharding.place(documents(spark, sf_dir), n_shards=24, map_path=maps)


@query
def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of an archive of all pages against a replica with planted faults."""
    pages = table(spark, sf_dir, "pages")
    return fixity.audit(fixity.records(pages), fixity.records(fixity.damaged_copy(pages)))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.audit(documents(spark, sf_dir))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.detect(documents(spark, sf_dir), plant=True)


@query
def op13_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


_WARC = ("concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10), 'WARC-Record-ID: <urn:record:', "
         "page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10), 'Content-Length: ', "
         "octet_length(encode(html)), chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10))")
_LEAVES = """SELECT page_id, page_id // 1000 AS file_no, len, d,
  coalesce(sum(len) OVER (PARTITION BY page_id // 1000 ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM (SELECT page_id, octet_length(encode(r)) AS len, sha256(r) AS d FROM (SELECT page_id, {warc} AS r FROM {pages}))"""
ORACLES["op10_warc_fixity"] = f"""
WITH copy AS (
  SELECT page_id, url, CASE WHEN page_id % 97 = 13 THEN concat('#', substr(html, 2))
    WHEN page_id % 101 = 7 THEN substr(html, 1, length(html) // 2) ELSE html END AS html
  FROM pages WHERE page_id % 211 <> 5
  UNION ALL SELECT page_id + {fixity.EXTRA}, url, html FROM pages WHERE page_id % 307 = 3),
a AS ({_LEAVES.format(warc=_WARC, pages="pages")}),
b AS ({_LEAVES.format(warc=_WARC, pages="copy")})
SELECT coalesce(a.page_id, b.page_id) AS number, coalesce(a.file_no, b.file_no)::BIGINT AS file_no,
  coalesce(a.off, b.off)::BIGINT AS "offset", a.len::BIGINT AS length, a.d AS digest, b.len::BIGINT AS found_length, b.d AS found_digest,
  CASE WHEN b.d IS NULL THEN 'missing' WHEN a.d IS NULL THEN 'extra' WHEN b.len < a.len THEN 'truncated' ELSE 'altered' END AS kind
FROM a FULL JOIN b ON a.page_id = b.page_id WHERE a.d IS DISTINCT FROM b.d"""


# CRC-32 in SQL: the table of the 256 bytes by eight shifts each, then one look-up a byte.
_CRC_TABLE = "b"
for _ in range(8):
    _CRC_TABLE = f"xor({_CRC_TABLE} >> 1, ({_CRC_TABLE} & 1) * 3988292384)" if _ == 0 else (
        f"list_transform([{_CRC_TABLE}], lambda c: xor(c >> 1, (c & 1) * 3988292384))[1]")
_FAN, _INNER, _OUTER = manifest.FAN, 6, 4      # levels that are written out: 16^6 rows of a source, 16^4 sources


def _field(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::VARCHAR))::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _sql_tree(name: str, source: str, levels: int) -> str:
    """CTEs ``<name>0`` .. of (grp, place, total, digest), each with the sides of a node among its run."""
    parts = [f"{name}0 AS ({source})"]
    for k in range(levels):
        parts.append(f"""{name}{k + 1} AS (SELECT grp, place // {_FAN} AS place, (any_value(total) + {_FAN - 1}) // {_FAN} AS total,
  sha256(string_agg(digest, '' ORDER BY place)) AS digest FROM {name}{k} WHERE total > 1 GROUP BY grp, place // {_FAN})""")
        run = f"PARTITION BY grp, place // {_FAN} ORDER BY place ROWS BETWEEN"
        parts.append(f"""{name}s{k} AS (SELECT *, coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
  coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post FROM {name}{k})""")
    tops = " UNION ALL ".join(f"SELECT grp, digest FROM {name}{k} WHERE total = 1" for k in range(levels + 1))
    return ",\n".join(parts) + f",\n{name}top AS ({tops})"


def _sql_sides(name: str, levels: int, first: str) -> tuple[str, str, str]:
    """Joins from ``first`` up the tree, the proof text, and the folded digest of column ``got``."""
    joins, proof, got = "", "", "got"
    for k in range(levels):
        joins += f" LEFT JOIN {name}s{k} {name}x{k} ON {name}x{k}.grp = {first}.grp AND {name}x{k}.place = {first}.place // {_FAN ** k} AND {name}x{k}.total > 1"
        proof += ("" if not k else " || ") + f"coalesce({name}x{k}.pre || {name}x{k}.post, '')"
        got = f"list_transform([{got}], lambda h: CASE WHEN {name}x{k}.grp IS NULL THEN h ELSE sha256({name}x{k}.pre || h || {name}x{k}.post) END)[1]"
    return joins, proof, got


def _manifest_sql() -> str:
    text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = "sha256(concat({}))"
    plain = leaf.format(", ".join(_field(c) for c in manifest.COLUMNS))
    low = leaf.format(", ".join(_field(text if c == "text" else c) for c in manifest.COLUMNS))
    joins, proof, got = _sql_sides("t", _INNER, "r")
    over, over_proof, over_got = _sql_sides("u", _OUTER, "g")
    return f"""WITH crc AS (SELECT list({_CRC_TABLE} ORDER BY b) AS t FROM (SELECT range::BIGINT AS b FROM range(256))),
c AS (SELECT d.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
  lambda k: ascii(substr(doc_id::VARCHAR, k::INTEGER, 1))::BIGINT)), lambda s, x: xor(s >> 8, crc.t[(xor(s, x) & 255) + 1])), 4294967295) AS h
  FROM documents d, crc),
r AS (SELECT doc_id, coalesce('=' || source, '') AS grp, {plain} AS digest, CASE WHEN h % 5 = 0 THEN {low} ELSE {plain} END AS got,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS place, count(*) OVER (PARTITION BY source) AS total FROM c),
{_sql_tree("t", "SELECT grp, place, total, digest FROM r", _INNER)},
g AS (SELECT '' AS grp, grp AS of, digest, row_number() OVER (ORDER BY encode(grp)) - 1 AS place, count(*) OVER () AS total FROM ttop),
{_sql_tree("u", "SELECT grp, place, total, digest FROM g", _OUTER)},
o AS (SELECT g.of, g.digest AS subroot, {over_proof} AS up, {", ".join(f"ux{k}.grp IS NOT NULL AS on{k}, ux{k}.pre AS pre{k}, ux{k}.post AS post{k}" for k in range(_OUTER))}
  FROM g{over}),
f AS (SELECT r.doc_id, r.digest AS leaf, r.grp AS of, {proof} AS below, {got} AS mid FROM r{joins}),
z AS (SELECT doc_id, leaf, subroot, (SELECT digest FROM utop) AS root, sha256(below || up) AS proof_sha256,
  {_outer_fold()} AS folded_root FROM f JOIN o USING (of))
SELECT *, folded_root = root AS verified FROM z"""


def _outer_fold() -> str:
    got = "mid"
    for k in range(_OUTER):
        got = f"list_transform([{got}], lambda h: CASE WHEN on{k} THEN sha256(pre{k} || h || post{k}) ELSE h END)[1]"
    return got


ORACLES["op11_merkle_manifest"] = _manifest_sql()
