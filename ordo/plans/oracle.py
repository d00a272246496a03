"""DuckDB twins of the views in ``ordo.sources.views`` (SQL text, for the oracle).

Each constant is a list of CTE bodies ``name AS (...)``; ``with_ctes`` glues
them in front of a final SELECT. DuckDB needs the ``'g'`` flag for a global
``regexp_replace`` and uses 1-based list indexes; Java-style splits are spelt
out with ``jsplit`` below.
"""

from __future__ import annotations


def solved(name: str, source: str, n: int, keys: list[str]) -> list[str]:
    """CTEs that solve the systems in ``source`` (keys, a<i>_<j>, b<i>) by Gauss-Jordan steps; ``name`` has keys, w<i>."""
    out, prior = [], source
    for k in range(n):
        cells = [f"a{k}_{j} / a{k}_{k} AS a{k}_{j}" for j in range(n)] + [f"b{k} / a{k}_{k} AS b{k}"]
        for i in range(n):
            if i != k:
                cells += [f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" for j in range(n)]
                cells.append(f"b{i} - a{i}_{k} * b{k} / a{k}_{k} AS b{i}")
        out.append(f"{name}_{k} AS MATERIALIZED (SELECT {', '.join([*keys, *cells])} FROM {prior})")
        prior = f"{name}_{k}"
    out.append(f"{name} AS MATERIALIZED (SELECT {', '.join([*keys, *[f'b{i} AS w{i}' for i in range(n)]])} FROM {prior})")
    return out


def with_ctes(*parts: str, select: str) -> str:
    ctes = [p for part in parts for p in (part if isinstance(part, (list, tuple)) else [part])]
    seen, uniq = set(), []
    for c in ctes:
        if c not in seen:
            seen.add(c)
            uniq.append(c)
    return "WITH " + ",\n".join(uniq) + "\n" + select


def jsplit(s: str, pattern: str) -> str:
    """SQL twin of ``ordo.functions.text.jsplit`` (Java ``String.split``)."""
    stripped = f"regexp_replace({s}, '(?:{pattern})+$', '')"
    return (f"(CASE WHEN {s} IS NULL THEN NULL WHEN {s} = '' THEN [''] "
            f"WHEN {stripped} = '' THEN []::VARCHAR[] "
            f"ELSE string_split_regex({stripped}, '{pattern}') END)")


def alnum(s: str) -> str:
    return f"list_filter(string_split_regex(lower({s}), '[^a-z0-9]+'), lambda t: t <> '')"


def r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


V1_DOCS = [
    f"""docs_raw AS (
  SELECT page_id, url,
         regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
         regexp_extract_all(html, '(?is)<h1>(.*?)</h1>', 1) AS headers,
         regexp_extract_all(html, '(?is)<a [^>]*>(.*?)</a>', 1) AS anchor_list,
         {alnum("regexp_replace(html, '<[^>]*>', ' ', 'g')")} AS body,
         CAST(page_id % 10 AS INTEGER) AS page_rank
  FROM pages)""",
    """docs AS (
  SELECT page_id, url, title, headers, body, page_rank,
         map_from_entries(list_transform(list_distinct(anchor_list),
             lambda t: {'key': t, 'value': CAST(len(list_filter(anchor_list, lambda x: x = t)) AS INTEGER)})) AS anchors
  FROM docs_raw)""",
]

V2_RANKING = V1_DOCS + [
    f"""q2 AS (
  SELECT page_id AS query_id, array_to_string({alnum('title')}, ' ') AS query
  FROM docs)""",
    """ids AS (
  SELECT query_id, query, UNNEST(generate_series(query_id - 4, query_id + 5)) AS doc_pos
  FROM q2 WHERE query <> '')""",
    """cands AS (
  SELECT i.query_id, i.query, i.doc_pos, d.url, d.title, d.headers,
         map_from_entries(list_filter(list_transform(list_distinct(string_split(i.query, ' ')),
             lambda w: {'key': w, 'value': list_filter(range(0, len(d.body)), lambda k: d.body[k + 1] = w)}),
             lambda e: len(e.value) > 0)) AS body_hits,
         CAST(len(d.body) AS INTEGER) AS body_length, d.page_rank, d.anchors
  FROM ids i JOIN docs d ON i.doc_pos = d.page_id)""",
    """rels AS (
  SELECT i.query_id, i.query, i.doc_pos, d.url,
         CAST(((i.doc_pos * 3 + i.query_id * 7) % 7) * 0.5 AS DOUBLE) AS rel
  FROM ids i JOIN docs d ON i.doc_pos = d.page_id)""",
]

V3_RETRIEVAL = [
    f"""dtok AS (
  SELECT doc_id, source, {alnum('text')} AS toks FROM documents)""",
    """dfs AS (
  SELECT token, count(*) AS df FROM (SELECT doc_id, UNNEST(list_distinct(toks)) AS token FROM dtok) GROUP BY token)""",
    f"""btok AS (SELECT item_id AS query_id, {alnum('text')} AS toks FROM benchmark)""",
    """q3 AS (SELECT query_id, array_to_string(toks, ' ') AS query FROM btok)""",
    """dsh AS (
  SELECT DISTINCT doc_id, array_to_string(toks[i:i + 7], ' ') AS sh
  FROM (SELECT doc_id, toks, UNNEST(range(1, len(toks) - 6)) AS i FROM dtok WHERE len(toks) >= 8))""",
    """bsh AS (
  SELECT DISTINCT query_id, array_to_string(toks[i:i + 7], ' ') AS sh
  FROM (SELECT query_id, toks, UNNEST(range(1, len(toks) - 6)) AS i FROM btok WHERE len(toks) >= 8))""",
    """pairs3 AS (SELECT DISTINCT query_id, doc_id FROM dsh JOIN bsh USING (sh))""",
    """bwords AS (SELECT DISTINCT query_id, UNNEST(toks) AS term FROM btok)""",
    """posts AS (
  SELECT doc_id, UNNEST(toks) AS token, UNNEST(range(0, len(toks))) AS pos FROM dtok
  WHERE doc_id IN (SELECT doc_id FROM pairs3))""",
    """hits AS (
  SELECT query_id, doc_id, map_from_entries(list({'key': term, 'value': positions})) AS body_hits
  FROM (SELECT t.query_id, p.doc_id, t.term, list_sort(list(p.pos)) AS positions
        FROM pairs3 x JOIN posts p ON x.doc_id = p.doc_id JOIN bwords t ON x.query_id = t.query_id AND p.token = t.term
        GROUP BY t.query_id, p.doc_id, t.term)
  GROUP BY query_id, doc_id)""",
    """cands3 AS (
  SELECT h.query_id, q.query, h.doc_id AS doc_pos,
         'http://corpus/' || d.source || '/' || CAST(h.doc_id AS VARCHAR) AS url,
         '' AS title, CAST(NULL AS VARCHAR[]) AS headers, h.body_hits,
         CAST(len(d.toks) AS INTEGER) AS body_length, CAST(h.doc_id % 10 AS INTEGER) AS page_rank,
         CAST(NULL AS MAP(VARCHAR, INTEGER)) AS anchors
  FROM hits h JOIN q3 q ON h.query_id = q.query_id JOIN dtok d ON h.doc_id = d.doc_id)""",
    """rels3 AS (
  SELECT c.query_id, c.query, c.doc_pos, c.url, CAST(l.quality AS DOUBLE) AS rel
  FROM cands3 c JOIN labels l ON c.doc_pos = l.doc_id)""",
]

V4_GRADES = [
    """grades AS (
  SELECT l_orderkey AS query_id, CAST(least(floor(l_quantity / 17), 3) AS DOUBLE) AS rel,
         l_extendedprice, l_partkey, l_suppkey, l_linenumber, l_quantity
  FROM lineitem)""",
    """gpos AS (
  SELECT query_id, rel,
         row_number() OVER (PARTITION BY query_id ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber, l_quantity) AS pos,
         row_number() OVER (PARTITION BY query_id ORDER BY rel DESC) AS ideal_pos
  FROM grades)""",
]


# ------------------------------------------------------------ feature twins

def nsum(expr: str) -> str:
    """SUM that is NULL when any term is NULL (Spark's ``aggregate`` fold)."""
    return f"(CASE WHEN count(*) = count({expr}) THEN sum({expr}) END)"


def url_toks(u: str) -> str:
    return (f"list_filter(string_split_regex(lower(replace(replace({u}, 'http:', '.'), '%20', '.')), "
            f"'[^a-z0-9]+'), lambda t: t <> '')")


def words_sql(q: str = "query") -> str:
    return jsplit(f"lower({q})", " ")


def page_idf() -> list[str]:
    return V1_DOCS + [
        """pidf AS (
  SELECT term, count(*) AS df, ln((SELECT count(*) FROM pages) / count(*)) AS idf
  FROM (SELECT page_id, UNNEST(list_distinct(body)) AS term FROM docs) GROUP BY term)"""]


def feature_ctes(cands: str, idf: str) -> list[str]:
    """Per (candidate, distinct query word) raw term frequencies (P7) in ``tfw``."""
    hits = "c.body_hits[q.word]"
    fold = (f"list_reduce(range(q.m), lambda t, x: CASE WHEN (t + len({hits})) / cardinality(c.body_hits) > 0 "
            f"THEN ln((t + len({hits})) / cardinality(c.body_hits)) END, 0.0::DOUBLE)")
    return [
        f"""qt AS (
  SELECT query_id, word, count(*) AS m
  FROM (SELECT query_id, UNNEST({words_sql()}) AS word FROM (SELECT DISTINCT query_id, query FROM {cands}))
  GROUP BY query_id, word)""",
        f"""qv AS (
  SELECT qt.query_id, qt.word, qt.m, i.idf, (1 + ln(qt.m)) * coalesce(i.idf, ln(98998)) AS qv
  FROM qt LEFT JOIN {idf} i ON i.term = qt.word)""",
        f"""ctok AS (
  SELECT c.*, {url_toks('url')} AS url_toks,
         coalesce({jsplit('title', ' ')}, []::VARCHAR[]) AS title_toks,
         coalesce(flatten(list_transform(headers, lambda h: {jsplit('h', ' ')})), []::VARCHAR[]) AS header_toks,
         coalesce(list_transform(map_entries(anchors), lambda kv: {{'toks': {jsplit('kv.key', ' ')}, 'n': kv.value}}), []) AS anchor_entries
  FROM {cands} c)""",
        f"""tfw AS (
  SELECT c.query_id, c.doc_pos, c.query, c.url, c.title, c.headers, c.body_hits, c.anchors,
         c.body_length, c.page_rank, q.word, q.m, q.idf, q.qv,
         CAST(q.m * len(list_filter(c.url_toks, lambda t: t = q.word)) AS DOUBLE) AS url_tf,
         CAST(q.m * len(list_filter(c.title_toks, lambda t: t = q.word)) AS DOUBLE) AS title_tf,
         CAST(q.m * len(list_filter(c.header_toks, lambda t: t = q.word)) AS DOUBLE) AS header_tf,
         CAST(q.m * coalesce(list_sum(list_transform(c.anchor_entries,
              lambda e: len(list_filter(e.toks, lambda t: t = q.word)) * e.n)), 0) AS DOUBLE) AS anchor_tf,
         CASE WHEN {hits} IS NOT NULL THEN {fold} ELSE 0.0 END AS body_tf
  FROM ctok c JOIN qv q ON c.query_id = q.query_id)""",
    ]


FIELDS = ("url", "title", "body", "header", "anchor")
# The scorers' weights, as in ``ordo.operators.scorers``.
COSINE_W = {"url": 10.0, "title": 10.0, "header": 7.0, "anchor": 8.0, "body": 0.6}
BM25_W = {"url": 1.1, "title": 0.7, "header": 0.5, "body": 0.5, "anchor": 0.8}
BM25_B = {"url": 1.1, "title": 0.6, "header": 0.4, "body": 0.1, "anchor": 1.0}


def cos_tf(f: str) -> str:
    return f"(CASE WHEN 1 + {f}_tf > 0 THEN log10(1 + {f}_tf) END / (body_length + 15000.0))"


def section_sum() -> str:
    return " + ".join(f"{COSINE_W[f]} * {cos_tf(f)}" for f in FIELDS)


def field_score_sql() -> str:
    return nsum(f"m * m * coalesce(idf, 1.0 / 98999) * ({section_sum()})")


def length_cols() -> str:
    return f"""CAST(body_length AS DOUBLE) AS len_body,
    CAST(CASE WHEN url IS NOT NULL THEN len({jsplit('url', chr(92) + 'W+')}) ELSE 0 END AS DOUBLE) AS len_url,
    CAST(CASE WHEN title IS NOT NULL THEN len({jsplit('title', chr(92) + 's+')}) ELSE 0 END AS DOUBLE) AS len_title,
    CAST(coalesce(list_sum(list_transform(headers, lambda h: len({jsplit('h', chr(92) + 's+')}))), 0) AS DOUBLE) AS len_header,
    CAST(coalesce(list_sum(list_transform(map_keys(anchors), lambda t: len({jsplit('t', chr(92) + 's+')}))), 0) AS DOUBLE) AS len_anchor,
    1 AS n_body, CAST(url IS NOT NULL AS INTEGER) AS n_url, CAST(title IS NOT NULL AS INTEGER) AS n_title,
    coalesce(len(headers), 0) AS n_header, coalesce(cardinality(anchors), 0) AS n_anchor"""


def bm25_ctes(cands: str) -> list[str]:
    avg = ", ".join(f"sum(len_{f}) / nullif(sum(n_{f}), 0) AS avg_{f}" for f in FIELDS)
    return [f"""lens AS (SELECT query_id, doc_pos, {length_cols()} FROM {cands})""",
            f"""avgl AS (SELECT {avg} FROM lens)"""]


def bm25_tf(f: str) -> str:
    den = f"(1 + {BM25_B[f]} * (len_{f} / nullif(avg_{f}, 0) - 1))"
    return f"(CASE WHEN {f}_tf = 0 THEN 0.0 WHEN {den} > 0 THEN {f}_tf / {den} END)"


def bm25_score_sql() -> str:
    W = " + ".join(f"{BM25_W[f]} * {bm25_tf(f)}" for f in FIELDS)
    return (f"({nsum(f'm * (({W}) / (({W}) + 1.7)) * coalesce(idf, 1.0 / 98999)')} "
            f"+ 8.0 * ln(min(page_rank) + 9.5))")


def lockstep(lists: str) -> str:
    L = f"list_transform({lists}, lambda l: list_sort(list_distinct(l)))"
    at = f"list_transform({L}, lambda l: l[least(r, len(l) - 1) + 1])"
    return (f"(CASE WHEN len({lists}) > 0 THEN list_min(list_transform(range(0, list_max(list_transform({L}, "
            f"lambda l: len(l)))), lambda r: list_max({at}) - list_min({at}) + 1)) END)")


def exact(lists: str) -> str:
    """Smallest span with a position of every list: best over all starts."""
    reach = f"list_transform({lists}, lambda l: list_min(list_filter(l, lambda x: x >= p)))"
    return (f"list_min(list_filter(list_transform(flatten({lists}), lambda p: CASE WHEN list_bool_and(list_transform({lists}, "
            f"lambda l: list_max(l) >= p)) THEN list_max({reach}) - p + 1 END), lambda x: x IS NOT NULL))")


def text_window(text: str, words: str, win=lockstep) -> str:
    toks = jsplit(text, chr(92) + "W+")
    lists = f"list_transform(list_distinct({toks}), lambda tk: list_filter(range(0, len({toks})), lambda i: {toks}[i + 1] = tk))"
    return (f"(CASE WHEN {text} IS NOT NULL AND list_bool_and(list_transform({words}, lambda w: contains({text}, w))) "
            f"THEN {win(lists)} END)")


def doc_window(words: str, win=lockstep) -> str:
    body = (f"(CASE WHEN body_hits IS NOT NULL AND cardinality(body_hits) = len({words}) "
            f"THEN {win('map_values(body_hits)')} END)")
    return (f"list_min(list_filter(list_concat([{body}, {text_window('url', words, win)}, {text_window('title', words, win)}], "
            f"coalesce(list_transform(headers, lambda hh: {text_window('hh', words, win)}), []), "
            f"coalesce(list_transform(map_keys(anchors), lambda aa: {text_window('aa', words, win)}), [])), lambda x: x IS NOT NULL))")


def boost(win: str, k: str) -> str:
    x = f"({win} - {k})"
    return (f"(CASE WHEN {k} = 1 THEN 1.0 WHEN {win} IS NULL THEN 1.0 WHEN {win} = {k} THEN 2.0 * {win} "
            f"WHEN {x} > 9 THEN 1.0 ELSE sqrt(abs(10.0 + (1.0 - {x} * {x} / 9.0) * 2.0)) END)")
