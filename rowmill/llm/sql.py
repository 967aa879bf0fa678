"""DuckDB SQL beside the queries that SQL can express."""

from __future__ import annotations

from rowmill.llm import licences, secrets, url_trust

ORACLE = {}

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op7_decontamination"] = f"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r,
           list_filter(string_split_regex({LOWER}, '{GAP}'), lambda w: w <> '') AS ws
    FROM documents
),
b AS (
    SELECT item_id, list_filter(string_split_regex({LOWER}, '{GAP}'), lambda w: w <> '') AS ws
    FROM benchmark
),
grams AS (
    SELECT item_id, unnest(list_transform(range(greatest(len(ws) - 10, 0) + 1),
           lambda i: array_to_string(ws[i + 1:i + 10], ' '))) AS gram, least(len(ws), 10) AS n
    FROM b WHERE len(ws) > 0
),
sizes AS (SELECT DISTINCT n FROM grams),
windows AS (
    SELECT r, n, pos, array_to_string(ws[pos + 1:pos + n], ' ') AS gram
    FROM (SELECT r, n, ws, unnest(range(len(ws) - n + 1)) AS pos FROM d, sizes WHERE len(ws) >= n)
),
hits AS (SELECT r, pos, n, item_id FROM windows JOIN grams USING (n, gram)),
marked AS (SELECT r, count(DISTINCT p) AS n_hit FROM
           (SELECT r, unnest(range(pos, pos + n)) AS p FROM hits) GROUP BY r),
listed AS (SELECT r, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
           FROM hits GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN marked USING (r) LEFT JOIN listed USING (r)
"""


# Matched first, then dropped by the length of a group (0: the whole match).
_KEYWORDS = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_?key")
)
_BASE_PATTERNS = {
    "assign": (rf"({_KEYWORDS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    "access": ("AKIA[A-Z0-9]+", 0, 18),
    "hex": ("[0-9a-f]+", 0, 16),
}


def _findings(rule: secrets.Rule, rank: int) -> str:
    pattern, group, least = _BASE_PATTERNS.get(rule.kind, (rule.pattern, 0, 0))
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT r, {rank} AS rank, '{rule.kind}' AS kind,
           length(array_to_string(list_concat(p[1:i], m[1:i - 1]), '')) AS b,
           length(array_to_string(list_concat(p[1:i], m[1:i]), '')) AS e
    FROM (SELECT r, p, m, unnest(range(1, len(m) + 1)) AS i
          FROM (SELECT r, string_split_regex(t, '{pattern}') AS p,
                       regexp_extract_all(t, '{pattern}') AS m FROM d))
    WHERE length(regexp_extract(m[i], '{pattern}', {group})) >= {least}"""


_ALL = " UNION ALL ".join(_findings(r, k) for k, r in enumerate(secrets.RULES))
_BASE = len(secrets.BASE_RULES)
ORACLE["op9_secrets"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS t FROM documents),
f AS ({_ALL}),
g AS (
    SELECT r,
           count(*) FILTER (kind = 'assign') AS n_assign,
           count(*) FILTER (kind = 'access') AS n_access,
           count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) FILTER (rank < {_BASE}) AS base,
           string_agg(kind || ':' || b || ':' || e, ',' ORDER BY b, rank) AS spans
    FROM f GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
       coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


_REACH = """
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(r, t) AS (SELECT r, r FROM d UNION SELECT reach.r, e.b FROM reach JOIN e ON e.a = reach.t)
"""

ORACLE["op4_near_documents"] = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex({LOWER}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
    FROM documents
),
s AS (
    SELECT r, unnest(list_distinct(list_transform(range(greatest(len(ws) - 3, 0) + 1),
           lambda i: array_to_string(ws[i + 1:i + 3], ' ')))) AS g FROM d WHERE len(ws) > 0
),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.r < y.r GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
{_REACH},
c AS (SELECT reach.r, min(d.doc_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY ALL)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN c USING (r) LEFT JOIN n USING (r)
"""

ORACLE["op6_near_vectors"] = f"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
),
ok AS (
    SELECT r, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS s FROM d
    WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0
),
l AS (
    SELECT x.r AS a, y.r AS b FROM ok x JOIN ok y ON x.r < y.r AND len(x.v) = len(y.v)
    WHERE list_dot_product(x.v, y.v) / (x.s * y.s) >= 0.9
),
{_REACH},
k AS (SELECT a AS r, count(*) AS n_links FROM e GROUP BY a),
c AS (SELECT reach.r, min(d.vec_id) AS component_id FROM reach JOIN d ON d.r = reach.t GROUP BY ALL)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM d JOIN c USING (r) LEFT JOIN k USING (r)
"""


_HOST = "translate(regexp_extract({}, '^[\\s\\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract({}, '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1)"
_RULES = ", ".join(f"('{v}', '{h}', '{p}', {len(h + p)})" for v, h, p in url_trust.RULES)
_LINK = url_trust.LINK.replace("'", "''")


def _rounds(name: str, seed: str, edges: str) -> str:
    """ROUNDS rounds of one propagation, each a named table of (host, score)."""
    out = [f"{name}0 AS (SELECT host, 1.0::DOUBLE AS score FROM hosts WHERE {seed})"]
    for k in range(url_trust.ROUNDS):
        out.append(
            f"{name}{k + 1} AS MATERIALIZED (SELECT host, sum(score) AS score FROM ("
            f"SELECT * FROM {name}0 UNION ALL SELECT e.b, {url_trust.DAMPING} * t.score / s.n "
            f"FROM {name}{k} t JOIN {edges} e ON e.a = t.host JOIN (SELECT a, count(*) AS n FROM {edges} GROUP BY a) s "
            f"ON s.a = t.host) GROUP BY host)"
        )
    return ",\n".join(out)


ORACLE["op1_url_filters"] = f"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, html, coalesce({_HOST.format("url")}, '') AS host,
                  coalesce({_PATH.format("url")}, '') AS path FROM pages),
rules(verdict, rhost, rpath, size) AS (VALUES {_RULES}),
fits AS (
    SELECT r, rhost || rpath AS rule, verdict,
           row_number() OVER (PARTITION BY r ORDER BY size DESC, verdict DESC, rhost || rpath DESC) AS k
    FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
),
judged AS (SELECT p.*, rule, verdict AS ruled FROM p LEFT JOIN fits ON p.r = fits.r AND k = 1),
hosts AS (
    SELECT host, count(*) FILTER (ruled = 'allow') > count(*) / 2 AS trusted,
           count(*) FILTER (ruled = 'block') > count(*) / 2 AS blocked
    FROM judged WHERE host <> '' GROUP BY host
),
edges AS MATERIALIZED (
    SELECT DISTINCT a, b FROM (
        SELECT host AS a, translate(unnest(regexp_extract_all(html, '{_LINK}', 1)),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS b FROM p)
    WHERE a <> '' AND b <> '' AND a <> b
),
back AS MATERIALIZED (SELECT b AS a, a AS b FROM edges),
{_rounds("t", "trusted", "edges")},
{_rounds("d", "blocked", "back")}
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host <> '' AND
       round(coalesce(d.score, 0), {url_trust.DIGITS}) - round(coalesce(t.score, 0), {url_trust.DIGITS}) >= {url_trust.THRESHOLD}
       THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN t{url_trust.ROUNDS} t USING (host) LEFT JOIN d{url_trust.ROUNDS} d USING (host)
"""

_GRAMS = ", ".join(
    f"('{g}', {k}, '{name}', {len(licences.template_bigrams(body))})"
    for k, (name, body) in enumerate(licences.TEMPLATES)
    for g in licences.template_bigrams(body)
)
ORACLE["op5_licences"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
passages AS (
    SELECT r, unnest(range(len(ls))) AS line, unnest(ls) AS text FROM (SELECT r, string_split(text, chr(10)) AS ls FROM d)
    UNION ALL SELECT r, -1, text FROM d WHERE contains(text, chr(10))
),
ws AS (SELECT r, line, list_filter(string_split_regex({LOWER}, '{GAP}'), lambda w: w <> '') AS ws FROM passages),
grams AS (
    SELECT r, line, list_distinct(list_transform(range(len(ws) - 1), lambda i: ws[i + 1] || ' ' || ws[i + 2])) AS gs
    FROM ws WHERE len(ws) > 1
),
known(g, template, licence, size) AS (VALUES {_GRAMS}),
own AS (SELECT r, line, len(gs) AS n, unnest(gs) AS g FROM grams),
dice AS (
    SELECT r, line, licence, 2.0::DOUBLE * count(*) / (n + size) AS dice
    FROM own JOIN known USING (g) GROUP BY r, line, n, template, licence, size
),
best AS (
    SELECT r, line, licence, dice, row_number() OVER (PARTITION BY r, line ORDER BY dice DESC, licence) AS k
    FROM dice WHERE dice >= {licences.DICE}
),
found AS (
    SELECT r, count(*) AS n_findings, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences,
           string_agg(line || ':' || licence, ',' ORDER BY line) AS lines, max(dice) AS best
    FROM best WHERE k = 1 GROUP BY r
)
SELECT doc_id, coalesce(n_findings, 0)::BIGINT AS n_findings, coalesce(licences, '') AS licences,
       coalesce(lines, '') AS lines, coalesce(best, 0.0)::DOUBLE AS best
FROM d LEFT JOIN found USING (r)
"""

_TERMS = f"regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE["op13_ranked_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
sized AS (SELECT r, doc_id, ts, len(ts) AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS len FROM sized),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM sized) GROUP BY r, t),
w AS (
    SELECT t, floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
    FROM tf, total GROUP BY t
),
asked AS (
    SELECT q, t, count(*) AS times
    FROM (SELECT q, unnest(ts) AS t FROM (SELECT row_number() OVER () AS q, {_TERMS} AS ts FROM benchmark)) GROUP BY q, t
),
scored AS (
    SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // len))))::BIGINT AS score
    FROM asked JOIN w USING (t) JOIN tf USING (t) JOIN sized USING (r), total GROUP BY q, r
),
ranked AS (
    SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank
    FROM scored JOIN sized USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM ranked JOIN (SELECT row_number() OVER () AS q, item_id FROM benchmark) USING (q) WHERE rank <= 10
"""
