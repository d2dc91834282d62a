"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from __future__ import annotations

from replicheck.llm.lexical import APART
from replicheck.llm.queries import URL_RULES
from replicheck.llm.source_audit import DOCUMENTS, TERMS
from replicheck.llm.urls import DAMPING, LED, LOWER, ROUNDS, THRESHOLD, UPPER, split_rule

OP3 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE list_distinct(list_transform(
    range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i + 3], ' '))) END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, r.c AS component_id
FROM s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = s.doc_id
"""

OP7 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP11 = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^{APART}]+') AS w FROM documents),
i AS (
  SELECT row_number() OVER () AS no, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^{APART}]+')) AS w FROM benchmark),
s AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
m AS (SELECT row, doc_id, 10 + (90 * len(w) * n) // l AS m FROM d, s WHERE len(w) > 0),
tf AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term),
w AS (SELECT term, floor(1000 * ln((2 * n + 2) / (2 * df + 1)))::BIGINT AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), s),
scored AS (
  SELECT no, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM (SELECT no, item_id, unnest(w) AS term FROM i) JOIN tf USING (term) JOIN w USING (term) JOIN m USING (row)
  GROUP BY no, item_id, row, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= {DOCUMENTS}),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, v.v FROM g JOIN kept k ON k.lang = g.lang
  JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT *, 1 + (1000000000 * (n + 5)::HUGEINT) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p FROM grid),
l AS (SELECT lang, term, any_value(v) AS v, sum(n) AS n FROM grid GROUP BY lang, term),
q AS (SELECT lang, term, 1 + (1000000000 * (n + 5)::HUGEINT) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q FROM l),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, (p - q)::BIGINT FROM p JOIN q ON q.lang = p.lang AND q.term = p.term
  WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TERMS}
"""


def _op2() -> str:
    cases = []
    for verdict, rule in sorted(URL_RULES, key=lambda r: (-len(r[1]), r[1])):
        host, path = split_rule(rule)
        cases.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')", rule, verdict))
    rule = " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in cases)
    said = " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in cases)
    host = f"translate(regexp_extract({{0}}, '^[^/?#]*'), '{UPPER}', '{LOWER}')"
    rest = "substr({0}, instr({0}, '://') + 3)"
    rounds = []
    for k in range(1, ROUNDS + 1):
        last = "seeds" if k == 1 else f"r{k - 1}"
        rounds.append(
            f"r{k} AS MATERIALIZED (SELECT host, sum(t) AS t, sum(d) AS d, sum(l) AS l, sum(s) AS s FROM ("
            f"SELECT w.b AS host, x.t * w.t * {DAMPING} AS t, x.d * w.d * {DAMPING} AS d,"
            f" (x.s + (1 - x.s) * x.l) * w.l * {DAMPING} AS l, 0.0 AS s FROM {last} x JOIN ways w ON w.a = x.host"
            f" UNION ALL SELECT host, t * (1 - {DAMPING}), d * (1 - {DAMPING}), 0.0, d FROM seeds) GROUP BY host)"
        )
    link = "CASE WHEN starts_with(u, '//') THEN 'http:' || u ELSE u END"
    return f"""
WITH p AS (
  SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN {host.format(rest.format('url'))} ELSE '' END AS host,
    CASE WHEN instr(url, '://') > 0 THEN regexp_extract({rest.format('url')}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
ruled AS (SELECT page_id, host, path, CASE {rule} END AS rule, CASE {said} END AS said FROM p),
seeds AS MATERIALIZED (
  SELECT host, avg(CASE WHEN said = 'allow' THEN 1.0 ELSE 0.0 END) AS t,
    avg(CASE WHEN said = 'block' THEN 1.0 ELSE 0.0 END) AS d, 0.0 AS l, d AS s FROM ruled GROUP BY host),
urls AS (SELECT host, {link} AS u FROM (SELECT host,
    unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*["'']?([^"''\\s>]*)', 1)) AS u FROM p WHERE host <> '')),
edges AS MATERIALIZED (SELECT a, b, count(*) AS n FROM (SELECT host AS a, CASE WHEN regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://')
    THEN {host.format(rest.format('u'))} ELSE host END AS b FROM urls) WHERE b <> '' GROUP BY a, b),
leaves AS (SELECT a, sum(n) FILTER (a <> b) AS n FROM edges GROUP BY a),
ways AS MATERIALIZED (SELECT a, b, sum(t) AS t, sum(d) AS d, sum(l) AS l FROM (
  SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS t, 0.0 AS d, 0.0 AS l FROM edges
  UNION ALL SELECT e.b, e.a, 0.0, e.n / sum(e.n) OVER (PARTITION BY e.b), CASE WHEN e.a <> e.b THEN e.n / l.n ELSE 0.0 END
    FROM edges e JOIN leaves l ON l.a = e.a) GROUP BY a, b),
{', '.join(rounds)}
SELECT page_id, ruled.host, path, rule, coalesce(said, CASE WHEN d >= {THRESHOLD} AND d > t
  OR l >= {LED} AND l > t THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN r{ROUNDS} r ON r.host = ruled.host
"""


#: Queries that SQL cannot express. Their tests compare them with the library the tokens belong
#: to, with plain Python, or by what they find among labelled and planted cases.
WITHOUT_SQL = {
    "op1_byte_bpe",
    "op4_toxicity",
    "op5_pii",
    "op6_lm_score",
    "op8_source_mix",
    "op9_quality_rules",
    "op10_html_text",
    "op13_token_counts",
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_url_filter": _op2(),
        "op3_ngram_jaccard": OP3,
        "op7_topk_search": OP7,
        "op11_lexical_search": OP11,
        "op12_source_audit": OP12,
    }
