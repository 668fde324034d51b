"""DuckDB SQL for the queries that SQL can express.

Not expressible, and tested against brute force or held-out labels instead:
the edit-distance search, the two classifiers, vector bin packing, the packing of
token sequences (ids of a tokenizer) and the WARC round trip.
"""

from __future__ import annotations

from .line_templates import CONSTANT_ONE_IN, CONSTANT_SHARE, FIELD, LEAD, MIN_DOCS, UNSPACED
from .url_filter import MIN_SOFT, SOFT_TERMS, STRICT_TERMS

_EXACT = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _count(terms: tuple[str, ...]) -> str:
    return " + ".join(
        rf"regexp_matches(u, '(^|[^\p{{L}}\p{{N}}]){t}([^\p{{L}}\p{{N}}]|$)')::INT" for t in terms)


def _decoded(url: str) -> str:
    """ASCII escapes as their character, others as a letter."""
    out = f"regexp_replace({url}, '%[89A-Fa-f][0-9A-Fa-f]', 'é', 'g')"
    for i in range(128):
        out = f"regexp_replace({out}, '(?i)%{i:02x}', {_character(i)}, 'g')" if i != 37 else out
    return f"regexp_replace({out}, '%25', '%', 'g')"


def _character(i: int) -> str:
    return "chr(92) || chr(92)" if i == 92 else f"chr({i})" if i else "' '"


_URLS = rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate({_decoded("coalesce(url, '')")}, '{_UPPER}', '{_LOWER}') AS u FROM pages),
h AS (
  SELECT page_id, u,
         translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM p),
t AS (SELECT *, {_count(STRICT_TERMS)} AS n_strict, {_count(SOFT_TERMS)} AS n_soft,
      host = 'org' OR ends_with(host, '.org') AS org,
      host = 'example.org' OR ends_with(host, '.example.org') AS example,
      host = 'com' OR ends_with(host, '.com') AS com FROM h),
r AS (SELECT *, CASE
      WHEN example AND starts_with(path, '/en/1') THEN 'example.org/en/1'
      WHEN example AND starts_with(path, '/es/') THEN 'example.org/es/'
      WHEN com AND starts_with(path, '/fr/') THEN 'com/fr/'
      WHEN com AND starts_with(path, '/de/') THEN 'com/de/'
      WHEN org AND starts_with(path, '/') THEN 'org/' END AS rule FROM t)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'example.org/en/1', 'com/fr/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN n_strict > 0 OR n_soft >= {MIN_SOFT} THEN 'block' ELSE 'allow' END AS verdict,
       n_strict::INT AS n_strict, n_soft::INT AS n_soft
FROM r
"""

_NEAR = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, unnest(list_filter(x, lambda y: y <> '')) AS w,
         generate_subscripts(list_filter(x, lambda y: y <> ''), 1) AS pos
  FROM (SELECT doc_id, regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+') AS x
    FROM documents)),
g AS (
  SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id) AS words,
         string_agg(w, ' ') OVER (PARTITION BY doc_id ORDER BY pos
                                  ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS e FROM w),
e AS (SELECT DISTINCT doc_id, e FROM g WHERE pos <= greatest(words - 4, 1)),
n AS (SELECT d.doc_id, count(e.e) AS n FROM documents d LEFT JOIN e ON e.doc_id = d.doc_id
      GROUP BY d.doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.e = b.e AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM n
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, min(r.other) AS component_id,
       n.doc_id = min(r.other) AS kept
FROM n JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""

_SCRIPTS = "".join(rf"\p{{{s}}}" for s in UNSPACED)
_LINES = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT row, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
t AS (
  SELECT row, pos, line, list_transform(list_filter(
    regexp_split_to_array(regexp_replace(line, '([{_SCRIPTS}])', ' \1 ', 'g'), '[ \t\x0B\f\r]+'),
    lambda x: x <> ''),
    lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS tokens FROM l),
u AS (
  SELECT line, any_value(tokens) AS tokens, count(DISTINCT row) AS docs,
         len(any_value(tokens)) AS size,
         array_to_string(any_value(tokens)[1:{LEAD}], ' ') AS lead
  FROM t WHERE len(tokens) > 0 GROUP BY line),
p AS (
  SELECT size, lead, line, docs, unnest(tokens) AS token,
         generate_subscripts(tokens, 1) AS pos FROM u),
f AS (SELECT size, lead, sum(docs) AS leaf FROM u GROUP BY ALL),
c AS (
  SELECT size, lead, pos, token FROM p JOIN f USING (size, lead) GROUP BY ALL
  HAVING sum(docs) >= {MIN_DOCS} AND sum(docs) * {CONSTANT_ONE_IN} >= max(leaf)
    AND token <> '{FIELD}'),
m AS (
  SELECT p.size, p.lead, p.line, min(p.docs) AS docs, count(c.token) AS constants,
         count(c.token) FILTER (p.pos > {LEAD}) AS behind,
         string_agg(coalesce(c.token, '{FIELD}'), ' ' ORDER BY p.pos) AS template
  FROM p LEFT JOIN c ON p.size = c.size AND p.lead = c.lead AND p.pos = c.pos
    AND p.token = c.token GROUP BY p.size, p.lead, p.line),
r AS (SELECT *, sum(docs) OVER (PARTITION BY size, lead, template) AS total FROM m),
x AS (SELECT line FROM r WHERE docs >= {MIN_DOCS}
      OR (total >= {MIN_DOCS} AND constants >= {CONSTANT_SHARE} * size
          AND behind >= {CONSTANT_SHARE} * (size - {LEAD}))),
k AS (SELECT l.row, l.pos, l.line, x.line IS NOT NULL AS gone FROM l LEFT JOIN x ON l.line = x.line)
SELECT any_value(d.doc_id) AS doc_id,
       coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (NOT k.gone), '') AS text,
       count(*)::BIGINT AS n_lines, count(*) FILTER (k.gone)::BIGINT AS n_dropped
FROM k JOIN d ON d.row = k.row GROUP BY k.row
"""

ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": _EXACT,
    "op7_line_templates": _LINES,
    "op8_url_vocabulary": _URLS,
    "op10_near_dedup": _NEAR,
}
