"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from .secrets import KINDS, MAX_OWNERS, MAX_REPOSITORIES, PLACEHOLDER
from .urls import RULES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULES = ", ".join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in RULES)

URLS = rf"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES}),
parts AS (
  SELECT page_id, url, row_number() OVER () AS k,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
hits AS (
  SELECT k, rule_host || rule_path AS rule, rule_verdict AS verdict,
    row_number() OVER (PARTITION BY k ORDER BY length(rule_host || rule_path) DESC, rule_verdict = 'block' DESC) AS place
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM hits WHERE place = 1) USING (k)
"""

MIXING = """
WITH sizes AS (
  SELECT source, sum(length(text)) AS chars, sqrt(sum(length(text))::DOUBLE) AS weight FROM documents GROUP BY source),
totals AS (SELECT sum(chars)::BIGINT AS all_chars, sum(weight::DECIMAL(38, 12))::DOUBLE AS all_weight FROM sizes),
rates AS (SELECT source, 1.0::DOUBLE * weight / all_weight * all_chars / chars AS rate FROM sizes, totals),
parts AS (
  SELECT doc_id, unnest(generate_series(1, greatest(1, ceil(rate / 64)::INT))) AS part, rate / greatest(1, ceil(rate / 64)::INT) AS lam
  FROM documents JOIN rates USING (source)),
draws AS (
  SELECT doc_id, lam, ('0x' || substr(sha256('17|' || doc_id || '|' || part), 1, 13))::BIGINT::DOUBLE / 4503599627370496 AS u FROM parts),
counts AS (
  SELECT doc_id, list_reduce(
      list_prepend([0.0::DOUBLE, exp(-lam), exp(-lam)], list_transform(generate_series(1, (lam + 12 * sqrt(lam) + 40)::INT), lambda i: [i::DOUBLE])),
      lambda s, x: CASE WHEN s[3] > u THEN s ELSE [x[1], s[2] * lam / x[1], s[3] + s[2] * lam / x[1]] END)[1]::BIGINT AS k
  FROM draws),
copies AS (SELECT doc_id, sum(k)::BIGINT AS n FROM counts GROUP BY doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, unnest(generate_series(1, n)) AS copy_no
FROM documents d JOIN copies USING (doc_id) WHERE n > 0
"""


def _spans(number: int, name: str, pattern: str) -> str:
    value = f"regexp_extract_all(t, {_quoted(pattern)}, 2)" if name == "assign" else f"regexp_extract_all(t, {_quoted(pattern)}, 0)"
    return f"""
  SELECT doc_id, source, lang, {number} AS kind_no, {_quoted(name)} AS kind,
    unnest(list_transform(generate_series(1, len(hits)), lambda i: list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0)))::BIGINT AS "start",
    unnest(hits) AS hit, unnest(vals) AS val
  FROM (SELECT *, regexp_extract_all(t, {_quoted(pattern)}, 0) AS hits, {value} AS vals, string_split_regex(t, {_quoted(pattern)}) AS gaps FROM docs) WHERE len(hits) > 0"""


_LIVE = f"""regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Za-z]') AND len(list_distinct(string_split(val, ''))) >= 8 AND NOT regexp_matches(lower(val), {_quoted(PLACEHOLDER)})"""

SECRETS = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, source, lang FROM documents),
hits AS ({" UNION ALL ".join(_spans(k, n, p) for k, (n, p) in enumerate(KINDS))}),
found AS (
  SELECT *, "start" + length(hit) AS "end", sha256(val) AS secret, ({_LIVE}) AS looks_live FROM hits
  WHERE (kind_no <> 0 OR length(val) >= 12)),
candidates AS (SELECT * FROM found WHERE kind_no < 3 OR (looks_live AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]'))),
owners AS (SELECT secret, count(DISTINCT coalesce(source, chr(1))) AS n_owners, count(DISTINCT coalesce(source, chr(1)) || chr(2) || coalesce(lang, chr(1))) AS n_repositories FROM candidates GROUP BY secret),
spans AS (SELECT *, n_owners > {MAX_OWNERS} OR n_repositories > {MAX_REPOSITORIES} AS copied, looks_live AND n_owners <= {MAX_OWNERS} AND n_repositories <= {MAX_REPOSITORIES} AS live FROM candidates JOIN owners USING (secret)),
base AS (SELECT * FROM spans WHERE kind_no < 3),
every_span AS (
  SELECT * FROM base UNION ALL
  SELECT * FROM spans s WHERE kind_no = 3 AND live AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = s.doc_id AND b."start" < s."end" AND s."start" < b."end")),
per_doc AS (
  SELECT doc_id,
    count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access, count(*) FILTER (kind_no = 2) AS n_hex,
    string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY "start", kind_no) FILTER (kind_no < 3) AS base_spans,
    string_agg(kind || ':' || "start" || ':' || "end", ',' ORDER BY "start", kind_no) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (copied) AS n_copied, max(n_repositories) AS most_repositories
  FROM every_span GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(p.spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(most_repositories, 0) AS most_repositories
FROM docs LEFT JOIN per_doc p USING (doc_id)
"""

#: Every anchor against every row, as in the contract; a plain product of the two.
NEGATIVES = """
WITH clean AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS y
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id AS id, list_inner_product(a.y, r.y)::BIGINT AS score
  FROM clean a JOIN clean r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
