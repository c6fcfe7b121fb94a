"""Query of operator 12."""

from voxlens.llm.license_scan import BLOCK, PHRASES, STEP, TEMPLATES, THRESHOLD, need_of, scan, template_pairs
from voxlens.llm.registry import query, table


def _sql() -> str:
    """Every block against every template, without filters."""
    phrases = ", ".join(f"([{', '.join(repr(w) for w in p.split())}], '{label}')" for p, label in PHRASES)
    templates = ", ".join(
        f"('{label}', [{', '.join(repr(f'{a} {b}') for a, b in pairs)}], {need_of(len(pairs), THRESHOLD)})"
        for label, pairs in template_pairs(TEMPLATES))
    return rf"""
WITH t AS (
  SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), phrase(ws, label) AS (VALUES {phrases}
), template(label, pairs, need) AS (VALUES {templates}
), spot AS (
  SELECT i, p - 1 AS p, label FROM t, phrase, range(1, len(w) + 1) r(p) WHERE w[p:p + len(ws) - 1] = ws
), base AS (
  SELECT i, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list_sort(list(DISTINCT label)) AS base FROM spot GROUP BY i
), block AS (
  SELECT i, list_transform(range({STEP} * b + 1, least({STEP} * b + {BLOCK}, len(w))), lambda k: w[k] || ' ' || w[k + 1]) AS pairs
  FROM t, range(0, len(w) // {STEP} + 1) r(b)
), hit AS (
  SELECT i, label, len(list_intersect(template.pairs, list_distinct(block.pairs))) AS n, len(template.pairs) AS size, need
  FROM block, template
), found AS (
  SELECT i, list(DISTINCT label) AS labels, max(n / size) AS best FROM hit WHERE n >= need GROUP BY i
)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(coalesce(base, []), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM t LEFT JOIN base USING (i) LEFT JOIN found USING (i)
"""


@query("op12_license_scan", _sql())
def op12_license_scan(spark, sf_dir):
    return scan(spark, table(spark, sf_dir, "documents"))
