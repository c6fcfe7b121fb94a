"""Query of operator 13."""

from voxlens.llm.filter_audit import audit, masked_documents
from voxlens.llm.registry import query, table

SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, part, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS copy
  FROM t
), l AS (
  SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic, [
    len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 5 * length(text),
    regexp_matches(text, '[#$%&*|]'), copy] AS fails
  FROM w LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), letter AS (
  SELECT i FROM range(1, 6) r(i)
), perm AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS p
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), ranked AS (
  SELECT part, p, fails, n, good, toxic, coalesce(list_position(list_transform(p, lambda x: fails[x]), true), 6) AS gone
  FROM c, perm
), steps AS (
  SELECT part, p, s AS step, p[s] AS f,
    sum(CASE WHEN gone > s THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN gone = s THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails[p[s]] AND gone < s THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[p[s]] AND len(list_filter(fails, lambda x: x)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = s THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN gone = s THEN toxic ELSE 0 END) AS toxic_lost
  FROM ranked, range(1, 6) r(s) GROUP BY part, p, s
)
SELECT part, array_to_string(list_transform(p, lambda x: substr('ABCDE', CAST(x AS INTEGER), 1)), '') AS filter_order,
  CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM steps
"""


@query("op13_filter_audit", SQL)
def op13_filter_audit(spark, sf_dir):
    masked = masked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return audit(masked, "ABCDE", ["good", "toxic"])
