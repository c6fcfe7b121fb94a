"""Query of operator 11."""

from voxlens.llm.collocations import MIN_COUNT, SUBSUMED, TOP, collocations
from voxlens.llm.registry import query, table

SQL = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p
), x AS (
  SELECT lang, unnest(flatten(list_transform([1, 2, 3, 4], lambda k: list_transform(
    range(1, greatest(len(w) - k + 2, 1)), lambda i: {{'k': k, 'phrase': array_to_string(w[i:i + k - 1], ' ')}})))) AS x
  FROM w
), g AS (
  SELECT lang, x.k AS k, x.phrase AS phrase, count(*) AS f FROM x GROUP BY ALL
), cand AS (
  SELECT lang, k, phrase, f AS a FROM g WHERE k > 1 AND f >= {MIN_COUNT}
), open AS (
  SELECT c.* FROM cand c WHERE NOT EXISTS (
    SELECT 1 FROM cand o WHERE o.lang = c.lang AND o.k > c.k AND 100 * o.a >= {SUBSUMED} * c.a
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))
), cut AS (
  SELECT lang, phrase, a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS left_part,
         array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS right_part
  FROM (SELECT *, unnest(range(1, k)) AS j FROM open)
), scored AS (
  SELECT cut.lang, cut.phrase, a, x.f AS l, y.f AS r, j, CAST(CAST(a AS HUGEINT) * 2000000 // (x.f + y.f) AS BIGINT) AS score
  FROM cut JOIN g x ON x.lang = cut.lang AND x.phrase = left_part JOIN g y ON y.lang = cut.lang AND y.phrase = right_part
), worst AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst
), size AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= {TOP}
"""


@query("op11_collocations", SQL)
def op11_collocations(spark, sf_dir):
    return collocations(spark, table(spark, sf_dir, "documents"))
