"""Query of operator 7."""

from voxlens.llm.exact_dedup import exact_groups
from voxlens.llm.registry import query, table

SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


@query("op7_exact_dedup", SQL)
def op7_exact_dedup(spark, sf_dir):
    return exact_groups(table(spark, sf_dir, "documents"))
