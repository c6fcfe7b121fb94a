"""Query of operator 9.

The table holds no preferences, so pairs are derived from it: chosen is a conversation up to
its last reply of the assistant, rejected the same with the last reply of the next conversation
by id that has one, the last going on with the first. Conversations without a reply of the
assistant have no pair, nor has the only one that has a reply.
"""

from pyspark.sql import functions as F

from voxlens.llm.chat import format_pairs
from voxlens.llm.groups import join_salted
from voxlens.llm.registry import query, table
from voxlens.operators.skew import number_rows
from voxlens.session import stage

SQL = r"""
WITH t AS (
  SELECT conv_id, turn, min({'r': coalesce(role, ''), 't': coalesce(text, '')}) AS s
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY conv_id, turn
), last AS (
  SELECT conv_id, max(turn) AS at FROM t WHERE s.r = 'assistant' GROUP BY conv_id
), reply AS (
  SELECT t.conv_id, t.turn, t.s.t AS text,
         coalesce(lead(t.s.t) OVER w, first_value(t.s.t) OVER w) AS other,
         count(*) OVER () AS n
  FROM t JOIN last ON t.conv_id = last.conv_id AND t.turn = last.at
  WINDOW w AS (ORDER BY t.conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), parts AS (
  SELECT t.conv_id AS pair_id, 'prompt' AS part, t.turn, t.s.r AS role, t.s.t AS text, 0 AS trained
  FROM t JOIN reply ON t.conv_id = reply.conv_id AND n > 1
  WHERE t.turn < reply.turn OR (t.turn = reply.turn AND reply.text = reply.other)
  UNION ALL
  SELECT conv_id, 'chosen', turn, 'assistant', text, 1 FROM reply WHERE n > 1 AND text <> other
  UNION ALL
  SELECT conv_id, 'rejected', turn, 'assistant', other, 1 FROM reply WHERE n > 1 AND text <> other
), made AS (
  SELECT *, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered FROM parts
)
SELECT pair_id, part, turn, role, md5(rendered) AS rendered_md5, length(rendered) AS n_chars,
       CASE WHEN trained = 1 THEN length('<|im_start|>' || role) + 1 ELSE 0 END AS loss_start,
       CASE WHEN trained = 1 THEN length(rendered) ELSE 0 END AS loss_end
FROM made
"""


def preference_turns(conversations):
    """(pair_id, side, turn, role, text) of the derived pairs, one per conversation."""
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = conversations.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(
        F.min(said).alias("said")).select("conv_id", "turn", "said.role", "said.text")
    turns = stage(turns, "chat-turns")
    last = turns.where("role = 'assistant'").groupBy("conv_id").agg(
        F.max(F.struct("turn", "text")).alias("reply")).select("conv_id", F.col("reply.turn").alias("at"), "reply.text")
    # Numbers of all replies by id; each meets the reply of the next number.
    last = stage(number_rows(last, [F.asc("conv_id")], "at_row"), "chat-replies")
    n = last.count()
    other = last.select((F.pmod(F.col("at_row") - 2, F.lit(max(n, 1))) + 1).alias("at_row"), F.col("text").alias("other"))
    last = last.join(other, "at_row").select("conv_id", "at", "other").where(F.lit(n > 1))
    chosen = join_salted(turns, last.select("conv_id", "at"), ["conv_id"], F.col("turn")).where("turn <= at")
    sides = chosen.where("turn < at").withColumn("side", F.explode(F.array(F.lit("chosen"), F.lit("rejected"))))
    sides = sides.select("conv_id", "side", "turn", "role", "text").union(
        chosen.where("turn = at").select("conv_id", F.lit("chosen"), "turn", "role", "text")
    ).union(last.select("conv_id", F.lit("rejected"), F.col("at"), F.lit("assistant"), "other"))
    return sides.withColumnRenamed("conv_id", "pair_id")


@query("op9_chat_preferences", SQL)
def op9_chat_preferences(spark, sf_dir):
    parts = format_pairs(preference_turns(table(spark, sf_dir, "conversations")))
    return parts.select("pair_id", "part", "turn", "role", F.md5("rendered").alias("rendered_md5"),
                        F.length("rendered").cast("bigint").alias("n_chars"),
                        F.col("loss_start").cast("bigint").alias("loss_start"), F.col("loss_end").cast("bigint").alias("loss_end"))
