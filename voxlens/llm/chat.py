"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns of a pair is rendered once, as the prompt; what follows on
either side is its completion, with the characters that a loss counts. A pair is handled as
rows of turns throughout, so a conversation that holds a third of all rows is no single row
or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlens.llm.groups import join_salted

BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def head(role: Column) -> Column:
    return F.concat(F.lit(BEGIN), role, F.lit("\n"))


def format_pairs(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """Parts of every pair of ``turns`` (pair_id, side, turn, role, text), side being
    ``chosen`` or ``rejected``: ``pair_id``, ``part`` (prompt, chosen, rejected), ``turn``,
    ``role``, ``rendered``, ``loss_start`` and ``loss_end`` (the characters of ``rendered`` that
    a loss counts: text and end mark of ``trained_role`` in completions, else none, 0 and 0).

    Sides are compared turn number by turn number; the prompt ends before the first number
    where role or text differ or one side has none. Sides without a difference are all prompt,
    a pair with one side only is all completion. A null role or text is the empty string. A
    row that repeats counts once, of different rows with one turn number the smallest (role,
    text). Rows with a null pair, side or turn, and other sides, take no part. Other columns
    are not read. No rows give no rows.
    """
    rows = turns.where(F.col("side").isin("chosen", "rejected") & F.col("pair_id").isNotNull() & F.col("turn").isNotNull())
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    met = rows.groupBy("pair_id", "turn").agg(*[
        F.min(F.when(F.col("side") == side, said)).alias(side) for side in ("chosen", "rejected")
    ])
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    first = met.groupBy("pair_id").agg(F.min(F.when(differs, F.col("turn"))).alias("first"))
    met = join_salted(met, first, ["pair_id"], F.col("turn"))
    common = F.col("first").isNull() | (F.col("turn") < F.col("first"))
    parts = F.when(common, F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("said")))).otherwise(
        F.array(*[F.struct(F.lit(side).alias("part"), F.col(side).alias("said")) for side in ("chosen", "rejected")])
    )
    each = met.select("pair_id", "turn", F.explode(parts).alias("p")).where("p.said is not null")
    each = each.select("pair_id", "turn", "p.part", "p.said.role", F.concat(
        head(F.col("p.said.role")), F.col("p.said.text"), F.lit(END)).alias("rendered"))
    trained = (F.col("part") != "prompt") & (F.col("role") == trained_role)
    return each.select(
        "pair_id", "part", "turn", "role", "rendered",
        F.when(trained, F.length(head(F.col("role")))).otherwise(0).alias("loss_start"),
        F.when(trained, F.length("rendered")).otherwise(0).alias("loss_end"),
    )


def assemble(parts: DataFrame) -> DataFrame:
    """One training example per pair: ``prompt``, ``chosen``, ``rejected`` and the loss spans of
    both completions. An example is one row by its nature: use it where conversations fit one."""
    def of(part: str) -> Column:
        return F.array_sort(F.filter("rows", lambda r: r.part == part))

    def text(part: str) -> Column:
        return F.array_join(F.transform(of(part), lambda r: r.rendered), "")

    def spans(part: str) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<a:bigint,b:bigint>>").alias("found"))
        return F.aggregate(of(part), start, lambda acc, r: F.struct(
            (acc.at + F.length(r.rendered)).alias("at"),
            F.when(r.loss_end > r.loss_start, F.concat(acc.found, F.array(F.struct(
                (acc.at + r.loss_start).alias("a"), (acc.at + r.loss_end).alias("b"))))).otherwise(acc.found).alias("found"),
        )).found

    row = F.struct("turn", "part", "rendered", "loss_start", "loss_end")
    packed = parts.groupBy("pair_id").agg(F.collect_list(row).alias("rows"))
    return packed.select(
        "pair_id", *[text(p).alias(p) for p in ("prompt", "chosen", "rejected")],
        *[spans(p).alias(f"{p}_loss") for p in ("chosen", "rejected")],
    )
