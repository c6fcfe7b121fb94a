"""Query of operator 2. SQL cannot learn the lexicon; tests measure held-out accuracy."""

from pyspark.sql import functions as F

from voxlens.llm.labels import held_out, keep_rows
from voxlens.llm.registry import query, table
from voxlens.llm.toxicity import broadcast, learn, score, scorer

REJECT = 0.7


def scored(spark, docs, labels):
    """Score and decision per document; learned from labels with crc32(id) mod 3 <> 1."""
    model = learn(docs, labels, held_out(F.col("id"), 3, 1))
    return score(spark, docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= REJECT).cast("int").alias("predicted"),
    )


def accepted(spark, docs, labels):
    """The documents that are not rejected, with all columns."""
    model = learn(docs, labels, held_out(F.col("id"), 3, 1))
    return keep_rows(docs, scorer, broadcast(spark, model), lambda score: score < REJECT)


@query("op2_toxicity")
def op2_toxicity(spark, sf_dir):
    return scored(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
