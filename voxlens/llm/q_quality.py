"""Query of operator 1. SQL cannot learn the model; tests measure held-out accuracy."""

from pyspark.sql import functions as F

from voxlens.llm.labels import held_out, keep_rows
from voxlens.llm.quality import learn, score, scorer
from voxlens.llm.registry import query, table

ACCEPT = 0.3


def scored(spark, docs, labels):
    """Score and decision per document; learned from labels with crc32(id) mod 5 <> 0."""
    model = learn(docs, labels, held_out(F.col("id"), 5, 0))
    return score(spark, docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(spark, docs, labels):
    """The documents that are not rejected, with all columns."""
    model = learn(docs, labels, held_out(F.col("id"), 5, 0))
    return keep_rows(docs, scorer, spark.sparkContext.broadcast(model), lambda score: score >= ACCEPT)


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    return scored(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
