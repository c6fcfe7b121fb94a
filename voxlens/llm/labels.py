"""Bounded samples of labelled texts, and the use of models that were learned from them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    crc = F.crc32(id_col.cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label_col: str, held: Column, bound: int, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, text, label) of at most ``bound`` labelled rows outside ``held`` (a condition on
    ``id``): those whose id has the smallest hashes. Rows of ``labels`` with a null id or
    label are left out, of several labels of an id the largest counts. The ids are few by
    construction and are broadcast, so ``docs`` is read in place."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held)
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    few = known.orderBy(F.xxhash64("id", F.lit("sample")), "id").limit(bound)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return texts.join(F.broadcast(few), "id")


def score_rows(docs: DataFrame, scorer, data, id_col: str, text_col: str) -> DataFrame:
    """(id, ``score``) per row. ``scorer`` makes, in a task, a function from a column of texts
    to scores out of the broadcast ``data``."""
    def run(batches):
        of = scorer(data)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(of(batch.column(1)))], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, score double")
    return out.withColumnRenamed("id", id_col)


def keep_rows(docs: DataFrame, scorer, data, accept, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score ``accept`` takes: in place,
    without a shuffle or a join."""
    def run(batches):
        of = scorer(data)
        for batch in batches:
            yield batch.filter(pa.array(accept(of(batch.column(at)))))

    at = docs.columns.index(text_col)
    return docs.mapInArrow(run, docs.schema)
