"""A corpus pipeline of five operators: toxicity, quality, exact copies, near copies, packing.

Each stage works on all that its predecessor kept and returns the columns of documents; the
last returns the packed pieces. Toxic texts (score of 0.7 and more) and texts of low quality
(score below 0.3) go, one row of equal texts stays, one document of each group of near copies
stays (shingles of five words, similarity of 0.8 and more).
"""

from __future__ import annotations

from voxlens.llm import q_packing, q_quality, q_toxicity
from voxlens.llm.exact_dedup import drop_copies
from voxlens.llm.jaccard import drop_near_copies
from voxlens.llm.packing import pack
from voxlens.session import fresh_path

#: No SQL: the first two stages learn models and the last one tokenizes.
ORACLE_SQL = None


def _labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark, docs, sf_dir):
    return q_toxicity.accepted(spark, docs, _labels(spark, sf_dir))


def quality(spark, docs, sf_dir):
    return q_quality.accepted(spark, docs, _labels(spark, sf_dir))


def exact_copies(spark, docs, sf_dir):
    return drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    return drop_near_copies(docs)


def packing(spark, docs, sf_dir):
    return pack(spark, docs, q_packing.TOKENIZER)


STAGES = [
    ("toxicity", toxicity),
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("packing", packing),
]


def run(spark, sf_dir):
    """All stages on the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
