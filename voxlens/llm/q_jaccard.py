"""Query of operator 5. All pairs in SQL are too slow on whole tables; tests compare with
brute force."""

from voxlens.llm.jaccard import jaccard_components
from voxlens.llm.registry import query, table


@query("op5_ngram_jaccard")
def op5_ngram_jaccard(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), width=4, num=85, den=100)
