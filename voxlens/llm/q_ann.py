"""Query of operator 4. It is approximate; tests measure recall against brute force."""

from pyspark.sql import functions as F

from voxlens.llm.ann import nearest
from voxlens.llm.registry import query, table


@query("op4_ann_collisions")
def op4_ann_collisions(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
