"""Vector and score functions over array columns: Column -> Column, no Python workers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxlens.functions.text import _col


def _total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _total(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL for a zero vector."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def softmax(scores) -> Column:
    """Class probabilities; the maximum is taken off first so that exp stays finite."""
    scores = _col(scores)
    raised = F.transform(scores, lambda x: F.exp(x.cast("double") - F.array_max(scores)))
    return F.transform(raised, lambda x: x / _total(raised))


def top_label(scores, labels) -> Column:
    """Struct of the most probable label (first on a tie) and its probability."""
    scores = _col(scores)
    best = F.array_max(scores)
    names = F.array(*[F.lit(x) for x in labels])
    shares = _total(F.transform(scores, lambda x: F.exp(x.cast("double") - best)))
    return F.struct(
        F.element_at(names, F.array_position(scores, best).cast("int")).alias("label"),
        (F.lit(1.0) / shares).alias("confidence"),
    )
