"""Nearest vectors by collision-counting hashing.

Vectors are scaled to length one and projected on random lines. Each projection alone is a
sorted array. A query looks at a window around its own projection in every array; windows are
widened level by level (virtual rehashing, no table is built anew), and a vector that falls
into enough windows is verified by its exact cosine. A search ends when enough verified
vectors are within the radius of the level before; the last level takes in all vectors, so a search
that finds too few ends with all of them verified.

The table is cut into blocks of a fixed size, each with its own sorted arrays, and a block of
queries meets every block of vectors; the best of all blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxlens.session import stage

#: Vectors and queries of one block.
BLOCK, QUERIES = 8192, 1024
#: Projections, the share of them that must collide, and half the window at radius one.
LINES, SHARE, HALF = 128, 0.4, 0.6
#: Radii of the levels: FIRST * GROWTH ** i.
FIRST, GROWTH, LEVELS = 0.8, 1.1, 10
SEED = 11


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(1, keepdims=True)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact cosines in double precision; equal vectors get equal values."""
    q, v = query / np.abs(query).max(), vectors / np.abs(vectors).max(1, keepdims=True)
    return (v * q).sum(1) / (np.sqrt((v * v).sum(1)) * np.sqrt((q * q).sum()))


class Block:
    """Sorted projections of a block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        lines = np.random.default_rng(SEED).normal(size=(vectors.shape[1], LINES))
        self.lines = lines
        values = _units(self.vectors) @ lines
        self.order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32).copy()
        self.values = np.take_along_axis(values.T, self.order, 1)

    def search(self, queries: np.ndarray, own: list[np.ndarray], k: int):
        """Per query the places in the block and cosines of its nearest ``k``; ``own`` are the
        places that take no part."""
        n = len(self.ids)
        radii = FIRST * GROWTH ** np.arange(LEVELS)
        at = _units(queries) @ self.lines
        low = np.empty((LINES, len(queries), LEVELS), np.int32)
        high = np.empty_like(low)
        for j in range(LINES):
            low[j] = np.searchsorted(self.values[j], at[:, j, None] - HALF * radii)
            high[j] = np.searchsorted(self.values[j], at[:, j, None] + HALF * radii, "right")
        need = int(np.ceil(SHARE * LINES))
        for q in range(len(queries)):
            yield self._one(queries[q], own[q], k, need, radii, low[:, q], high[:, q], n)

    def _one(self, query, own, k, need, radii, low, high, n):
        count, done = np.zeros(n, np.int64), np.zeros(n, bool)
        done[own] = True
        places, scores = [np.zeros(0, np.int64)], [np.zeros(0)]
        a = b = None
        for level, radius in enumerate(radii):
            c, d = low[:, level], high[:, level]
            if a is None:
                seen = [self.order[j, c[j] : d[j]] for j in range(LINES)]
            else:
                seen = [self.order[j, c[j] : a[j]] for j in range(LINES)]
                seen += [self.order[j, b[j] : d[j]] for j in range(LINES)]
            a, b = c, d
            count += np.bincount(np.concatenate(seen), minlength=n)
            new = np.flatnonzero((count >= need) & ~done)
            if len(new):
                done[new] = True
                places.append(new)
                scores.append(cosines(query, self.vectors[new]))
            found = np.concatenate(scores)
            # A cosine of s is a distance of sqrt(2 - 2 s) between vectors of length one. What is
            # that near has met the windows of a level more.
            if (found >= 1 - (radius / GROWTH) ** 2 / 2).sum() >= k:
                break
        else:
            new = np.flatnonzero(~done)
            places.append(new)
            scores.append(cosines(query, self.vectors[new]))
        place, score = np.concatenate(places), np.concatenate(scores)
        best = np.lexsort((self.ids[place], -score))[:k]
        return place[best], score[best]


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().reshape(len(column), -1)


def _search(k: int):
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if queries.num_rows and vectors.num_rows:
            block = Block(vectors.column("id").to_numpy(), _matrix(vectors.column("vector")))
            order = np.argsort(vectors.column("id").to_numpy(), kind="stable")
            rows = vectors.column("row").to_numpy()[order]
            query_rows, ids = queries.column("row").to_numpy(), queries.column("id").to_numpy()
            own = [np.flatnonzero(rows == r) for r in query_rows]
            for q, (place, score) in enumerate(block.search(_matrix(queries.column("vector")), own, k)):
                out["query_row"].extend([query_rows[q]] * len(place))
                out["query_id"].extend([ids[q]] * len(place))
                out["vec_id"].extend(block.ids[place].tolist())
                out["score"].extend(score.tolist())
        return pa.table({
            "query_row": pa.array(out["query_row"], pa.int64()), "query_id": pa.array(out["query_id"], pa.int64()),
            "vec_id": pa.array(out["vec_id"], pa.int64()), "score": pa.array(out["score"], pa.float64()),
        })
    return run


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, with a component, none null or not finite, not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of every query row, by largest cosine, ties to the smaller id:
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``. Every usable row but the query's own
    is a candidate; with fewer than ``k`` all are returned.

    ``is_query`` is a condition on the id. Rows that are not ``usable`` or have no id take no
    part; vectors of different length do not meet. Rows that repeat an id are rows of their
    own, also as queries. Other columns are not read. No rows give no rows.
    """
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector"))).withColumn("size", F.size("vector"))
    rows = stage(rows, "ann-vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    blocks, asking = max(1, -(-sizes.n // BLOCK)), max(1, -(-sizes.q // QUERIES))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    part = F.pmod(F.xxhash64("row", F.lit("query")), F.lit(asking)).cast("int")

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    keys = ["size", "block", "part"]
    table = rows.select("row", "id", "vector", "size", block.alias("block"), numbers(asking).alias("part"))
    asked = rows.where("asks").select("row", "id", "vector", "size", part.alias("part"), numbers(blocks).alias("block"))
    met = asked.groupBy(*keys).cogroup(table.groupBy(*keys)).applyInArrow(
        _search(k), "query_row bigint, query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
