import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlens.llm.ann import nearest


def brute(rows, k=5):
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    norms = np.sqrt((v * v).sum(1))
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        score = (v * v[i]).sum(1) / (norms * norms[i])
        score[i] = -9
        best = np.lexsort((ids, -score))[:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in best]
    return out


@pytest.mark.parametrize("block", [8192, 300])
def test_recall_and_scores(spark, monkeypatch, block):
    from voxlens.llm import ann

    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERIES", 20)
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in table.collect()])
    got = {}
    for r in nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    found = 0
    for q, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == [1, 2, 3, 4, 5] and rows == sorted(rows, key=lambda r: (-r[2], r[1]))
        exact = dict(want[q])
        assert all(abs(exact[v] - s) < 1e-12 for _, v, s in rows if v in exact)
        found += sum(v in exact for _, v, _ in rows)
    assert found >= 0.93 * 5 * len(want)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, [1.0, None]), (1, [2.0, 0.0]),
            (2, [1.0, float("nan")]), (3, [0.0, 1.0]), (None, [1.0, 1.0]), (200, [1.0, 2.0, 3.0]), (250, []),
            (300, [float("inf"), 1.0])]
    table = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id bigint, embedding array<float>, rank int, block int")
    got = sorted(tuple(r) for r in nearest(table, F.col("vec_id") % 50 == 0).collect())
    assert got == sorted([(0, 1, 0, 1.0), (0, 2, 1, 1.0), (0, 3, 3, 0.0)] * 2)
    assert nearest(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_many_equal_vectors(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0, 3.0]) for i in range(300)], "vec_id bigint, embedding array<float>")
    got = {}
    for r in nearest(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert {q: sorted(v) for q, v in got.items()} == {
        q: [i for i in range(6) if i != q][:5] for q in range(0, 300, 50)}
