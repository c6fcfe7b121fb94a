import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxlens.llm import quality, toxicity
from voxlens.llm.labels import held_out, keep_rows
from voxlens.llm.q_quality import op1_quality_classifier
from voxlens.llm.q_toxicity import op2_toxicity
from voxlens.llm.shingles import byte_runs

DATA = "/root/testdata/sf0.1"


def accuracy(spark, query, label):
    scored = query(spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert scored.count() == docs.count()
    assert scored.where("score is null or score < 0 or score > 1").count() == 0
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", label)
    met = scored.where("held_out").join(labels, "doc_id").groupBy(label).agg(F.avg("predicted").alias("p")).collect()
    return {r[label]: r.p for r in met}


def test_quality_on_held_out_documents(spark):
    share = accuracy(spark, op1_quality_classifier, "quality")
    assert share[1] > 0.99 and share[0] < 0.05


def test_toxicity_on_held_out_documents(spark):
    share = accuracy(spark, op2_toxicity, "toxic")
    assert share[1] > 0.75 and share[0] < 0.01


def test_held_out_rows(spark):
    import zlib

    rows = spark.range(1000).select("id", held_out(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_texts_and_missing_labels(spark, texts, module, label):
    labels = spark.createDataFrame([(1, None), (None, 1), (4, 0)], f"doc_id bigint, {label} int")
    for model in (module.learn(texts, labels, F.lit(False)), module.learn(texts.limit(0), labels.limit(0), F.lit(False))):
        rows = module.score(spark, texts, model).collect()
        assert sorted((r.doc_id for r in rows), key=repr) == sorted((r.doc_id for r in texts.collect()), key=repr)
        assert all(0 <= r.score <= 1 for r in rows)
        assert module.score(spark, texts.limit(0), model).count() == 0


def test_learned_model_takes_odd_texts(spark, texts, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.learn(docs, labels, F.lit(False))
    scores = {r.doc_id: r.score for r in quality.score(spark, texts, model).collect() if r.doc_id in (1, 2, 3)}
    assert len(set(scores.values())) == 1


def test_rows_are_kept_whole(spark, texts):
    def scorer(data):
        return lambda column: np.array([len(x.as_py() or "") for x in column], float)

    kept = keep_rows(texts, scorer, spark.sparkContext.broadcast(None), lambda score: score > 2)
    assert kept.schema == texts.schema
    want = [r for r in texts.collect() if len(r.text or "") > 2]
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, want))


def test_gradients_of_the_attention_model():
    random = np.random.default_rng(0)
    x, owner, y = random.normal(size=(9, 4)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([1.0, 0, 0, 1])
    first = np.searchsorted(owner, np.arange(4))
    m = {"W": random.normal(size=(4, 5)), "b": random.normal(size=5), "V": random.normal(size=(5, 3)),
         "U": random.normal(size=(5, 3)), "w": random.normal(size=3), "c": random.normal(size=5), "c0": np.zeros(1)}

    def loss():
        p = quality._forward(m, x, owner, first)["score"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, gradient in quality._gradients(m, x, owner, first, y).items():
        for at in np.ndindex(m[name].shape):
            old = m[name][at]
            m[name][at] = old + 1e-6
            up = loss()
            m[name][at] = old - 1e-6
            down = loss()
            m[name][at] = old
            assert abs((up - down) / 2e-6 - gradient[at]) < 1e-5


def test_every_text_has_a_passage():
    column = pa.array(["", None, "a b c", " ", "w " * 500], pa.string())
    for _, data, bounds in byte_runs(column):
        x, owner = quality.passage_features(data, bounds)
        assert np.bincount(owner).tolist() == [1, 1, 1, 1, 11]
        assert not x[[0, 1, 3]].any() and np.isfinite(x).all()


def test_folding():
    folded, starts = toxicity.fold(["You 1d10t! lоser", "", "l​oser $tupid 555 x$$$ a\n\nb", "ｓｃｕｍ"])
    assert folded == " you idiot ioser   ioser stupid x a b  scum "
    assert [folded[a:b].split() for a, b in zip(starts, [*starts[1:], None])][3] == ["scum"]


def test_exceptions_cancel_entries():
    matcher = toxicity.Matcher({" idio": 3.0, " idiot ": 5.0}, [" idiot proof "])
    assert matcher.hits(" an idiot proof idiot idiom ") == [(15, 5.0), (21, 3.0)]
    assert toxicity.Matcher({}, []).hits(" idiot ") == []


def test_copies_of_one_toxic_text_teach_nothing_else():
    class Row:
        def __init__(self, label, entries):
            self.label, self.entries = label, entries

    # entry 0 is in all toxic texts, entry 1 only in some copies of one of them
    rows = [Row(1, [0, 1])] * 6 + [Row(1, [0])] * 20 + [Row(0, [])] * 100
    assert toxicity._explain(2, rows)[0] == 0
    assert toxicity._explain(2, [Row(0, [0])] * 5) == []
