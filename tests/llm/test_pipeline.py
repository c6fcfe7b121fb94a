import zlib

import corpus_pipeline
from tests.llm.test_exact import brute as exact_brute
from tests.llm.test_jaccard import brute as near_brute
from voxlens.llm.q_quality import op1_quality_classifier
from voxlens.llm.q_toxicity import op2_toxicity


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        steps[name] = docs = spark.read.parquet(f"{tmp_path}/{name}")
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(steps[name].columns == columns for name in list(steps)[:-1])
    ids = {name: {r.doc_id for r in df.select("doc_id").collect()} for name, df in steps.items()}

    toxic = {r.doc_id for r in op2_toxicity(spark, sf).where("predicted = 1").collect()}
    everything = {r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert toxic and ids["toxicity"] == everything - toxic
    assert ids["quality"] < ids["toxicity"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(labels.get(i, 1) == 1 for i in ids["quality"])
    good = {r.doc_id for r in op1_quality_classifier(spark, sf).where("score > 0.9").collect()}
    assert len(good & ids["toxicity"] - ids["quality"]) <= 0.01 * len(good)

    rows = [(r.doc_id, r.text) for r in steps["quality"].collect()]
    assert ids["exact_copies"] == {r[0] for r in exact_brute(rows) if r[3]}
    rows = [(r.doc_id, r.text) for r in steps["exact_copies"].collect()]
    assert ids["near_copies"] == {c for _, _, c in near_brute(rows, 5, 80, 100)}
    assert ids["packing"] == ids["near_copies"]
    assert zlib.crc32(b"\0\0\0\0") and steps["packing"].where("length < 1 or offset + length > 1024").count() == 0


def test_no_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() == 0
