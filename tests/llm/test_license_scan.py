import random
import re

import pytest

from voxlens.llm.license_scan import BLOCK, PHRASES, STEP, TEMPLATES, mark, scan, template_hits, template_pairs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(text, templates=TEMPLATES, threshold=80):
    """Facts of one text, every block against every template."""
    ws = WORD.findall(lower(text))
    spots = [(p, label) for phrase, label in PHRASES for k in [phrase.split()] for p in range(len(ws)) if ws[p : p + len(k)] == k]
    labels, best = {label for _, label in spots}, 0.0
    for at in range(0, len(ws) + 1, STEP):
        own = ws[at : at + BLOCK]
        own = set(zip(own, own[1:]))
        for label, pairs in template_pairs(templates):
            n = len(own & set(pairs))
            if 100 * n >= threshold * len(pairs):
                labels, best = labels | {label}, max(best, n / len(pairs))
    places = [p for p, _ in spots]
    return (len(ws), len(spots), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in spots})), ",".join(sorted(labels)), 1.0 if spots else best)


def check(spark, docs, **kw):
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.select("doc_id", "text").collect()), key=repr)
    assert sorted((tuple(r) for r in scan(spark, docs, **kw).collect()), key=repr) == want
    return want


def test_given_documents(spark, sf):
    want = check(spark, spark.read.parquet(f"{sf}/documents.parquet"))
    assert {"gpl,gpl-3.0", "mit", "apache,apache-2.0"} & {w[6] for w in want}


def test_odd_texts(spark, texts):
    assert [w for w in check(spark, texts.withColumn("labels", texts["kept"]).withColumn("pair", texts["kept"])) if w[6]] == []
    assert scan(spark, texts.limit(0)).count() == 0


def test_notices_anywhere_and_changed(spark):
    rng, rows = random.Random(5), []
    for _, text in TEMPLATES:
        for changed in range(0, 5):
            ws = text.split()
            for _ in range(changed):
                ws[rng.randrange(len(ws))] = "other"
            lead = [f"w{rng.randrange(90)}" for _ in range(rng.choice([0, 1, 3, 40, 62, 63, 64, 65, 127, 128, 129, 500]))]
            rows.append((len(rows), " ".join(lead) + rng.choice([" ", "\n", ", "]) + rng.choice([" ", "\n"]).join(ws).upper() + " the end " * 9))
    rows += [(900, "mit licence; MIT-License mit\nlicense, cc-by CC BY. gnu GENERAL public license"), (901, "cc bypass mit licenses ccby"),
             (902, "É mit license É" * 3), (903, "apache " * 5 + "license " * 5)]
    want = check(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert {w[6] for w in want} >= {"isc", "bsd", "lgpl", "unlicense", "mpl-2.0", "cc-by-4.0"}


def test_every_block_and_only_those(spark, sf):
    rng = random.Random(3)
    vocabulary = [f"t{i}" for i in range(12)]
    templates = [(f"l{k}", " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([2, 3, 8, 20, 64, 65, 66, 150])]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 70, 300, 1000]))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = template_pairs(templates)
    pairs = list(dict.fromkeys(p for _, own in parts for p in own))
    for threshold in (30, 60, 100):
        hits = template_hits(spark, mark(docs, pairs).drop("row").withColumnRenamed("id", "row"), parts, pairs, threshold)
        got = sorted((r.row, r.first_word, r.template, r.overlap) for r in hits.collect())
        want = []
        for i, text in enumerate(texts):
            ws = text.split()
            for at in range(0, len(ws), STEP):
                own = ws[at : at + BLOCK]
                own = set(zip(own, own[1:]))
                want += [(i, at, t, len(own & set(p))) for t, (_, p) in enumerate(parts) if 100 * len(own & set(p)) >= threshold * len(p)]
        assert got == sorted(want)


def test_templates_are_bounded():
    with pytest.raises(ValueError):
        template_pairs([("x", "one")])
    with pytest.raises(ValueError):
        template_pairs([("x", " ".join(f"w{i}" for i in range(70000)))])
