import random
import re
from collections import Counter

from pyspark.sql import functions as F

from voxlens.llm import collocations as C


def brute(rows, min_count=30, subsumed=80, top=2000):
    """The report from plain counts of all phrases, (text, lang) rows."""
    counts, sizes = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(ws)
            for k in range(1, 5):
                counts.update((lang, tuple(ws[i : i + k])) for i in range(len(ws) - k + 1))
    found = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= min_count}
    out = []
    for (lang, p), a in found.items():
        if any(x == lang and len(q) > len(p) and 100 * b >= subsumed * a and any(q[i : i + len(p)] == p for i in range(len(q)))
               for (x, q), b in found.items()):
            continue
        cuts = [(2000000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, counts[lang, p[:k]], counts[lang, p[k:]], sizes[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked, seen = [], Counter()
    for r in out:
        seen[r[0]] += 1
        if seen[r[0]] <= top:
            ranked.append((r[0], seen[r[0]], *r[1:]))
    return ranked


def check(spark, docs, **kw):
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    extra = {k: v for k, v in kw.items() if k != "filter_bits"}
    want = brute(rows, **extra)
    got = C.collocations(spark, docs, **kw).orderBy("lang", "rank")
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [tuple(r) for r in got.collect()] == want
    return want


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(check(spark, docs)) > 20
    assert len(check(spark, docs, min_count=8, top=50)) > 50


def test_crowded_filter_and_hot_prefixes_change_nothing(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(spark, docs, min_count=12, filter_bits=64)
    monkeypatch.setattr(C, "HOT_SHARE", 0.0)
    check(spark, docs, min_count=12)


def test_small_runs(spark, sf, monkeypatch):
    monkeypatch.setattr(C, "RUN_BYTES", 300)
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"), min_count=20)


def test_odd_texts(spark, texts):
    docs = texts.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "x").when(F.col("doc_id") % 3 == 1, ""))
    docs = docs.withColumn("phrase", F.lit(1)).withColumn("prefix", F.lit(2)).withColumn("next", F.lit(3)).withColumn("n", F.lit(4))
    check(spark, docs, min_count=1)
    check(spark, docs, min_count=2, subsumed=50)
    assert C.collocations(spark, docs.limit(0)).count() == 0
    assert C.collocations(spark, docs.where("text is null")).count() == 0


def test_random_words(spark):
    rng = random.Random(1)
    marks = [" ", " ", " ", "\t", "  ", ". ", "\n", "\x0b", ";", "\x1f", "  ", "\xa0", "A", "É"]
    rows = []
    for _ in range(60):
        text = "".join(rng.choice(["a", "b", "ß", "C", "漢", "x-y", "7"]) + rng.choice(marks) for _ in range(rng.randrange(60)))
        rows.append((text, rng.choice(["en", "de", None, "und", "en en"])))
    docs = spark.createDataFrame(rows * 2, "text string, lang string").repartition(5)
    check(spark, docs, min_count=3)
    check(spark, docs, min_count=4, subsumed=95, top=7)


def test_exact_beyond_64_bits(spark):
    a = 20_000_000_000_003
    facts = spark.createDataFrame(
        [("en", "a", a + 4, None), ("en", "b", a + 9, None), ("en", "a b", a, None)],
        "lang string, phrase string, f bigint, cover bigint")
    sizes = spark.createDataFrame([("en", 4 * a)], "lang string, n bigint")
    got = C.rank_phrases(facts, sizes).first()
    assert got.score == 2000000 * a // (2 * a + 13) and got.n == 4 * a
