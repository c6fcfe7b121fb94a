import hashlib
import re
from collections import defaultdict

from voxlens.llm.exact_dedup import drop_copies, exact_groups, repeated_filter


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in groups.items():
        first = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        open_ = True
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, first, len(ids), open_, sha))
            open_ = False
    return sorted(out, key=repr)


def test_groups(texts):
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    got = sorted((tuple(r) for r in exact_groups(texts).collect()), key=repr)
    assert got == brute(rows)


def test_crowded_filter_changes_nothing(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted((tuple(r) for r in exact_groups(docs, cells=32768).collect()), key=repr) == brute(rows)


def test_whole_rows_that_stay(texts):
    got = drop_copies(texts)
    assert got.columns == texts.columns
    kept = [(r[0], r[1], r[2]) for r in exact_groups(texts).where("kept").collect()]
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted((k[0] for k in kept), key=repr)


def test_no_rows(texts):
    assert exact_groups(texts.limit(0)).count() == 0
    assert drop_copies(texts.limit(0)).count() == 0


def test_only_repeated_keys_pass_the_filter(spark):
    from pyspark.sql import functions as F

    keys = spark.range(1000).select(F.xxhash64((F.col("id") % 900).cast("string")).alias("k"))
    bits = repeated_filter(keys, F.col("k"))
    marked = bits.select(F.sum(F.bitmap_count("__bits"))).first()[0]
    assert 100 <= marked <= 220
