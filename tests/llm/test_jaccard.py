from collections import Counter, defaultdict

import pytest

from voxlens.llm.groups import components, join_salted, with_group
from voxlens.llm.jaccard import drop_near_copies, jaccard_components


def brute(rows, width, num, den):
    sets, holders = [], defaultdict(list)
    for _, text in rows:
        words = (text or "").encode().lower().split()
        sets.append(set(zip(*[words[i:] for i in range(width)])) if len(words) >= width else ({tuple(words)} if words else set()))
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        for j, common in Counter(j for x in s for j in holders[x] if j > i).items():
            if den * common >= num * (len(s) + len(sets[j]) - common):
                parent[root(j)] = root(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return sorted(((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def found(docs, *options):
    return sorted((tuple(r) for r in jaccard_components(docs, *options).collect()), key=repr)


@pytest.mark.parametrize("options", [(4, 85, 100), (5, 80, 100), (2, 50, 100)])
def test_given_documents(spark, sf, options):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found(docs, *options) == brute([(r.doc_id, r.text) for r in docs.collect()], *options)


@pytest.mark.parametrize("options", [(4, 85, 100), (1, 60, 100)])
def test_groups_of_near_copies(spark, options):
    """Copies that differ from one text by one to several words, so that some are linked only
    through others, and texts that share a passage without being alike."""
    import random

    draw = random.Random(3)
    rows = []
    for base in range(6):
        words = [f"w{base}x{i}" for i in range(60)]
        for _ in range(25):
            copy = list(words)
            for _ in range(draw.randint(0, 5)):
                copy[draw.randrange(60)] = f"e{draw.randrange(40)}"
            rows.append((len(rows), " ".join(copy)))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(1000 + i, f"{' '.join(f'q{i}y{k}' for k in range(60))} {passage}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(docs, *options) == brute(rows, *options)


def test_truncated_copies(spark):
    """Beginnings of one text: the shortest links with none of the longer two, which link."""
    rows = []
    for base in range(12):
        words = [f"w{base}x{i}" for i in range(23)]
        rows += [(len(rows) + i, " ".join(words[:n])) for i, n in enumerate((23, 22, 19))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(docs, 4, 85, 100) == brute(rows, 4, 85, 100)


def test_odd_texts(texts):
    rows = [(r.doc_id, r.text) for r in texts.collect()]
    assert found(texts, 4, 85, 100) == brute(rows, 4, 85, 100)
    assert jaccard_components(texts.limit(0)).count() == 0


def test_one_document_of_each_group_stays(texts, spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute([(r.doc_id, r.text) for r in docs.collect()], 5, 80, 100)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert drop_near_copies(texts).columns == texts.columns


def test_components(spark):
    path = [(i, i + 1) for i in range(40)]
    links = spark.createDataFrame([*path, (100, 99), (99, 98), (7, 3), (50, 50), (100, 99)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 98: 98, 99: 98, 100: 98, 50: 50}
    assert components(links.limit(0)).count() == 0


def test_salted_groups_and_joins(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    got = {(r.k, r["__first"], r["__size"]) for r in with_group(rows, ["k"], F.col("id"), F.col("id"), 4).collect()}
    assert got == {(0, 0, 334), (1, 1, 333), (2, 2, 333)}
    small = spark.createDataFrame([(0, "a"), (2, "b")], "k bigint, v string")
    joined = join_salted(rows, small, ["k"], F.col("id"), 4)
    assert joined.count() == 667 and joined.columns == ["k", "id", "v"]
