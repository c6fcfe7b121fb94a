import re
from collections import Counter
from itertools import permutations

import numpy as np

from voxlens.llm.filter_audit import audit, masked_documents, removal_steps


def failing(rows):
    """(part, failing letters) per (id, text, source), straight from the rules."""
    out = []
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        bad = ""
        bad += "A" if len(words) < 50 else ""
        bad += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        bad += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        bad += "D" if re.search(r"[#$%&*|]", text) else ""
        bad += "E" if i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows) else ""
        out.append((source or "", bad))
    return out


def brute(rows, labels):
    """The report by walking every document through every order."""
    marks = failing(rows)
    lines, shapley = [], Counter()
    for part in {p for p, _ in marks}:
        own = [(bad, labels.get(i, (0, 0))) for (p, bad), (i, _, _) in zip(marks, rows) if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                shapley[part, f] += len(gone)
                lines.append([part, "".join(order), step, len(left), len(gone), sum(f in x[0] for x in own) - len(gone),
                              sum(x[0] == f for x in own), sum(x[1][0] for x in gone), sum(x[1][1] for x in gone), f])
    return sorted(tuple(x[:-1]) + (shapley[x[0], x[-1]],) for x in lines)


def test_given_documents(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    known = {r.doc_id: (int(r.quality == 1), int(r.toxic == 1)) for r in labels.collect()}
    got = sorted(tuple(r) for r in audit(masked_documents(docs, labels), "ABCDE", ["good", "toxic"]).collect())
    assert got == brute(rows, known)


def test_odd_rows(spark, texts):
    docs = texts.withColumn("source", texts["kept"].cast("string")).withColumn("mask", texts["kept"]).withColumn("part", texts["kept"])
    more = [(20, "W" * 30 + " a#b " * 60, None), (21, " ".join(f"w{i}" for i in range(60)), "s"), (22, " ".join(f"w{i}" for i in range(60)), "s"),
            (22, " ".join(f"w{i}" for i in range(60)), "t"), (23, "a b " * 200, "s")]
    added = spark.createDataFrame(more, "doc_id long, text string, source string")
    docs = docs.unionByName(added, allowMissingColumns=True)
    labels = spark.createDataFrame([(22, 1, None), (22, 0, 1), (20, None, 1), (None, 1, 1), (99, 1, 1), (23, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = sorted(tuple(r) for r in audit(masked_documents(docs, labels), "ABCDE", ["good", "toxic"]).collect())
    assert got == brute(rows, {22: (1, 1), 20: (0, 1)})


def test_no_rows(spark, texts):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = texts.withColumn("source", texts["text"])
    assert audit(masked_documents(docs.limit(0), labels), "ABCDE", ["good", "toxic"]).count() == 0
    assert audit(masked_documents(docs, labels), "ABCDE", ["good"]).agg({"good_lost": "sum"}).first()[0] == 0


def test_steps_of_any_number_of_filters():
    for k in (1, 3, 4):
        orders, steps = removal_steps(k)
        for mask in range(1 << k):
            for at, order in enumerate(orders):
                went = [s for s, f in enumerate(order) if mask >> f & 1]
                assert steps[mask, at] == (went[0] if went else k)
    assert removal_steps(5)[1].shape == (32, 120) and np.all(removal_steps(5)[1][0] == 5)
