"""License scan: base phrases, and an exact set-similarity join of text blocks with templates.

A block is a window of BLOCK words, each beginning STEP words after the one before, so a passage
of up to STEP + 1 words lies whole in one. Its set, and that of a template, are the pairs of
adjacent words. A block meets a template that it contains to the threshold: overlap over the
template's size.

Pairs are ordered by how often they occur in all documents, rarest first. A block that contains
enough of a template shares one of the template's first ``size - need + 1`` pairs, and one of its
own first (prefix filter), has at least ``need`` pairs (length filter), and cannot fall short
with what follows the two places (positional filter). Only what passes is counted.

The documents are not shuffled: pairs that no template has are dropped while the words are read,
and the prefixes of the templates, of bounded size, go to the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.llm.shingles import byte_runs
from voxlens.llm.spans import byte_set, lowered, owners, words
from voxlens.session import stage

BLOCK, STEP = 128, 64
#: Containment in hundredths.
THRESHOLD = 80
#: Most pairs of all templates together: what goes to every executor.
TEMPLATE_PAIRS = 1 << 16
#: Bytes of text that are cut into words together (or one text, if longer).
RUN_BYTES = 2 << 20

#: Bytes that are not part of a word once A-Z are lower case.
CUTS = byte_set(range(0x00, 0x30), range(0x3A, 0x61), range(0x7B, 0x80))

#: Phrase and label.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

#: Label and text of common license notices.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
             "published by the Free Software Foundation"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]


def _words(text: str) -> list[str]:
    data = lowered(np.frombuffer(text.encode(), np.uint8))
    return words(data, np.array([0, len(data)]), CUTS)[1].to_pylist()


def template_pairs(templates: list[tuple[str, str]]) -> list[tuple[str, list[tuple[str, str]]]]:
    """(label, distinct pairs) of every template; one of more than STEP words counts as several."""
    out = []
    for label, text in templates:
        found = _words(text)
        if len(found) < 2:
            raise ValueError(f"template of {label} has fewer than two words")
        for at in range(0, max(1, len(found) - 1), STEP):
            part = found[at : at + STEP + 1]
            if len(part) > 1:
                out.append((label, list(dict.fromkeys(zip(part, part[1:])))))
    if sum(len(pairs) for _, pairs in out) > TEMPLATE_PAIRS:
        raise ValueError(f"templates hold more than {TEMPLATE_PAIRS} pairs of words")
    return out


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """Values in order, one list per owner from 0 to n - 1."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _marks(phrases: list[tuple[str, str]], pairs: list[tuple[str, str]]):
    """Facts of each text and the places of the pairs that templates have."""
    phrase_words = [(_words(phrase), label) for phrase, label in phrases]
    known = sorted({w for pair in pairs for w in pair} | {w for ws, _ in phrase_words for w in ws})
    number = {w: i for i, w in enumerate(known)}
    codes = np.array([number[a] * len(known) + number[b] for a, b in pairs], np.int64)
    by_code = np.argsort(codes)

    def places(vid: np.ndarray, owner: np.ndarray, ws: list[str]) -> np.ndarray:
        m = len(vid) - len(ws) + 1
        if m <= 0:
            return np.zeros(0, np.int64)
        here = owner[:m] == owner[len(ws) - 1 :]
        for k, w in enumerate(ws):
            here &= vid[k : k + m] == number[w]
        return np.flatnonzero(here)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(known, pa.string())
        for batch in batches:
            for at, data, bounds in byte_runs(batch.column(2), RUN_BYTES):
                n = len(bounds) - 1
                starts, found = words(lowered(data), bounds, CUTS)
                owner = owners(bounds, starts)
                count = np.bincount(owner, minlength=n)
                place = np.arange(len(starts)) - (np.cumsum(count) - count)[owner]
                lookup = pc.fill_null(pc.index_in(found.dictionary, vocabulary), -1).to_numpy(zero_copy_only=False)
                vid = lookup[found.indices.to_numpy()].astype(np.int64) if len(starts) else np.zeros(0, np.int64)
                hits = [(places(vid, owner, ws), label) for ws, label in phrase_words]
                spots = np.sort(np.concatenate([h for h, _ in hits]))
                labels: dict[int, set[str]] = {}
                for h, label in hits:
                    for text in np.unique(owner[h]).tolist():
                        labels.setdefault(text, set()).add(label)
                n_base = np.bincount(owner[spots], minlength=n)
                end = np.cumsum(n_base)
                some = n_base > 0
                first, last = np.zeros(n, np.int64), np.zeros(n, np.int64)
                first[some], last[some] = place[spots[(end - n_base)[some]]], place[spots[end[some] - 1]]
                both = (vid[:-1] >= 0) & (vid[1:] >= 0) & (owner[:-1] == owner[1:])
                left = np.flatnonzero(both)
                code = vid[left] * len(known) + vid[left + 1]
                spot = np.searchsorted(codes[by_code], code).clip(max=len(codes) - 1)
                right = codes[by_code][spot] == code
                left, pair = left[right], by_code[spot[right]]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, n), batch.column(1).slice(at, n),
                    pa.array(count, pa.int64()), pa.array(n_base, pa.int64()),
                    pa.array(first, pa.int64(), mask=~some), pa.array(last, pa.int64(), mask=~some),
                    pa.array([sorted(labels.get(i, ())) for i in range(n)], pa.list_(pa.string())),
                    _lists(place[left], owner[left], n, pa.int64()), _lists(pair, owner[left], n, pa.int32()),
                ], names=["row", "id", "n_words", "n_base", "first_word", "last_word", "base", "place", "pair"])
    return run


def mark(docs: DataFrame, pairs: list[tuple[str, str]], phrases=PHRASES, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: ``row`` (a number of its own), ``id``, ``n_words``, ``n_base``,
    ``first_word``, ``last_word``, ``base`` (labels), and the places of the given pairs as lists
    ``place`` (of the first word) and ``pair`` (its index). A null text is empty."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _marks(phrases, pairs),
        f"row bigint, id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base array<string>, place array<bigint>, pair array<int>",
    )


def pair_order(marked: DataFrame, n_pairs: int) -> list[int]:
    """Rank of every pair by its count in all documents, rarest first, ties by index. At most
    TEMPLATE_PAIRS counts come to the driver."""
    counts = marked.select(F.explode("pair").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    found = {r["pair"]: r["n"] for r in counts.collect()}
    rank = [0] * n_pairs
    for i, pair in enumerate(sorted(range(n_pairs), key=lambda p: (found.get(p, 0), p))):
        rank[pair] = i
    return rank


def need_of(size: int, threshold: int) -> int:
    """Least overlap with a template of that size."""
    return max(1, -(-threshold * size // 100))


def template_hits(spark: SparkSession, marked: DataFrame, templates, pairs, threshold: int = THRESHOLD) -> DataFrame:
    """(row, first_word, template, label, overlap, size): every block that contains a template
    to the threshold, ``first_word`` being the number of its first word."""
    index = {pair: i for i, pair in enumerate(pairs)}
    rank = pair_order(marked, len(pairs))
    ranks = spark.createDataFrame(list(enumerate(rank)), "pair int, rank int")
    prefixes = []
    for number, (label, own) in enumerate(templates):
        order = sorted(rank[index[p]] for p in own)
        need = need_of(len(order), threshold)
        prefixes += [(r, i, number, label, need, order) for i, r in enumerate(order[: len(order) - need + 1])]
    prefixes = spark.createDataFrame(
        prefixes, "rank int, t_at int, template int, label string, need int, t_ranks array<int>")
    least = min(need_of(len(own), threshold) for _, own in templates)

    places = marked.select("row", F.explode(F.arrays_zip("place", "pair")).alias("x")).select("row", "x.place", "x.pair")
    ranked = places.join(F.broadcast(ranks), "pair")
    step = F.expr(f"place div {STEP}")
    # A pair lies in the window that begins before it and, but for the last place, in the one before.
    before = F.when((step > 0) & (F.col("place") % STEP < BLOCK - STEP - 1), step - 1)
    blocks = ranked.select("row", "rank", F.explode(F.array_compact(F.array(step, before))).alias("block"))
    blocks = blocks.groupBy("row", "block").agg(F.sort_array(F.collect_set("rank")).alias("ranks"))
    blocks = blocks.withColumn("n", F.size("ranks")).where(F.col("n") >= least)
    heads = blocks.select(
        "row", "block", "ranks", "n", F.posexplode(F.slice("ranks", F.lit(1), F.col("n") - least + 1)).alias("at", "rank"))
    t_size = F.size("t_ranks")
    rest = F.least(F.col("n") - F.col("at"), t_size - F.col("t_at"))
    met = heads.join(F.broadcast(prefixes), "rank").where((F.col("n") >= F.col("need")) & (rest >= F.col("need")))
    met = met.withColumn("common", F.array_intersect("ranks", "t_ranks"))
    # Once per block and template: at the first pair they have in common.
    met = met.where((F.size("common") >= F.col("need")) & (F.element_at("common", 1) == F.col("rank")))
    return met.select(
        "row", (F.col("block") * STEP).alias("first_word"), "template", "label",
        F.size("common").alias("overlap"), t_size.alias("size"))


def scan(spark: SparkSession, docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: int = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_base`` (places of base phrases, overlapping
    ones too), ``first_word`` and ``last_word`` of those (null without any), ``base_labels``,
    ``labels`` (with those of the templates found; both distinct, sorted, joined by commas, empty
    without any) and ``score``: 1 with a base phrase, else the largest containment found, else 0.

    A null or empty text has no words. Rows with a null or repeated id are documents of their own;
    other columns are not read, whatever their names. No rows give no rows.
    """
    parts = template_pairs(templates)
    pairs = list(dict.fromkeys(p for _, own in parts for p in own))
    marked = stage(mark(docs, pairs, phrases, id_col, text_col), "license-marks")
    hits = template_hits(spark, marked.where(F.size("place") > 0), parts, pairs, threshold)
    hits = hits.groupBy("row").agg(
        F.collect_set("label").alias("found"), F.max(F.col("overlap") / F.col("size")).alias("best"))
    joined = marked.drop("place", "pair").join(hits, "row", "left")
    every = F.concat("base", F.coalesce("found", F.array().cast("array<string>")))
    return joined.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(every)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
