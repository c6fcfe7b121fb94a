"""Topic factors of sparse (key, term, value) tables: non-negative factors and LDA.

Both fit documents x topics and terms x topics tables. The entries are packed once into blocks of
whole documents, up to about ENTRIES entries each, and stay where they are (buckets by block); the terms
are dealt by hash over parts. In a round each part sends every block the factors of the block's terms,
the factors of the block's documents are solved there, and the sums per term go back. What a part and a
block send each other is one row of bytes, in an order both know, so no round moves, sorts or joins a row per
term. A term of nearly all documents is one number per block and topic, not per document, and no task
or driver holds the vocabulary: the driver sees k x k numbers, a task one block and the factors of
its terms, or the terms of one part and what blocks send about them.

Document factors are the optimum of a convex problem for given term factors, solved in each block in each
round. A round is staged, which cuts the lineage; a block that is computed again gives the same sums.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, LongType, StringType, StructField, StructType

from voxlens.session import discard, fresh_path, stage

#: Entries of a block on average, and of blocks that are made smaller to keep all tasks busy. A document
#: lies in one block whatever its length.
ENTRIES, FEWEST = 1 << 20, 1 << 17
#: Blocks per part of the terms, at most; small tables have as many parts as blocks, large ones as many as tasks at least.
SHARED = 8
#: Bits of a term's number that are its place in its part.
PLACE = 32
#: Steps of the solution within a block, and the change at which it ends.
STEPS, SETTLED = 100, 1e-6
#: Entries that are solved together, and the change at which a document's shares are settled.
RUN, STILL = 1 << 16, 1e-7


class Factors:
    """``documents`` (key, w0, w1, ...), ``terms`` (term, h0, h1, ...) and the objective after
    each round: ``errors`` (squared, falling) of ``nmf``, ``bounds`` (log posterior, rising) of ``lda``."""

    def __init__(self, documents: DataFrame, terms: DataFrame, scores: list[float]):
        self.documents, self.terms, self.scores = documents, terms, scores

    @property
    def errors(self) -> list[float]:
        return self.scores

    @property
    def bounds(self) -> list[float]:
        return self.scores


def _names(prefix: str, k: int) -> list[str]:
    return [f"{prefix}{i}" for i in range(k)]


def _start(topic: int, seed: int) -> Column:
    """A stable positive start value for each of the terms and a topic."""
    return F.transform("terms", lambda term: (F.pmod(F.xxhash64(term, F.lit(seed * 1000 + topic)), F.lit(1000)) + 1) / 1000.0)


def _one(values) -> pa.Array:
    """A list of all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _bytes(values: np.ndarray) -> pa.Array:
    return pa.array([values.tobytes()], pa.binary())


def _slices(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The bytes of the rows of ``values``, cut at ``ends``."""
    offsets = (ends * values.shape[1] * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _joined(rows: pa.Table, by: str, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers in ``by`` ascending, where the rows of each one's data end, and these rows of k numbers."""
    at = rows[by].to_numpy()
    order = np.argsort(at)
    data = rows["data"].combine_chunks().take(pa.array(order))
    lengths = pc.binary_length(data).to_numpy() // (8 * k)
    return at[order], np.append(0, np.cumsum(lengths)), np.frombuffer(data.buffers()[2], np.float64, int(lengths.sum()) * k).reshape(-1, k)


def _numbers(row: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(row[name][0].as_buffer(), kind)


def _pack(parts: int) -> Callable[[pa.Table], pa.Table]:
    """One row of a block: its documents, how many entries each has, its terms by part, and the places and
    values of its entries, document by document."""

    def pack(entries: pa.Table) -> pa.Table:
        docs = entries["key"].combine_chunks().dictionary_encode(null_encoding="encode")
        terms = entries["term"].combine_chunks().dictionary_encode()
        part = (pd.util.hash_array(terms.dictionary.to_numpy(zero_copy_only=False), categorize=False) % np.uint64(parts)).astype(np.int64)
        sorted_ = np.argsort(part, kind="stable")
        place = np.empty(len(part), np.int32)
        place[sorted_] = np.arange(len(part), dtype=np.int32)
        ends = pa.array(np.append(0, np.cumsum(np.bincount(part, minlength=parts))), pa.int32())
        doc = docs.indices.to_numpy()
        order = np.argsort(doc, kind="stable")
        return pa.table({
            "block": entries["block"].slice(0, 1), "docs": _one(docs.dictionary),
            "terms": _one(pa.ListArray.from_arrays(ends, terms.dictionary.take(pa.array(sorted_)))),
            "n": _bytes(np.bincount(doc, minlength=len(docs.dictionary))), "t": _bytes(place[terms.indices.to_numpy()[order]]),
            "v": _bytes(entries["value"].to_numpy()[order]),
        })

    return pack


def _index(rows: pa.Table) -> pa.Table:
    """One row of a part: its terms, each once, and where those of each block stand among them."""
    rows = rows.sort_by("block")
    words = rows["words"].combine_chunks()
    terms = words.flatten().dictionary_encode()
    return pa.table({
        "part": rows["part"].slice(0, 1), "terms": _one(terms.dictionary), "blocks": _bytes(rows["block"].to_numpy()),
        "ends": _bytes(np.append(0, np.cumsum(pc.list_value_length(words).to_numpy())).astype(np.int64)),
        "places": _bytes(terms.indices.to_numpy().astype(np.int32)),
    })


@contextmanager
def _packed(df: DataFrame, key: str, value: str) -> Iterator[tuple[DataFrame, DataFrame, DataFrame]]:
    """The blocks, in buckets by block, and the parts of the terms, in buckets by part: a round moves
    neither; and (word, term), the number of each term: its part and place in it. All are removed at the end, also after a failure."""
    spark, made = df.sparkSession, []
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def bucketed(rows: DataFrame, by: str, n: int) -> DataFrame:
        name = f"topic_{by}_{uuid.uuid4().hex}"
        made.append(name)
        buckets = min(tasks, n)
        rows.repartition(buckets, by).write.bucketBy(buckets, by).option("path", fresh_path(spark, name)).saveAsTable(name)
        return spark.table(name)

    try:
        entries = stage(df.select(
            F.col(key).alias("key"), "term", F.col(value).cast("double").alias("value")
        ).where("term is not null and value is not null and value <> 0"), "topic_entries")
        n = entries.count()
        count = max(1, math.ceil(n / ENTRIES), min(tasks, math.ceil(n / FEWEST)))
        parts = max(min(tasks, count), math.ceil(count / SHARED))
        dealt = entries.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(count)))
        schema = StructType([
            StructField("block", LongType()), StructField("docs", ArrayType(entries.schema["key"].dataType)),
            StructField("terms", ArrayType(ArrayType(StringType()))), *[StructField(c, BinaryType()) for c in ("n", "t", "v")],
        ])
        blocks = bucketed(dealt.groupBy("block").applyInArrow(_pack(parts), schema), "block", count)
        discard(entries)
        held = blocks.select("block", F.posexplode("terms").alias("part", "words")).where(F.size("words") > 0)
        schema = "part int, terms array<string>, blocks binary, ends binary, places binary"
        needs = bucketed(held.groupBy("part").applyInArrow(_index, schema), "part", parts)
        words = needs.select("part", F.posexplode("terms").alias("at", "term"))
        yield blocks, needs, words.select((F.shiftleft(F.col("part").cast("long"), PLACE) + F.col("at")).alias("word"), "term")
    finally:
        for name in made:
            if spark.catalog.tableExists(name):
                table = spark.table(name)
                spark.sql(f"DROP TABLE {name}")
                discard(table)


#: Rows that blocks and parts send each other: the numbers of a block's terms of one part. What a part keeps has
#: block -1, what a block keeps (the factors of its documents) part -1; there ``whole`` is what is added up over all.
ROWS = "block bigint, part int, data binary, whole array<double>"


def _rows(block, part, values: np.ndarray, ends: np.ndarray, whole: np.ndarray) -> pa.Table:
    """The first row is what is kept; ``block`` or ``part`` is one number for all."""
    n = len(ends) - 1
    return pa.table({
        "block": pa.array(np.broadcast_to(block, n).astype(np.int64)), "part": pa.array(np.broadcast_to(part, n).astype(np.int32)),
        "data": _slices(values, ends), "whole": pa.array([np.ravel(whole).tolist()] + [None] * (n - 1), pa.list_(pa.float64())),
    })


#: Of the documents, terms and values of entries, document by document, the factors of terms and, if given, those of
#: documents before: factors of documents, sums per term, and what is added up over all documents.
Solve = Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]]
#: Of sums per term and the factors before: new factors, and what is added up over all terms.
Update = Callable[[np.ndarray, np.ndarray | None], tuple[np.ndarray, np.ndarray]]


def _solved(blocks: DataFrame, tops: DataFrame, k: int, solve: Solve, scale: np.ndarray, before: DataFrame | None = None) -> DataFrame:
    """From the factors of the terms, divided by ``scale``: the factors of a block's documents and its sums
    per term. ``before`` holds the documents of the round before."""

    def run(mail: pa.Table, block: pa.Table) -> pa.Table:
        part, ends, values = _joined(mail, "part", k)
        kept = int(ends[1]) if part[0] < 0 else 0
        if part[0] < 0:
            part, ends = part[1:], ends[1:] - kept
        counts = _numbers(block, "n", np.int64)
        w, sums, whole = solve(np.repeat(np.arange(len(counts)), counts), _numbers(block, "t", np.int32),
                               _numbers(block, "v", np.float64), values[kept:] / scale, values[:kept] if kept else None)
        return _rows(block["block"][0].as_py(), np.append(-1, part), np.concatenate([w, sums]), np.append(0, ends + len(w)), whole)

    mail = tops.where("block >= 0").select("block", "part", "data")
    if before is not None:
        mail = mail.union(before.where("part < 0").select("block", "part", "data"))
    return stage(mail.groupBy("block").cogroup(blocks.select("block", "n", "t", "v").groupBy("block")).applyInArrow(run, ROWS), "topic_sums")


def _sent(part: pa.Table, h: np.ndarray, whole: np.ndarray) -> pa.Table:
    """The factors of a part's terms, and those that each block needs."""
    blocks, ends, places = (_numbers(part, c, kind) for c, kind in (("blocks", np.int64), ("ends", np.int64), ("places", np.int32)))
    return _rows(np.append(-1, blocks), part["part"][0].as_py(), np.concatenate([h, h[places]]), np.append(0, ends + len(h)), whole)


def _updated(parts: DataFrame, sums: DataFrame, k: int, update: Update, before: DataFrame | None = None) -> DataFrame:
    """New factors of the terms from the sums of all blocks and, if given, the factors before."""

    def run(mail: pa.Table, part: pa.Table) -> pa.Table:
        block, ends, values = _joined(mail, "block", k)
        kept = int(ends[1]) if block[0] < 0 else 0
        places = _numbers(part, "places", np.int32)
        found = np.column_stack([np.bincount(places, x) for x in values[kept:].T])
        return _sent(part, *update(found, values[:kept] if kept else None))

    mail = sums.where("part >= 0").select("block", "part", "data")
    if before is not None:
        mail = mail.union(before.where("block < 0").select("block", "part", "data"))
    held = parts.select("part", "blocks", "ends", "places")
    return stage(mail.groupBy("part").cogroup(held.groupBy("part")).applyInArrow(run, ROWS), "topic_factors")


def _started(parts: DataFrame, k: int, seed: int, update: Update) -> DataFrame:
    """The factors to start with."""
    names = _names("h", k)

    def run(part: pa.Table) -> pa.Table:
        return _sent(part, *update(np.column_stack([part[c].combine_chunks().values.to_numpy() for c in names]), None))

    starts = [_start(i, seed).alias(c) for i, c in enumerate(names)]
    return stage(parts.select("part", "blocks", "ends", "places", *starts).groupBy("part").applyInArrow(run, ROWS), "topic_factors")


def _sums(blocks: DataFrame, needs: DataFrame, tops: DataFrame, k: int, solve: Solve) -> DataFrame:
    """(word, at, s0, ...): one round in long form, from (word, h0, h1, ...). Rows without a word hold the sums over
    all documents, k of them in a row."""

    def pack(rows: pa.Table, part: pa.Table) -> pa.Table:
        h = np.empty((rows.num_rows, k))
        h[rows["word"].to_numpy() % (1 << PLACE)] = np.column_stack([rows[c].to_numpy() for c in _names("h", k)])
        return _sent(part, h, np.zeros(1))

    def unpack(kept: pa.Table) -> pa.Table:
        part, _, s = _joined(kept, "part", k)
        return pa.table({"word": (int(part[0]) << PLACE) + np.arange(len(s)), "at": np.zeros(len(s), np.int32)}
                        | {c: s[:, i] for i, c in enumerate(_names("s", k))})

    part = F.shiftright("word", PLACE).cast("int").alias("part")
    mail = tops.select(part, "word", *_names("h", k)).groupBy("part").cogroup(
        needs.select("part", "blocks", "ends", "places").groupBy("part")).applyInArrow(pack, ROWS)
    solved = _solved(blocks, mail, k, solve, np.ones(k))
    added = _updated(needs, solved, k, lambda s, _: (s, np.zeros(1)))
    schema = "word bigint, at int, " + ", ".join(f"{c} double" for c in _names("s", k))
    long = added.where("block < 0").select("part", "data").groupBy("part").applyInArrow(unpack, schema)
    whole = solved.select(F.posexplode("whole").alias("i", "x")).groupBy(F.floor(F.col("i") / k).cast("int").alias("at")).agg(
        *[F.sum(F.when(F.col("i") % k == i, F.col("x")).otherwise(0.0)).alias(c) for i, c in enumerate(_names("s", k))])
    return stage(long.union(whole.select(F.lit(None).cast("bigint").alias("word"), "at", *_names("s", k))), "topic_sums")


def _whole(rows: DataFrame, n: int) -> np.ndarray:
    """What is added up over all blocks or parts."""
    found = rows.where("whole is not null").select(F.posexplode("whole").alias("at", "x")).groupBy("at").agg(F.sum("x")).collect()
    out = np.zeros(n)
    for at, x in found:
        out[at] = x
    return out


def _named(held: DataFrame, by: str, names: str, rows: DataFrame, key: str, prefix: str, k: int, scale: np.ndarray) -> DataFrame:
    """(key, prefix0, prefix1, ...): the documents of blocks or the terms of parts, with the factors they keep."""

    def run(kept: pa.Table, place: pa.Table) -> pa.Table:
        x = _joined(kept, by, k)[2] / scale
        return pa.table({key: place[names].combine_chunks().values} | {f"{prefix}{i}": x[:, i] for i in range(k)})

    kind = held.schema[names].dataType.elementType
    schema = StructType([StructField(key, kind)] + [StructField(c, DoubleType()) for c in _names(prefix, k)])
    kept = rows.where("whole is not null").select(by, "data")
    return stage(kept.groupBy(by).cogroup(held.select(by, names).groupBy(by)).applyInArrow(run, schema), f"topic_{names}")


def _least_squares(gram: np.ndarray) -> Solve:
    """Non-negative least squares for every document by turns over the topics."""
    k = len(gram)

    def solve(d, t, v, h, before=None):
        counts = np.bincount(d)
        starts = np.cumsum(counts) - counts
        num = np.column_stack([np.add.reduceat(v * c[t], starts) for c in np.ascontiguousarray(h.T)])
        w = np.zeros((len(starts), k))
        for _ in range(STEPS):
            moved = 0.0
            for i in range(k):
                if gram[i, i] > 0:
                    new = np.maximum(0.0, w[:, i] + (num[:, i] - w @ gram[:, i]) / gram[i, i])
                    moved = max(moved, float(np.abs(new - w[:, i]).max(initial=0.0)))
                    w[:, i] = new
            if moved <= SETTLED * max(1.0, float(w.max(initial=0.0))):
                break
        inner = w.T @ w
        error = float(v @ v - 2 * (w * num).sum() + (inner * gram).sum())
        sums = np.column_stack([np.bincount(t, v * np.repeat(w[:, i], counts), len(h)) for i in range(k)])
        return w, sums, np.append(inner, error)

    return solve


def nmf(weights: DataFrame, key: str, k: int = 3, rounds: int = 20, seed: int = 42) -> Factors:
    """Non-negative factors of a sparse (key, term, weight) table with one row per pair: documents
    by least squares, terms by multiplicative updates, so the squared error falls.

    Rows without a term or weight are left out, a null key is a document like others,
    an empty table has empty factors.
    """
    with _packed(weights, key, "weight") as (blocks, parts, _):
        one, errors = np.ones(k), []
        tops = _started(parts, k, seed, lambda h, _: (h, h.T @ h))
        for last in range(rounds + 1):
            sums = _solved(blocks, tops, k, _least_squares(_whole(tops, k * k).reshape(k, k)), one)
            *inner, error = _whole(sums, k * k + 1)
            errors.append(float(error))
            if last == rounds:
                break
            inner = np.reshape(inner, (k, k))

            def update(s, h, inner=inner):
                new = h * s / (h @ inner + 1e-12)
                return new, new.T @ new

            held, tops = tops, _updated(parts, sums, k, update, tops)
            discard(held)
            discard(sums)
        found = Factors(_named(blocks, "block", "docs", sums, key, "w", k, one),
                        _named(parts, "part", "terms", tops, "term", "h", k, one), errors[1:])
        discard(tops)
        discard(sums)
        return found


def _runs(starts: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    """First and last document of runs of about RUN entries."""
    ends, at = np.append(starts, n), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + RUN, "right")) - 1)
        yield at, stop
        at = stop


def _shares(v: np.ndarray, held: list[np.ndarray], counts: np.ndarray, alpha: float, theta: np.ndarray) -> np.ndarray:
    """Topic shares (topic, document) by expectation and maximisation from ``theta``. A document leaves as soon
    as its shares are settled, so steps are only made for those that are not."""
    theta = theta.copy()
    own, now, length = np.arange(len(counts)), theta, np.add.reduceat(v, np.cumsum(counts) - counts) + len(held) * alpha
    for _ in range(STEPS):
        part = [np.repeat(x, counts) * c for x, c in zip(now, held)]
        rate = v / sum(part[1:], part[0])
        starts = np.cumsum(counts) - counts
        new = np.stack([(np.add.reduceat(p * rate, starts) + alpha) / length for p in part])
        open_ = np.abs(new - now).max(axis=0) > STILL
        theta[:, own], now = new, new
        if not open_.any():
            break
        if open_.mean() < 0.8:
            entries = np.repeat(open_, counts)
            v, held = v[entries], [c[entries] for c in held]
            own, now, counts, length = own[open_], now[:, open_], counts[open_], length[open_]
    return theta


def _mixtures(alpha: float) -> Solve:
    """Topic shares of every document, and what they add up to. For given term factors there is one optimum, so
    the shares of the round before only save steps."""

    def solve(d, t, v, h, before=None):
        counts = np.bincount(d)
        k, starts = h.shape[1], np.cumsum(counts) - counts
        theta = np.full((k, len(counts)), 1.0 / k) if before is None else np.ascontiguousarray(before.T)
        columns, share, whole = np.ascontiguousarray(h.T), np.empty((k, len(v))), np.zeros(k + 1)
        for at, stop in _runs(starts, len(v)):
            span = slice(starts[at], starts[at] + counts[at:stop].sum())
            value, held = v[span], [c[t[span]] for c in columns]
            found = _shares(value, held, counts[at:stop], alpha, theta[:, at:stop])
            part = [np.repeat(x, counts[at:stop]) * c for x, c in zip(found, held)]
            mixed = sum(part[1:], part[0])
            rate = value / mixed
            for i, p in enumerate(part):
                share[i, span] = p * rate
            whole[k] += value @ np.log(mixed) + alpha * np.log(found).sum()
            theta[:, at:stop] = found
        whole[:k] = share.sum(axis=1)
        return theta.T, np.column_stack([np.bincount(t, x, len(h)) for x in share]), whole

    return solve


def lda(counts: DataFrame, key: str, k: int = 3, rounds: int = 20, seed: int = 42, alpha: float = 0.1,
        eta: float = 0.01, value: str = "tf") -> Factors:
    """Latent Dirichlet allocation of (key, term, tf) with one row per pair: topic shares of
    documents (w) and word shares of topics (h) of the greatest posterior, priors being Dirichlet
    with 1 + ``alpha`` and 1 + ``eta``. ``bounds`` is the log posterior without its constant.

    Null terms, null and zero counts are left out, a null key is a document like others, an
    empty table has empty factors.
    """
    with _packed(counts, key, value) as (blocks, parts, _):
        solve, bounds, before = _mixtures(alpha), [], None

        def shared(prior: float) -> Update:
            """Sums with their prior, and of those per topic the number, sum and sum of logs."""
            return lambda s, _: (s + prior, np.concatenate([[len(s)], (s + prior).sum(axis=0), np.log(s + prior).sum(axis=0)]))

        tops = _started(parts, k, seed, shared(0.0))
        for last in range(rounds + 1):
            n, *of = _whole(tops, 2 * k + 1)
            scale = np.array(of[:k]) if n else np.ones(k)
            prior = eta * float(sum(of[k:]) - n * np.log(scale).sum())
            sums = _solved(blocks, tops, k, solve, scale, before)
            bounds.append(float(_whole(sums, k + 1)[k]) + prior)
            if before is not None:
                discard(before)
            if last == rounds:
                break
            held, tops, before = tops, _updated(parts, sums, k, shared(eta)), sums
            discard(held)
        found = Factors(_named(blocks, "block", "docs", sums, key, "w", k, np.ones(k)),
                        _named(parts, "part", "terms", tops, "term", "h", k, scale), bounds[1:])
        discard(tops)
        discard(sums)
        return found
