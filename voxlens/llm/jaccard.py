"""N-gram Jaccard join by vertical partitioning.

The n-grams of all texts are cut into fragments of their global order. A fragment counts how
many texts hold each of its n-grams; n-grams of a single text cannot add to an overlap and
are only counted. What comes back per text is its list of shared n-grams, rarest first. A
text whose shared n-grams are too few for any link is done. The others are compared through
the rarest n-grams that a link must share: each text of such a bucket with the bucket's most
typical text, then, between what is not connected yet, with each other. Overlaps of a pair
are counted fragment by fragment and summed per pair.

Texts with the same set of n-grams are one class from the start, so copies are never paired.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxlens.llm.groups import components, join_salted, with_group
from voxlens.llm.shingles import byte_runs, shingle_hashes
from voxlens.session import stage

#: Ranges of n-gram hashes in each frequency band, for counting overlaps of pairs.
RANGES = 4


def _range_of(tokens: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of the hash order a token is in."""
    return ((tokens >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _cut(parts: int, width: int):
    """Texts into fragments: per run of texts and fragment one row with the texts' tokens, and
    what must be known of the texts at home in it."""
    def run(batches):
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            ids = batch.column(1)
            for at, data, bounds in byte_runs(batch.column(2)):
                hashes, owners = shingle_hashes(data, bounds, width)
                n = len(bounds) - 1
                order = np.argsort(owners, kind="stable")
                stops = np.searchsorted(owners[order], np.arange(n + 1))
                sets = [np.unique(hashes[order[a:b]]) for a, b in zip(stops, stops[1:])]
                sizes = np.array([len(s) for s in sets], np.int64)
                tokens = np.concatenate(sets) if n else np.zeros(0, np.uint64)
                owner = np.repeat(np.arange(n), sizes)
                place = _range_of(tokens, parts).astype(np.int32)
                home = rows[at : at + n] % parts
                sums = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                order = np.argsort(place, kind="stable")
                place, tokens, owner = place[order], tokens[order], owner[order]
                out = {k: [] for k in ("frag", "docs", "counts", "tokens", "rows", "ids", "ns", "sums")}
                for frag in np.union1d(place, home).tolist():
                    a, b = np.searchsorted(place, [frag, frag + 1])
                    docs, counts = np.unique(owner[a:b], return_counts=True)
                    mine = np.flatnonzero(home == frag)
                    for key, value in (
                        ("frag", frag), ("docs", rows[at + docs]), ("counts", counts.astype(np.int32)),
                        ("tokens", tokens[a:b].tobytes()), ("rows", rows[at + mine]),
                        ("ids", [ids[at + int(i)].as_py() for i in mine]), ("ns", sizes[mine]),
                        ("sums", [sums[i] for i in mine]),
                    ):
                        out[key].append(value)
                yield pa.RecordBatch.from_arrays([
                    pa.array(out["frag"], pa.int32()), pa.array(out["docs"], pa.list_(pa.int64())),
                    pa.array(out["counts"], pa.list_(pa.int32())), pa.array(out["tokens"], pa.binary()),
                    pa.array(out["rows"], pa.list_(pa.int64())), pa.array(out["ids"], pa.list_(ids.type)),
                    pa.array(out["ns"], pa.list_(pa.int64())), pa.array(out["sums"], pa.list_(pa.binary())),
                ], names=list(out))
    return run


def _flat(column) -> np.ndarray:
    """All elements of a chunked list column."""
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) and column.num_chunks else column
    return column.flatten()


def _count(parts: int):
    """One fragment: tokens of two and more texts, with the binary logarithm of the number
    of texts, go on to the part where their text is put together."""
    def run(table: pa.Table) -> pa.Table:
        docs = _flat(table.column("docs")).to_numpy()
        counts = _flat(table.column("counts")).to_numpy()
        tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint64)
        owner = np.repeat(docs, counts)
        order = np.argsort(tokens, kind="stable")
        fresh = np.r_[True, np.diff(tokens[order]) != 0] if len(tokens) else np.zeros(0, bool)
        group = np.cumsum(fresh) - 1
        held = np.bincount(group)[group] if len(tokens) else np.zeros(0, np.int64)
        shared = held >= 2
        tokens, owner = tokens[order][shared], owner[order][shared]
        band = np.log2(held[shared]).astype(np.uint8)
        rows = _flat(table.column("rows"))
        metas = [rows, _flat(table.column("ids")), _flat(table.column("ns")), _flat(table.column("sums"))]
        out = {k: [] for k in ("part", "owner", "tokens", "bands", "rows", "ids", "ns", "sums")}
        to, meta_to = owner % parts, rows.to_numpy() % parts
        order = np.argsort(to, kind="stable")
        to, tokens, owner, band = to[order], tokens[order], owner[order], band[order]
        for part in np.union1d(to, meta_to).tolist():
            a, b = np.searchsorted(to, [part, part + 1])
            mine = pa.array(np.flatnonzero(meta_to == part))
            values = [part, owner[a:b], tokens[a:b].tobytes(), band[a:b].tobytes(), *(m.take(mine) for m in metas)]
            for key, value in zip(out, values):
                out[key].append(value)
        lists = {"rows": pa.int64(), "ids": metas[1].type, "ns": pa.int64(), "sums": pa.binary()}
        return pa.table({
            "part": pa.array(out["part"], pa.int32()), "owner": pa.array(out["owner"], pa.list_(pa.int64())),
            "tokens": pa.array(out["tokens"], pa.binary()), "bands": pa.array(out["bands"], pa.binary()),
            **{k: pa.array([v.to_pylist() for v in out[k]], pa.list_(t)) for k, t in lists.items()},
        })
    return run


def _gather(num: int, den: int):
    """One part of the texts: row, id, n, sum and, where enough tokens are shared for a link,
    the shared tokens, rarest first, with their bands."""
    def run(table: pa.Table) -> pa.Table:
        rows, ids = _flat(table.column("rows")).to_numpy(), _flat(table.column("ids"))
        ns, sums = _flat(table.column("ns")).to_numpy(), _flat(table.column("sums"))
        owner = _flat(table.column("owner")).to_numpy()
        tokens = np.frombuffer(b"".join(table.column("tokens").to_pylist()), np.uint64)
        bands = np.frombuffer(b"".join(table.column("bands").to_pylist()), np.uint8)
        order = np.lexsort((tokens, bands, owner))
        owner, tokens, bands = owner[order], tokens[order], bands[order]
        a, b = np.searchsorted(owner, rows), np.searchsorted(owner, rows, "right")
        alive = (ns > 0) & (den * (b - a) >= num * ns)
        lists = [tokens[i:j].view(np.int64) if live else None for i, j, live in zip(a, b, alive)]
        marks = [bands[i:j].astype(np.int8) if live else None for i, j, live in zip(a, b, alive)]
        return pa.table({
            "row": pa.array(rows, pa.int64()), "id": ids, "n": pa.array(ns, pa.int64()), "sum": sums,
            "tokens": pa.array(lists, pa.list_(pa.int64())), "bands": pa.array(marks, pa.list_(pa.int8())),
        })
    return run


def shingle_sets(docs: DataFrame, width: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """Per row of ``docs``: ``row`` (a number of its own), ``id``, ``n``, ``sum`` (128-bit hash
    of the set) and, for texts that may have links, ``tokens`` and ``bands`` of the n-grams that
    other texts hold too, in the global order (band, hash)."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_col].dataType.simpleString()
    metas = f"rows array<bigint>, ids array<{kind}>, ns array<bigint>, sums array<binary>"
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col), F.col(text_col).cast("string"))
    cut = rows.mapInArrow(
        _cut(parts, width), f"frag int, docs array<bigint>, counts array<int>, tokens binary, {metas}"
    )
    counted = cut.groupBy("frag").applyInArrow(
        _count(parts), f"part int, owner array<bigint>, tokens binary, bands binary, {metas}"
    )
    return counted.groupBy("part").applyInArrow(
        _gather(num, den), f"row bigint, id {kind}, n bigint, sum binary, tokens array<bigint>, bands array<tinyint>"
    )


def _segments(alive: DataFrame) -> DataFrame:
    """(row, fragment, tokens): runs of the global order, cut by band and by range of the hash."""
    each = F.explode(F.arrays_zip("bands", "tokens")).alias("t")
    rows = alive.select("row", each).select(
        "row", (F.col("t.bands").cast("int") * RANGES + F.pmod(F.shiftright("t.tokens", 62), F.lit(RANGES))).alias("fragment"),
        F.col("t.tokens").alias("token"),
    )
    return rows.groupBy("row", "fragment").agg(F.collect_list("token").alias("tokens"))


def _links(pairs: DataFrame, segments: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b, na, nb) whose overlap is enough: counted per fragment, summed per pair."""
    left = pairs.join(segments.select(F.col("row").alias("b"), "fragment", F.col("tokens").alias("of_b")), "b")
    right = segments.select(F.col("row").alias("a"), "fragment", F.col("tokens").alias("of_a"))
    met = join_salted(left, right, ["a", "fragment"], F.col("b"))
    partial = met.select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).alias("part"))
    total = partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("common"))
    return total.where((num + den) * F.col("common") >= num * (F.col("na") + F.col("nb"))).select("a", "b")


def _may_link(na, pa_, nb, pb, num: int, den: int):
    """Whether texts of na and nb n-grams that have a first one in common at these positions
    of their order can overlap enough."""
    return (num + den) * F.least(na - pa_, nb - pb) >= num * (na + nb)


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """One row per input row: the id, ``n_shingles`` and ``component_id``.

    Words are runs of bytes other than ASCII white space, A-Z lower-cased. A text's set is
    its distinct runs of ``width`` words; with fewer words, all of them as one; a null, empty
    or blank text has an empty set and no links. Texts are linked when den * |intersection|
    >= num * |union|; ``component_id`` is the smallest id reachable by links, its own included.
    Equality is that of 64-bit hashes of n-grams and 128-bit hashes of sets. Repeated rows
    and rows with a null id take part like any other; a component without any id has a null
    one. Other columns are not read. No rows give no rows.
    """
    sets = stage(shingle_sets(docs, width, num, den, id_col, text_col), "jaccard-sets")
    classed = with_group(sets.select("row", "id", "n", "sum").where("n > 0"), ["sum", "n"], F.col("row"), F.col("row"))
    classed = stage(classed.select("row", "id", "n", F.col("__first").alias("class")), "jaccard-classes")
    heads = classed.where("row = class").select("row")
    alive = stage(sets.where("tokens is not null").select("row", "n", "tokens", "bands").join(heads, "row", "left_semi"),
                  "jaccard-alive")
    segments = stage(_segments(alive), "jaccard-segments")

    alone = F.col("n") - F.size("tokens")
    need = F.floor((num * F.col("n") + den - 1) / den).cast("bigint")
    head = F.slice("tokens", F.lit(1), F.greatest(F.lit(0), F.col("n") - need + 1 - alone).cast("int"))
    prefix = alive.select("row", "n", alone.alias("alone"), F.posexplode(head).alias("at", "token"))
    prefix = stage(prefix.select("row", "n", "token", (F.col("alone") + F.col("at")).alias("pos")), "jaccard-prefix")

    typical = F.struct(F.col("pos").alias("p"), F.col("n").alias("m"), F.col("row").alias("r"))
    star = with_group(prefix, ["token"], typical, F.col("row")).where("row <> __first.r")
    star = star.where(_may_link(F.col("n"), F.col("pos"), F.col("__first.m"), F.col("__first.p"), num, den)).select(
        F.col("__first.r").alias("a"), F.col("row").alias("b"), F.col("__first.m").alias("na"), F.col("n").alias("nb")
    ).distinct()
    linked = stage(components(_links(star, segments, num, den)), "jaccard-star")

    placed = prefix.join(linked.withColumnRenamed("node", "row"), "row", "left").withColumn(
        "component", F.coalesce("component", "row"))
    open_ = placed.groupBy("token").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min("n").alias("least"), F.max("n").alias("most"),
    ).where("low <> high").select("token", "least", "most")
    # The size in the bucket that suits a text best is the one closest to what it has left.
    best = F.greatest("least", F.least(F.col("n") - F.col("pos"), F.col("most")))
    rest = join_salted(placed, open_, ["token"], F.col("row")).where(
        _may_link(F.col("n"), F.col("pos"), best, F.lit(0), num, den)
    )
    rest = stage(rest.select("token", "row", "n", "pos", "component"), "jaccard-open")
    x, y = rest.alias("x"), rest.alias("y")
    cross = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.component") < F.col("y.component"))
                   & _may_link(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), num, den))
    cross = cross.select(F.col("x.row").alias("a"), F.col("y.row").alias("b"), F.col("x.n").alias("na"),
                         F.col("y.n").alias("nb")).distinct()
    links = linked.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(
        _links(cross, segments, num, den))
    found = stage(components(links), "jaccard-components")

    classes = classed.groupBy("class").agg(F.min("id").alias("least"))
    classes = classes.join(found.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class"))
    least = with_group(classes, ["component"], F.col("least"), F.col("class")).select(
        "class", F.col("__first").alias("component_id"))
    done = join_salted(classed, least, ["class"], F.col("row")).select("id", "n", "component_id")
    empty = sets.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return done.unionByName(empty).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id"
    )


def drop_near_copies(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose id is the smallest of its component
    (``jaccard_components``). Rows that share an id stay or go together; rows without an id
    stay."""
    found = jaccard_components(docs, width, num, den, id_col, text_col)
    gone = found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct()
    gone = stage(gone, "jaccard-gone")
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
