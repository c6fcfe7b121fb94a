"""K-means for several numbers of clusters in shared scans.

All open fits go through one pass over the sparse rows per round: a row costs its non-zero
entries times the centres, as squared distances are norm + norm of the centre - 2 * dot
product. Each task adds its rows up per centre and dimension; the sums are shuffled by range of
dimensions and added range by range, so the driver only gets sums of the size of the centres
(dimensions x centres x 8 bytes). A fit leaves the scans when a round gains no more than
``TOLERANCE`` of its cost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that the starting centres are chosen from.
SEED_ROWS = 512
TOLERANCE = 5e-4
#: Dimensions whose sums are added together, and entries that are multiplied together.
RANGE, ENTRIES = 4096, 1 << 16


def sparse_rows(df: DataFrame, features: str, keep: list[str] = ()) -> DataFrame:
    """(keep, idx, val, norm): the non-zero entries of a vector column and their squared length.
    Rows without a vector are left out."""
    rows = df.where(F.col(features).isNotNull()).select(*keep, F.unwrap_udt(features).alias("__v"))
    every = F.transform(F.col("__v.values"), lambda x, i: i)
    rows = rows.select(*keep, F.when(F.col("__v.type") == 0, F.col("__v.indices")).otherwise(every).alias("idx"),
                       F.col("__v.values").alias("val"))
    return rows.withColumn("norm", F.aggregate("val", F.lit(0.0), lambda a, x: a + x * x))


@dataclass
class Fit:
    """Centres of one k as (dimension, centre), and cost, sizes, sums (like the centres) and
    squared lengths of the rows nearest to each."""

    centres: np.ndarray
    cost: float = float("inf")
    sizes: np.ndarray | None = None
    sums: np.ndarray | None = None
    lengths: np.ndarray | None = None


def _blocks(idx: pa.Array, val: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows of about ENTRIES entries: first and last row, entries, and how many each row has."""
    ends = np.r_[0, np.cumsum(idx.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(np.int64)
    index, value = idx.flatten().to_numpy(), val.flatten().to_numpy()
    at = 0
    while at < len(idx):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + ENTRIES, "right")) - 1)
        span = slice(ends[at], ends[stop])
        yield at, stop, index[span].astype(np.int64), value[span], np.diff(ends[at : stop + 1])
        at = stop


def _dots(index: np.ndarray, value: np.ndarray, counts: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Dot products (row, column) of sparse rows with the columns of a (dimension, column) matrix."""
    out = np.zeros((len(counts), columns.shape[1]))
    some = counts > 0
    if some.any():
        begins = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(columns[index] * value[:, None], begins, axis=0)
    return out


def _labels(dots: np.ndarray, norms: np.ndarray, spans: list[slice]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nearest centre, the first of equal ones, and what to add to the row's norm, for each k."""
    out = []
    for span in spans:
        apart = norms[span] - 2 * dots[:, span]
        label = apart.argmin(axis=1)
        out.append((label, apart[np.arange(len(label)), label]))
    return out


def _spans(fits: list[Fit]) -> list[slice]:
    ends = np.cumsum([f.centres.shape[1] for f in fits])
    return [slice(int(e) - f.centres.shape[1], int(e)) for e, f in zip(ends, fits)]


def _columns(fits: list[Fit]) -> tuple[np.ndarray, np.ndarray, list[slice]]:
    """All centres side by side, their norms, and the centres of each k."""
    columns = np.concatenate([f.centres for f in fits], axis=1)
    return columns, (columns * columns).sum(axis=0), _spans(fits)


# Codes are 32-bit and sums 64-bit numbers, as bytes: they cross between workers as they are.
SUMS = "range int, code binary, sum binary"


def _packed(number: int, code: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int32()), pa.array([code.astype("<i4").tobytes()]), pa.array([part.astype("<f8").tobytes()])],
        names=["range", "code", "sum"])


def _unpacked(rows) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for number, code, part in zip(rows["range"], rows["code"], rows["sum"]):
        yield number.as_py(), np.frombuffer(code.as_buffer(), "<i4"), np.frombuffer(part.as_buffer(), "<f8")


def _sums(now, before):
    """Per task, under the centres ``now``: in range -1 the size and squared lengths of each centre
    and the cost of each k; for each range of dimensions the sums (dimension x centre), or what
    they gain and lose against centres ``before``, a list of places of the fits among them."""
    def run(batches):
        columns, norms, spans = now.value
        width = columns.shape[1]
        # One number per dimension and centre, like the centres: it does not grow with the rows.
        facts, sums = np.zeros(2 * width + len(spans)), np.zeros(columns.size)
        if before:
            shared, places = before
            ends = np.cumsum([0] + [sp.stop - sp.start for sp in spans])
            old_columns = shared.value[0]
            if len(places) < len(shared.value[2]):
                old_columns = old_columns[:, np.concatenate([np.arange(shared.value[2][p].start, shared.value[2][p].stop) for p in places])]
            old_norms = np.concatenate([shared.value[1][shared.value[2][p]] for p in places])
            old_spans = [slice(int(a), int(b)) for a, b in zip(ends, ends[1:])]

        def add(index, value, counts, moved, place):
            entries = np.repeat(moved, counts)
            np.add.at(sums, index[entries] * width + np.repeat(place[moved], counts[moved]), value[entries])

        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for at, stop, index, value, counts in _blocks(batch.column(0), batch.column(1)):
                length = lengths[at:stop]
                found = _labels(_dots(index, value, counts, columns), norms, spans)
                old = _labels(_dots(index, value, counts, old_columns), old_norms, old_spans) if before else [None] * len(spans)
                for i, ((label, rest), was) in enumerate(zip(found, old)):
                    place = label + spans[i].start
                    facts[:width] += np.bincount(place, minlength=width)
                    facts[width : 2 * width] += np.bincount(place, weights=length, minlength=width)
                    facts[2 * width + i] += np.maximum(length + rest, 0).sum()
                    moved = np.ones(len(place), bool) if was is None else label != was[0]
                    add(index, value, counts, moved, place)
                    if was is not None:
                        add(index, -value, counts, moved, was[0] + spans[i].start)
        yield _packed(-1, np.flatnonzero(facts), facts[facts != 0])
        for number in range(-(-len(columns) // RANGE)):
            part = sums[number * RANGE * width : (number + 1) * RANGE * width]
            code = np.flatnonzero(part)
            if len(code):
                yield _packed(number, code, part[code])
    return run


def _added(cells: int):
    """Sums of each range that a task gets, one batch after the other."""
    def run(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, code, part in _unpacked(batch):
                found.setdefault(number, np.zeros(cells))[code] += part
        for number, part in found.items():
            code = np.flatnonzero(part)
            yield _packed(number, code, part[code])
    return run


def _scan(rows: DataFrame, fits: list[Fit], before=None):
    """One pass: cost, sizes, sums and lengths of all fits under their centres. With the shared
    centres of the pass before, under which their sums hold, only rows that changed place are
    added up. Returns the shared centres."""
    columns, norms, spans = _columns(fits)
    width = columns.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((columns, norms, spans))
    parts = rows.select("idx", "val", "norm").mapInArrow(_sums(shared, before), SUMS).repartition("range")
    added = parts.mapInArrow(_added(max(RANGE * width, 2 * width + len(spans))), SUMS).toArrow()
    sums, facts = np.concatenate([f.sums for f in fits], axis=1) if before else np.zeros_like(columns), np.zeros(2 * width + len(spans))
    for number, code, part in _unpacked(added):
        into = facts if number < 0 else sums[number * RANGE : (number + 1) * RANGE].reshape(-1)
        into[code] += part
    for i, (fit, span) in enumerate(zip(fits, spans)):
        fit.sums, fit.sizes = sums[:, span], facts[:width][span].astype(np.int64)
        fit.lengths, fit.cost = facts[width : 2 * width][span], float(facts[2 * width + i])
    return shared


def _seeds(rows: DataFrame, dims: int, k: int, seed: int) -> np.ndarray:
    """k starting centres by squared-distance sampling among SEED_ROWS rows taken by hash. They
    are a sequence: those of a smaller k are the first ones."""
    order = F.xxhash64("idx", "val", F.lit(seed))
    found = rows.select("idx", "val", "norm").orderBy(order).limit(SEED_ROWS).collect()
    sample = [(np.array(r["idx"], np.int64), np.array(r["val"], float), r["norm"]) for r in found]
    rng, centres = np.random.default_rng(seed), np.zeros((dims, k))
    if not sample:
        return centres
    apart = None
    for j in range(k):
        if apart is None or apart.sum() <= 0:
            pick = int(rng.integers(len(sample)))
        else:
            pick = int(rng.choice(len(sample), p=apart / apart.sum()))
        index, value, norm = sample[pick]
        centres[index, j] = value
        new = np.array([max(0.0, n + norm - 2 * float(centres[i, j] @ v)) for i, v, n in sample])
        apart = new if apart is None else np.minimum(apart, new)
    return centres


def kmeans(rows: DataFrame, ks, seed: int = 42, rounds: int = 20) -> dict[int, Fit]:
    """Fits for all ``ks`` over ``sparse_rows``, which should be staged. A fit's cost and sizes are
    those under its centres; a cluster that loses all its rows keeps its centre."""
    ks = sorted(set(ks))
    dims = (rows.agg(F.max(F.array_max("idx"))).first()[0] or 0) + 1
    seeds = _seeds(rows, dims, max(ks), seed)
    fits = {k: Fit(seeds[:, :k].copy()) for k in ks}
    open_, before = list(ks), None
    for left in range(rounds, 0, -1):
        costs, scanned = {k: fits[k].cost for k in open_}, open_
        now = _scan(rows, [fits[k] for k in open_], before)
        if before:
            before[0].destroy()
        open_ = [k for k in open_ if costs[k] - fits[k].cost > TOLERANCE * fits[k].cost]
        before = now, [scanned.index(k) for k in open_]
        if not open_ or left == 1:
            break
        for k in open_:
            fit = fits[k]
            fit.centres = np.where(fit.sizes > 0, fit.sums / np.maximum(fit.sizes, 1), fit.centres)
    now.destroy()
    return fits


def assign(rows: DataFrame, fit: Fit, out: str) -> DataFrame:
    """``sparse_rows`` with the number of the nearest centre instead of the entries."""
    columns, norms, spans = _columns([fit])
    shared = rows.sparkSession.sparkContext.broadcast((columns, norms, spans))

    @F.arrow_udf("int")
    def nearest(idx: pa.Array, val: pa.Array) -> pa.Array:
        columns, norms, spans = shared.value
        found = [
            _labels(_dots(index, value, counts, columns), norms, spans)[0][0]
            for _, _, index, value, counts in _blocks(idx, val)
        ]
        return pa.array(np.concatenate(found) if found else [], pa.int32())

    return rows.withColumn(out, nearest("idx", "val")).drop("idx", "val", "norm")


def silhouettes(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Mean silhouette (squared Euclidean) for each k in one pass: mean squared distances to a
    cluster follow from its size, sum and squared lengths. A row alone in its cluster counts 0."""
    ks = list(fits)
    columns, norms, spans = _columns([fits[k] for k in ks])
    sizes = np.concatenate([fits[k].sizes for k in ks]).astype(float)
    full = np.maximum(sizes, 1)
    means = np.concatenate([fits[k].sums for k in ks], axis=1) / full
    spread = np.concatenate([fits[k].lengths for k in ks]) / full
    shared = rows.sparkSession.sparkContext.broadcast((columns, norms, spans, means, spread, sizes))

    def run(batches):
        columns, norms, spans, means, spread, sizes = shared.value
        total, n = np.zeros(len(spans)), 0
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            for at, stop, index, value, counts in _blocks(batch.column(0), batch.column(1)):
                near = _labels(_dots(index, value, counts, columns), norms, spans)
                apart = lengths[at:stop, None] + spread - 2 * _dots(index, value, counts, means)
                for i, span in enumerate(spans):
                    own, size = near[i][0], sizes[span]
                    row = np.arange(stop - at)
                    d = np.maximum(apart[:, span], 0)
                    inside = d[row, own] * size[own] / np.maximum(size[own] - 1, 1)
                    d = np.where(size > 0, d, np.inf)
                    d[row, own] = np.inf
                    outside = d.min(axis=1)
                    most = np.maximum(inside, outside)
                    known = (size[own] > 1) & np.isfinite(outside) & (most > 0)
                    total[i] += np.where(known, (outside - inside) / np.where(known, most, 1), 0).sum()
                n += stop - at
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total], pa.list_(pa.float64()))], names=["n", "total"])

    found = rows.select("idx", "val", "norm").mapInArrow(run, "n bigint, total array<double>").agg(
        F.sum("n"), *[F.sum(F.col("total")[i]) for i in range(len(ks))]).first()
    shared.destroy()
    return {k: found[1 + i] / found[0] if found[0] else float("nan") for i, k in enumerate(ks)}
