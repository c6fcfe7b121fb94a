"""Audit of how document filters interact: what each would remove in every order of them.

Every document has a mask of the filters it fails. Min-plus removal ranks: the matrix of masks
(0 where a filter fails, else beyond the last step) combined with the matrix of positions of
every filter in every order (the inverse permutations) by minimum gives the step at which a
mask goes in an order. Counts per part and mask are scattered by that step.

The table only meets hash aggregates and joins by key; a part reaches the matrices as one row of
at most ``2 ** filters`` counts, however many documents it has.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlens.session import stage

#: Orders grow as the factorial: seven filters have 5,040.
MAX_FILTERS = 7
#: Parts whose reports are made together.
PARTS = 64


def _any(conditions: dict[str, Column]) -> list[Column]:
    return [F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(conditions.values())]


def mask_of(conditions: dict[str, Column]) -> Column:
    """Bit i is set where condition i holds; null counts as not holding."""
    bits = _any(conditions)
    return sum(bits[1:], bits[0])


def text_failures(text: Column) -> tuple[dict[str, Column], dict[str, Column]]:
    """Facts of a text, and the failure conditions A to D in terms of their names.

    A: fewer than 50 words. B: fewer than 65 distinct words in 100. C: more than 5 letters A-Z
    in 100 code points. D: any of ``#$%&*|``. Words are runs without ASCII white space,
    case-sensitive; a null or empty text has none and fails A only.
    """
    whole = F.coalesce(text, F.lit(""))
    facts = {
        "__words": F.array_remove(F.split(whole, r"[\x20\x09-\x0D]+"), ""),
        "__capitals": F.length(F.regexp_replace(whole, "[^A-Z]+", "")),
        "__points": F.length(whole),
        "__marks": whole.rlike(r"[#$%&*|]"),
    }
    n, distinct = F.size("__words"), F.size(F.array_distinct("__words"))
    return facts, {
        "A": n < 50, "B": 100 * distinct < 65 * n, "C": 100 * F.col("__capitals") > 5 * F.col("__points"),
        "D": F.col("__marks"),
    }


def masked_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic) per row of ``docs``: bits 0 to 4 are the filters A to E.

    E: the text equals that of a row with a smaller id, anywhere in the table; null counts as
    empty. A row without id has no smaller one and is not a smaller one. Rows that repeat an id
    are documents of their own. ``good`` and ``toxic`` are 1 where any label row of the id says
    quality 1 or toxic 1. A null part is the empty string. Other columns are not read, whatever
    their names. No rows give no rows.
    """
    facts, failures = text_failures(F.col("__text"))
    rows = docs.select(
        F.col(id_col).alias("__id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).alias("__text"), F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("__sha"),
    )
    rows = rows.select("__id", "part", "__sha", *[c.alias(name) for name, c in facts.items()])
    rows = stage(rows.select("__id", "part", "__sha", mask_of(failures).alias("__mask")), "audit-masks")
    # Copies are combined before they move; a least row then meets only its own id.
    first = rows.where("__id is not null").groupBy("__sha").agg(F.min("__id").alias("__id"))
    found = rows.join(first.withColumn("__first", F.lit(True)), ["__sha", "__id"], "left")
    copy = F.col("__id").isNotNull() & F.col("__first").isNull()
    found = found.select("__id", "part", (F.col("__mask") + copy.cast("int") * 16).alias("mask"))
    known = labels.select(
        F.col("doc_id").alias("__id"), (F.col("quality") == 1).cast("int").alias("good"),
        (F.col("toxic") == 1).cast("int").alias("toxic"),
    ).where("__id is not null and (good = 1 or toxic = 1)")
    known = known.groupBy("__id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    return found.join(known, "__id", "left").select(
        "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")
    )


def removal_steps(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """All orders of the filters (a row each, in the order of ``permutations``), and the matrix
    (mask, order) of the step, from 0, at which a mask goes; ``filters`` where it stays."""
    if not 1 <= filters <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters")
    orders = np.array(list(permutations(range(filters))))
    position = np.argsort(orders, axis=1)
    fails = (np.arange(1 << filters)[:, None] >> np.arange(filters)) & 1
    cost = np.where(fails == 1, 0, filters)
    return orders, (cost[:, None, :] + position[None, :, :]).min(axis=2).clip(max=filters)


def _report(names: str, weights: list[str]):
    k = len(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        orders, steps = removal_steps(k)
        m = len(orders)
        fails = ((np.arange(1 << k)[:, None] >> np.arange(k)) & 1).astype(np.int64)
        labels = ["".join(names[f] for f in order) for order in orders]
        for batch in batches:
            for at in range(0, len(batch), PARTS):
                rows = batch.iloc[at : at + PARTS]
                counts = np.zeros((1 + len(weights), len(rows), 1 << k), np.int64)
                for i, cells in enumerate(rows["cells"]):
                    for cell in cells:
                        counts[:, i, cell["mask"]] = [cell["n"], *(cell[w] for w in weights)]
                gone = np.zeros((1 + len(weights), len(rows), m, k + 1), np.int64)
                for mask in range(1 << k):  # one step per order: no two sums meet in a cell
                    gone[:, :, np.arange(m), steps[mask]] += counts[:, :, mask, None]
                removed = gone[0, :, :, :k]
                total = counts[0].sum(axis=1)
                failing = (counts[0] @ fails)[:, orders]
                alone = counts[0][:, 1 << np.arange(k)][:, orders]
                shapley = np.stack([removed[:, orders == f].sum(axis=1) for f in range(k)], axis=1)[:, orders]
                shape = (len(rows), m, k)
                made = {
                    "part": np.repeat(rows["part"].to_numpy(object), m * k),
                    "filter_order": np.tile(np.repeat(np.array(labels, object), k), len(rows)),
                    "step": np.broadcast_to(np.arange(1, k + 1, dtype=np.int32), shape),
                    "kept": total[:, None, None] - removed.cumsum(axis=2),
                    "removed": removed, "redundant": failing - removed, "unique_fails": alone,
                    **{f"{w}_lost": gone[1 + i, :, :, :k] for i, w in enumerate(weights)},
                    "shapley": shapley,
                }
                yield pd.DataFrame({name: np.ascontiguousarray(v).reshape(-1) for name, v in made.items()})
    return run


def audit(masked: DataFrame, filters: str, weights: list[str]) -> DataFrame:
    """Per part, order of the filters (one letter each) and step from 1: ``kept`` after the step,
    ``removed`` by its filter, ``redundant`` (it fails, but went before), ``unique_fails`` (it
    alone fails), ``<weight>_lost`` (sum of a weight over the removed) and ``shapley`` (removed by
    that filter, summed over all orders).

    ``masked`` has (part, mask, weights), mask bit i for letter i. Every part has rows for all
    orders and steps, zeros included; no rows give no rows. All sums are whole numbers.
    """
    cells = masked.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(w).cast("bigint")).alias(w) for w in weights]
    )
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", *weights)).alias("cells"))
    lost = "".join(f"{w}_lost bigint, " for w in weights)
    return parts.mapInPandas(
        _report(filters, weights),
        "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
        f"unique_fails bigint, {lost}shapley bigint",
    )
