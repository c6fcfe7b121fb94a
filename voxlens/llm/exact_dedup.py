"""Exact deduplication by two-pass Bloom filtering, in DataFrame functions only.

Pass one counts, for the hash of every text, the cells of a blocked Bloom filter that it
falls into, and keeps the cells that at least two rows fell into as a bitmap per block. Pass
two tests every row against it: a row with a cell of its own cannot have a copy and passes
straight through; only the others, possibly repeated, are shuffled and compared by the full
SHA-256 of their text. A crowded filter lets more rows through to the shuffle and never
changes the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxlens.llm.groups import with_group
from voxlens.session import stage

#: Cells of the filter. The bitmaps that are broadcast never exceed FILTER_CELLS / 8 bytes
#: (16 MB), whatever the input.
FILTER_CELLS = 1 << 27
#: Bits of one bitmap of ``bitmap_construct_agg``, the block of the filter.
BLOCK_CELLS = 32768


def normalized(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space. The pattern leaves single
    spaces alone, they are their own replacement."""
    runs = r"(?:[\x09-\x0D]|\x20[\x20\x09-\x0D])[\x20\x09-\x0D]*"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def _cells(key: Column, cells: int) -> tuple[Column, tuple[Column, Column]]:
    """Block and the two cells inside it, which may be one, of a 64-bit key."""
    blocks = cells // BLOCK_CELLS
    block = F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).cast("int")
    mixed = F.xxhash64(key, F.lit("cells"))
    one = mixed.bitwiseAND(F.lit(BLOCK_CELLS - 1))
    two = F.shiftrightunsigned(mixed, 32).bitwiseAND(F.lit(BLOCK_CELLS - 1))
    return block, (one, two)


def repeated_filter(keys: DataFrame, key: Column, cells: int = FILTER_CELLS) -> DataFrame:
    """The filter: (block, bits), bits marking the cells that two or more rows fell into.
    At most ``cells / 8`` bytes in all."""
    block, places = _cells(key, cells)
    hits = keys.select(block.alias("__block"), F.explode(F.array_distinct(F.array(*places))).alias("__cell"))
    twice = hits.groupBy("__block", "__cell").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return twice.groupBy("__block").agg(F.bitmap_construct_agg("__cell").alias("__bits"))


def key_filter(keys: DataFrame, key: Column, cells: int = FILTER_CELLS) -> DataFrame:
    """A filter of the same form and bound that marks the cells of all given keys."""
    block, places = _cells(key, cells)
    hits = keys.select(block.alias("__block"), F.explode(F.array_distinct(F.array(*places))).alias("__cell"))
    return hits.groupBy("__block").agg(F.bitmap_construct_agg("__cell").alias("__bits"))


def _tested(df: DataFrame, key: Column, bits: DataFrame, cells: int) -> DataFrame:
    """``df`` with a flag ``__maybe``: whether the filter has all cells of the key."""
    block, places = _cells(key, cells)
    # Eight bytes as one number, made once a block: rows then take their bit without a text in between.
    numbers = F.transform(F.sequence(F.lit(0), F.lit(BLOCK_CELLS // 64 - 1)), lambda i: F.conv(
        F.hex(F.substring(F.col("__bits"), i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))
    tested = df.withColumn("__block", block).join(F.broadcast(bits.select("__block", numbers.alias("__bits"))), "__block", "left")

    def is_set(cell: Column) -> Column:
        eight = F.get("__bits", F.shiftright(cell, 6).cast("int"))
        bit = (cell.bitwiseAND(F.lit(63)).bitwiseXOR(F.lit(56))).cast("int")
        return F.coalesce(F.getbit(eight, bit), F.lit(0)) == 1

    flag = F.col("__bits").isNotNull() & is_set(places[0]) & is_set(places[1])
    return tested.withColumn("__maybe", flag).drop("__block", "__bits")


def maybe_repeated(df: DataFrame, key: Column, bits: DataFrame, cells: int = FILTER_CELLS) -> DataFrame:
    """``df`` with a flag ``__maybe``: false only where no other row has the same key."""
    return _tested(df, key, bits, cells)


def may_be_among(df: DataFrame, key: Column, bits: DataFrame, cells: int = FILTER_CELLS) -> DataFrame:
    """The rows of ``df`` whose key is among those of a ``key_filter``, and few others."""
    return _tested(df, key, bits, cells).where("__maybe").drop("__maybe")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 cells: int = FILTER_CELLS) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after white-space runs become one space; null is the empty
    text, and empty texts are equal to each other. Of equal texts the row with the smallest id
    stays; a null id comes last, and of rows that repeat an id any single one stays. Other
    columns are not read, whatever their names. No rows give no rows.
    """
    rows = docs.select(
        F.col(id_col).alias("__id"), F.unhex(F.sha2(normalized(F.col(text_col)), 256)).alias("__sha"),
        F.monotonically_increasing_id().alias("__row"),
    )
    rows = stage(rows, "exact-keys")
    tested = maybe_repeated(rows, F.col("__sha"), repeated_filter(rows, F.col("__sha"), cells), cells)
    alone = tested.where("not __maybe").select(
        "__id", F.col("__id").alias("__keep"), F.lit(1).cast("bigint").alias("__size"), F.lit(True).alias("__kept"),
        "__sha",
    )
    order = F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"), F.col("__row").alias("r"))
    grouped = with_group(tested.where("__maybe").drop("__maybe"), ["__sha"], order, F.col("__row"))
    shuffled = grouped.select(
        "__id", F.col("__first.i").alias("__keep"), "__size", (F.col("__row") == F.col("__first.r")).alias("__kept"),
        "__sha",
    )
    return alone.unionByName(shuffled).select(
        F.col("__id").alias(id_col), F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"),
        F.col("__kept").alias("kept"), F.lower(F.hex("__sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                cells: int = FILTER_CELLS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, under the rules of
    ``exact_groups``. Whole rows are shuffled only where the filter says possibly repeated,
    and copies are combined before they move."""
    sha = F.unhex(F.sha2(normalized(F.col(text_col)), 256))
    bits = stage(repeated_filter(docs.select(sha.alias("__sha")), F.col("__sha"), cells), "exact-filter")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(whole.alias("__whole"), sha.alias("__sha"), F.col(id_col).alias("__id"))
    tested = maybe_repeated(packed, F.col("__sha"), bits, cells)
    alone = tested.where("not __maybe").select("__whole")
    order = F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"))
    first = tested.where("__maybe").groupBy("__sha").agg(F.min_by("__whole", order).alias("__whole"))
    return alone.unionByName(first.select("__whole")).select("__whole.*")
