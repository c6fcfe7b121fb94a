"""Counting and summarising: DataFrame -> DataFrame.

Every group-by here is an aggregate that combines rows before the shuffle, so a hot key
costs one row per task.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from voxlens.functions.arrays import each
from voxlens.functions.text import words
from voxlens.operators.lookup import keyword_hits
from voxlens.operators.ranking import is_numeric, top_per_group
from voxlens.session import stage


def _rows() -> Column:
    return F.count(F.lit(1))


def _long(one: DataFrame, names: list[str], fields: list[str], label: str = "column") -> DataFrame:
    """One wide row (``<field>__<i>``) to one row per name."""
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias(label), *[F.col(f"{f}__{i}").alias(f) for f in fields])
        for i, n in enumerate(names)
    ])))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(_rows().alias("n_rows"))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per column; a missing value counts as one value. Exact counts read
    each column on its own, so no row is multiplied by the number of columns."""
    if not approximate:
        each_column = [
            df.select(F.col(c)).distinct().agg(_rows().alias("n_distinct")).select(F.lit(c).alias("column"), "n_distinct")
            for c in df.columns
        ]
        return reduce(DataFrame.unionByName, each_column)
    one = df.agg(*[
        (F.approx_count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0)))
        .cast("long").alias(f"n_distinct__{i}")
        for i, c in enumerate(df.columns)
    ])
    return _long(one, df.columns, ["n_distinct"])


def _missing(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    one = df.agg(*[
        F.count(F.when(_missing(f), 1)).alias(f"n_missing__{i}") for i, f in enumerate(df.schema.fields)
    ])
    return _long(one, df.columns, ["n_missing"])


DESCRIBE_FIELDS = ["n", "mean", "stddev", "min_value", "max_value", "min_text", "max_text"]


def describe(df: DataFrame) -> DataFrame:
    """Count, mean, stddev, min and max of number and text columns, one row per column.
    Numbers and texts have their own min / max columns, so nothing is printed and re-read."""
    fields = [f for f in df.schema.fields if is_numeric(f) or isinstance(f.dataType, T.StringType)]
    aggs = []
    for i, f in enumerate(fields):
        c = F.col(f.name)
        num = c.cast("double") if is_numeric(f) else F.lit(None).cast("double")
        txt = F.lit(None).cast("string") if is_numeric(f) else c
        aggs += [
            F.count(c).alias(f"n__{i}"),
            F.avg(num).alias(f"mean__{i}"),
            F.stddev(num).alias(f"stddev__{i}"),
            F.min(num).alias(f"min_value__{i}"),
            F.max(num).alias(f"max_value__{i}"),
            F.min(txt).alias(f"min_text__{i}"),
            F.max(txt).alias(f"max_text__{i}"),
        ]
    return _long(df.agg(*aggs), [f.name for f in fields], DESCRIBE_FIELDS)


# Values between the ends of a bracket that are ranked in one task.
BRACKET = 10_000
# Items of a quantile sketch, and ranks by which a bracket is wider than asked: several times
# the sketch's error. A bracket that misses its quantile is asked for again, wider.
SKETCH, SLACK = 4096, 0.004


def quantiles_of(df: DataFrame, cols: dict[str, Column], ps=(0.0, 0.25, 0.5, 0.75, 1.0), sketch: int = SKETCH,
                 slack: float = SLACK) -> DataFrame:
    """Exact quantiles with linear interpolation of several columns: (column, p, value).

    The first scan gives count, ends and one mergeable sketch per column, which answers for all
    its quantiles. Each quantile of more than ``BRACKET`` values gets a bracket from it, the
    second scan counts the values below and in all brackets, and those in them are reduced to
    (value, count) and ranked in a third. Brackets that still hold too many values get a sketch of
    their own and are counted again; each round leaves about ``2 * slack`` of a bracket. Only two
    numbers per column and quantile come to the driver. Computed values are staged before.
    """
    names = list(cols)
    rows = df.select(*[cols[c].cast("double").alias(f"v{j}") for j, c in enumerate(names)])
    rows = rows.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in rows.columns])
    if not set(df.select(*cols.values()).columns) <= set(df.columns):
        rows = stage(rows, "quantile_values")

    def between(sketched: Column, count: Column, ranks: list[tuple[float, float]]) -> Column:
        flat = F.array(*[F.lit(min(1.0, max(0.0, r))) for pair in ranks for r in pair])
        return F.when(count > 0, F.kll_sketch_get_quantile_double(sketched, flat))

    asked = [(float(p) - slack, float(p) + slack) for p in ps]
    first = rows.agg(*[
        x for j in range(len(names)) for x in (
            F.count(f"v{j}"), F.min(f"v{j}"), F.max(f"v{j}"),
            between(F.kll_sketch_agg_double(f"v{j}", sketch), F.count(f"v{j}"), asked))
    ]).first()
    spots = []
    for j in range(len(names)):
        size, low, high, near = first[4 * j : 4 * j + 4]
        for i, p in enumerate(ps):
            if size:
                spots.append({"q": j * len(ps) + i, "j": j, "p": float(p), "spot": float(p) * (size - 1), "below": 0, "inside": size,
                              "low": low, "high": high, "slack": slack, "near": (near[2 * i], near[2 * i + 1])})

    def inside(s, low, high) -> Column:
        return F.when(F.col(f"v{s['j']}").between(low, high), F.col(f"v{s['j']}"))

    open_ = [s for s in spots if s["inside"] > BRACKET]
    while open_:
        counted = rows.agg(*[
            x for s in open_ for x in (
                F.count(F.when(F.col(f"v{s['j']}") < s["near"][0], 1)), F.count(inside(s, *s["near"])))
        ]).first()
        left = []
        for i, s in enumerate(open_):
            below, held = counted[2 * i], counted[2 * i + 1]
            if below <= floor(s["spot"]) and ceil(s["spot"]) < below + held:
                shrunk = held < s["inside"]
                s.update(low=s["near"][0], high=s["near"][1], below=below, inside=held)
                if shrunk and held > BRACKET:  # else the bracket is a few values that repeat
                    left.append(s)
            else:
                s["slack"] *= 4
                left.append(s)
        open_ = left
        if open_:
            near = rows.agg(*[
                between(F.kll_sketch_agg_double(inside(s, s["low"], s["high"]), sketch), F.lit(1), [(
                    (floor(s["spot"]) - s["below"]) / s["inside"] - s["slack"],
                    (ceil(s["spot"]) + 1 - s["below"]) / s["inside"] + s["slack"],
                )]) for s in open_
            ]).first()
            for s, ends in zip(open_, near):
                s["near"] = tuple(ends)
    if not spots:
        return df.sparkSession.createDataFrame([], "column string, p double, value double")
    near = [
        F.when(F.col(f"v{s['j']}").between(s["low"], s["high"]), F.struct(F.lit(s["q"]).alias("q"), F.col(f"v{s['j']}").alias("v")))
        for s in spots
    ]
    kept = rows.where(F.coalesce(*near).isNotNull())
    kept = kept.select(F.explode(F.array_compact(F.array(*near))).alias("x")).select("x.q", "x.v")
    counted = kept.groupBy("q", "v").agg(_rows().alias("c"))
    # One row per column and quantile.
    starts = df.sparkSession.createDataFrame(
        [(s["q"], names[s["j"]], s["p"], s["below"], s["spot"]) for s in spots],
        "q int, column string, p double, below bigint, spot double",
    )
    last = F.col("below") + F.sum("c").over(Window.partitionBy("q").orderBy("v"))
    ranked = counted.join(F.broadcast(starts), "q").withColumn("last", last)

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("last")) & (rank >= F.col("last") - F.col("c")), F.col("v")))

    part = F.col("spot") - F.floor("spot")
    picked = ranked.groupBy("column", "p", "spot").agg(at(F.floor("spot")).alias("lo"), at(F.ceil("spot")).alias("hi"))
    return picked.select("column", "p", (F.col("lo") + (F.col("hi") - F.col("lo")) * part).alias("value"))


def quantiles(df: DataFrame, col, ps=(0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """Exact quantiles of one column or expression: (p, value)."""
    value = F.col(col) if isinstance(col, str) else col
    return quantiles_of(df, {"value": value}, ps).drop("column")


def length_stats(df: DataFrame, col: str) -> DataFrame:
    """Text length: max, min, mean, population stddev, median and quartiles as
    (measure, value)."""
    size = F.length(col).cast("double")
    one = df.agg(
        F.max(size).alias("value__0"), F.min(size).alias("value__1"),
        F.avg(size).alias("value__2"), F.stddev_pop(size).alias("value__3"),
    )
    base = _long(one, ["max", "min", "mean", "stddev_pop"], ["value"], "measure")
    quarters = quantiles(df, size, (0.25, 0.5, 0.75)).select(
        F.when(F.col("p") == 0.25, "q1").when(F.col("p") == 0.5, "median").otherwise("q3").alias("measure"),
        "value",
    )
    return base.unionByName(quarters)


def count_by(df: DataFrame, keys: list) -> DataFrame:
    return df.groupBy(*keys).agg(_rows().alias("n"))


def count_by_day(df: DataFrame, ts: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("day")).agg(_rows().alias("n")).orderBy("day")


def count_by_month(df: DataFrame, ts: str) -> DataFrame:
    return (
        df.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month"))
        .agg(_rows().alias("n")).orderBy("year", "month")
    )


def date_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"day": F.to_date(ts), "year": F.year(ts), "month": F.month(ts)})


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias("mean"))


def score_summary(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias("max_score"), F.avg(col).alias("mean_score"))


def class_share(df: DataFrame, col: str) -> DataFrame:
    """Count and percent share of each class."""
    counts = count_by(df, [col])
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return count_by(df, [col]).orderBy(col)


def histogram(df: DataFrame, col, bins: int = 30) -> DataFrame:
    """Equal-width bins between min and max, the last one closed, empty bins kept; missing
    values and NaN are in none. A constant column gets the range value - 0.5 to value + 0.5."""
    value = (F.col(col) if isinstance(col, str) else col).cast("double")
    values = df.select(value.alias("v")).where("v is not null and not isnan(v)")
    flat = F.min("v") == F.max("v")
    bounds = values.agg(F.struct(
        F.when(flat, F.min("v") - 0.5).otherwise(F.min("v")).alias("lo"),
        F.when(flat, F.max("v") + 0.5).otherwise(F.max("v")).alias("hi"),
    )).scalar()
    step = (F.col("b.hi") - F.col("b.lo")) / bins
    place = F.least(F.floor((F.col("v") - F.col("b.lo")) / step), F.lit(bins - 1))
    counts = values.withColumn("b", bounds).groupBy(place.alias("bin")).agg(_rows().alias("n"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin").withColumn("b", bounds)
    return grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("b.lo") + F.col("bin") * step).alias("bin_from"),
        (F.col("b.lo") + (F.col("bin") + 1) * step).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def unique_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def overlap_count(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Number of keys the two tables have in common; keys are made distinct first."""
    common = a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")
    return common.agg(_rows().alias("n_common"))


def word_rows(df: DataFrame, col: str, keep: list[str] = ()) -> DataFrame:
    """One row per word; a text column is cut at white space, a token array is taken as is."""
    tokens = each(col) if isinstance(df.schema[col].dataType, T.ArrayType) else words(col)
    return df.select(*keep, F.explode(tokens).alias("word"))


def word_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Word frequency, most frequent first, ties by word."""
    counts = word_rows(df, col).groupBy("word").agg(_rows().alias("n")).orderBy(F.desc("n"), "word")
    return counts if n is None else counts.limit(n)


def word_counts_by(df: DataFrame, col: str, keys: list[str], n: int, exclude=()) -> DataFrame:
    """Top words per class without the excluded ones. Words are counted first, so the
    exclusion works on one row per class and word."""
    counts = word_rows(df, col, keys).groupBy(*keys, "word").agg(_rows().alias("n"))
    if isinstance(exclude, DataFrame):
        counts = counts.join(exclude.select(F.col(exclude.columns[0]).alias("word")), "word", "left_anti")
    elif exclude:
        counts = counts.where(~F.col("word").isin(list(exclude)))
    return top_per_group(counts.select(*keys, "word", "n"), keys, [F.desc("n"), F.asc("word")], n)


def keyword_frequency(df: DataFrame, dim: DataFrame, col: str, min_token_len: int = 2) -> DataFrame:
    """Hits of each dictionary keyword, of any number of words, over the corpus, zero kept."""
    wanted = dim.select(F.lit("").alias("topic"), F.lower("keyword").alias("keyword")).distinct()
    counts = keyword_hits(df, wanted, [], col, min_token_len).groupBy(F.col("keyword").alias("gram")).agg(_rows().alias("hits"))
    return dim.join(counts, F.lower(dim.keyword) == counts.gram, "left").select(
        "topic", "keyword", F.coalesce("hits", F.lit(0)).alias("n")
    )


def cloud_table(df: DataFrame, col: str, n: int) -> DataFrame:
    """Word weights relative to the most frequent word."""
    counts = word_counts(df, col, n)
    most = counts.agg(F.max("n")).scalar()
    return counts.withColumn("weight", F.col("n") / most)


def profile(df: DataFrame, ps=(0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """One report in long form: (column, measure, value, text)."""
    types = df.sparkSession.createDataFrame(
        [(f.name, "type", None, f.dataType.simpleString()) for f in df.schema.fields],
        "column string, measure string, value double, text string",
    )

    def measure(long: DataFrame, name: str, text: bool = False) -> DataFrame:
        return long.select(
            "column", F.lit(name).alias("measure"),
            F.lit(None).cast("double").alias("value") if text else F.col(name).cast("double").alias("value"),
            F.col(name).alias("text") if text else F.lit(None).cast("string").alias("text"),
        )

    summary = describe(df)
    number = [f.name for f in df.schema.fields if is_numeric(f)]
    pairs = summary.select("column", F.inline(F.array(*[
        F.struct(
            F.lit(m).alias("measure"),
            (F.lit(None) if m.endswith("_text") else F.col(m)).cast("double").alias("value"),
            (F.col(m) if m.endswith("_text") else F.lit(None)).cast("string").alias("text"),
        ) for m in DESCRIBE_FIELDS
    ]))).where("value is not null or text is not null")
    parts = [types, pairs, measure(distinct_counts(df), "n_distinct"), measure(null_counts(df), "n_missing")]
    if number:
        measured = quantiles_of(df, {c: F.col(c) for c in number}, ps)
        parts.append(measured.select(
            "column", F.concat(F.lit("p"), (F.col("p") * 100).cast("int")).alias("measure"),
            "value", F.lit(None).cast("string").alias("text"),
        ))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def answer_stability(df: DataFrame, key: str, run: str, items: str) -> DataFrame:
    """Share of the runs of an input in which each answer item occurs."""
    runs = df.groupBy(key).agg(F.count_distinct(run).alias("n_runs"))
    hits = (
        df.select(key, run, F.explode(each(items)).alias("item")).distinct()
        .groupBy(key, "item").agg(_rows().alias("n_hits"))
    )
    return hits.join(runs, key).select(
        key, "item", "n_hits", "n_runs", (F.col("n_hits") / F.col("n_runs")).alias("share")
    )
