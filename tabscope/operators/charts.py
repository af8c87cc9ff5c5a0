"""The dataset behind each chart type, whole: no point is dropped or sampled."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import (
    col,
    dtype_of,
    is_present,
    present,
    ratio,
    require,
    require_numeric,
)
from tabscope.functions.order import running
from tabscope.functions.stats import counted_values, quantile_values, spread_join

BINS = 20
REPEATS = 10_000  # equal outliers written out at a time
QUARTILES = (0.25, 0.5, 0.75)


def _number(df: DataFrame, name: str) -> Column:
    require_numeric(df, name)
    return present(name, dtype_of(df, name)).cast("double")


def _has(df: DataFrame, *names: str) -> Column:
    """Condition that all these columns have a value."""
    return reduce(lambda a, b: a & b, [is_present(n, dtype_of(df, n)) for n in names])


def bar(df: DataFrame, x: str, y: str, group: str | None = None) -> DataFrame:
    """Bar heights.

    Ungrouped, every row is a bar at its category and bars overlap, so what shows per
    category is the extent of its values: ``label, top, bottom, n``. Grouped, the mean per
    (x, group): ``x, group, mean``.
    """
    require(df, x)
    v = _number(df, y)
    if group is None:
        return df.groupBy(col(x).cast("string").alias("label")).agg(
            F.max(v).alias("top"), F.min(v).alias("bottom"), F.count(v).alias("n")
        )
    require(df, group)
    return (
        df.where(_has(df, x, group))
        .groupBy(col(x).alias("x"), col(group).alias("group"))
        .agg(F.avg(v).alias("mean"))
    )


def bar_wide(df: DataFrame, x: str, y: str, group: str, groups: list) -> DataFrame:
    """The grouped bars with one column per listed group value."""
    long = bar(df, x, y, group).withColumnRenamed("x", x)
    return long.groupBy(col(x)).pivot("group", groups).agg(F.first("mean"))


def _points(df: DataFrame, x: str, y: str, group: str | None) -> DataFrame:
    require(df, x, y)
    columns = [col(x).alias("x"), col(y).alias("y")]
    if group is None:
        return df.select(*columns)
    return df.where(_has(df, group)).select(*columns, col(group).alias("group"))


def line(df: DataFrame, x: str, y: str, group: str | None = None) -> DataFrame:
    """All (x, y[, group]) points in x order."""
    points = _points(df, x, y, group)
    return points.orderBy(*[c for c in ("group", "x", "y") if c in points.columns])


def scatter(df: DataFrame, x: str, y: str, group: str | None = None) -> DataFrame:
    """All (x, y[, group]) points that have both coordinates."""
    return _points(df.where(_has(df, x, y)), x, y, group)


def _bin(v: Column, lo: Column, hi: Column) -> Column:
    """1-based equal-width bin; a value on an edge starts the next bin, the last is closed."""
    width = (hi - lo) / BINS
    guess = F.least(F.floor((v - lo) / (hi - lo) * BINS), F.lit(BINS - 1))
    fixed = (
        F.when(v < lo + guess * width, guess - 1)
        .when((v >= lo + (guess + 1) * width) & (guess < BINS - 1), guess + 1)
        .otherwise(guess)
    )
    return (fixed + 1).cast("int")


def _edges(values: DataFrame, *keys: str) -> DataFrame:
    """Lowest and highest edge; a constant column gets a range one unit wide."""
    flat = F.col("lo") == F.col("hi")
    return (
        values.groupBy(*keys)
        .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"))
        .where("lo is not null")
        .select(
            *keys,
            "n",
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )


def hist(df: DataFrame, y: str, group: str | None = None) -> DataFrame:
    """20 equal-width bins, empty ones included: ``[group,] bin, lo, hi, count``.

    Grouped, the range is each group's own. Rows shrink to one per (group, bin) before they
    are shuffled for counting.
    """
    v = _number(df, y)
    if group is None:
        values = df.where(_has(df, y)).select(v.alias("v"))
        edges = _edges(values)
        found = edges.first()  # one row at most
        lo, hi = (F.lit(found[c] if found else None).cast("double") for c in ("lo", "hi"))
        frame = df.sparkSession.range(1 if found else 0).select(lo.alias("lo"), hi.alias("hi"))
        counted = values.groupBy(_bin(F.col("v"), lo, hi).alias("bin")).count()
        keys = ["bin"]
    else:
        values = df.where(_has(df, group, y)).select(col(group).alias("group"), v.alias("v"))
        # equal values first, so that a frequent one is a single row wherever it is sent
        alike = counted_values(values, "v", ["group"])
        frame = _edges(alike, "group")
        counted = (
            spread_join(alike, frame, ["group"], ["v"], rows="n")
            .groupBy("group", _bin(F.col("v"), F.col("lo"), F.col("hi")).alias("bin"))
            .agg(F.sum("times").alias("count"))
        )
        keys = ["group", "bin"]
    frame = frame.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(BINS))))
    width = (F.col("hi") - F.col("lo")) / BINS
    return frame.join(counted, keys, "left").select(
        *keys,
        (F.col("lo") + (F.col("bin") - 1) * width).alias("lo"),
        F.when(F.col("bin") == BINS, F.col("hi")).otherwise(F.col("lo") + F.col("bin") * width).alias("hi"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def pie(df: DataFrame, x: str, y: str | None = None, group: str | None = None) -> DataFrame:
    """``label, value, share``; share is of the slices shown.

    Ungrouped, the ten most frequent values of x. Grouped, the sum of y per group.
    """
    if group is None:
        require(df, x)
        slices = (
            df.where(_has(df, x))
            .groupBy(col(x).alias("label"))
            .agg(F.count(F.lit(1)).alias("value"))
            .orderBy(F.desc("value"), "label")
            .limit(10)
        )
    else:
        require(df, group)
        v = _number(df, y)
        slices = (
            df.where(_has(df, group))
            .groupBy(col(group).alias("label"))
            .agg(F.coalesce(F.sum(v), F.lit(0.0)).alias("value"))
        )
    whole = slices.agg(F.sum("value")).scalar()
    return slices.select("label", "value", F.round(ratio(F.col("value"), whole) * 100, 4).alias("share"))


def _quartiles(ranked: DataFrame) -> DataFrame:
    """``label, n, q`` of ``label, v, times, upto``: the values whose ranks up to themselves hold those wanted."""
    sizes = ranked.groupBy("label").agg(F.sum("times").alias("n"))
    places = [F.lit(p) * (F.col("n") - 1) for p in QUARTILES]
    ranks = [side(place) + 1 for place in places for side in (F.floor, F.ceil)]
    at = [
        F.max(F.when((rank > F.col("upto") - F.col("times")) & (rank <= F.col("upto")), F.col("v"))).alias(f"r{i}")
        for i, rank in enumerate(ranks)
    ]
    found = spread_join(ranked, sizes, ["label"], ["v"], rows="n").groupBy("label").agg(F.first("n").alias("n"), *at)
    low, high = ([F.col(f"r{2 * i + j}") for i in range(len(places))] for j in (0, 1))
    return found.select(
        "label", "n", F.array(*[a + (b - a) * (x - F.floor(x)) for a, b, x in zip(low, high, places)]).alias("q")
    )


def _fenced(df: DataFrame, y: str, group: str | None) -> DataFrame:
    """Every value, and how many times it stands there, next to its group's quartiles and 1.5 IQR fences.

    Grouped, equal values are one row, so a frequent one of a hot group costs no more than any other, and
    the counted values are put in order once, in ranges, where running sums tell their ranks.
    """
    v = _number(df, y)
    if group is None:
        values = df.where(_has(df, y)).select(F.lit(y).alias("label"), v.alias("v"))
        quartiles = quantile_values(values, ["v"], QUARTILES)["v"]
        q = F.array(*[F.lit(x).cast("double") for x in quartiles])
        joined = values.select("label", "v", F.lit(1).cast("bigint").alias("times"), q.alias("q"))
    else:
        values = df.where(_has(df, group, y)).select(col(group).alias("label"), v.alias("v"))
        ranked = running(counted_values(values, "v", ["label"]), ["label"], ["v"], "times", "upto")
        joined = spread_join(ranked.drop("upto"), _quartiles(ranked), ["label"], ["v"], rows="n")
    q1, q3 = F.col("q")[0], F.col("q")[2]
    return joined.select(
        "label",
        "v",
        "times",
        q1.alias("q1"),
        F.col("q")[1].alias("median"),
        q3.alias("q3"),
        (q1 - 1.5 * (q3 - q1)).alias("lower"),
        (q3 + 1.5 * (q3 - q1)).alias("upper"),
    )


def box(df: DataFrame, y: str, group: str | None = None) -> DataFrame:
    """``label, n, q1, median, q3, whisker_lo, whisker_hi, n_fliers``.

    Whiskers end at the outermost values inside the fences, and never inside the box.
    """
    v = F.col("v")
    outside = (v < F.col("lower")) | (v > F.col("upper"))
    per_label = _fenced(df, y, group).groupBy("label").agg(
        F.sum("times").alias("n"),
        *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
        F.min(F.when(v >= F.col("lower"), v)).alias("inner_lo"),
        F.max(F.when(v <= F.col("upper"), v)).alias("inner_hi"),
        F.sum(F.when(outside, F.col("times")).otherwise(0)).alias("n_fliers"),
    )
    return per_label.select(
        "label",
        "n",
        "q1",
        "median",
        "q3",
        F.least("inner_lo", "q1").alias("whisker_lo"),
        F.greatest("inner_hi", "q3").alias("whisker_hi"),
        "n_fliers",
    )


def box_fliers(df: DataFrame, y: str, group: str | None = None) -> DataFrame:
    """``label, value``: the points drawn outside the whiskers, a row for each.

    Grouped, repeats of an outlier are written out in portions of REPEATS that are dealt to tasks.
    """
    found = _fenced(df, y, group).where("v < lower or v > upper").select("label", "v", "times")
    if group is not None:
        portions = F.explode(F.sequence(F.lit(0), F.col("times") - 1, F.lit(REPEATS)))
        found = found.select("label", "v", "times", portions.alias("at")).repartition("label", "v", "at")
        repeats = F.least(F.col("times") - F.col("at"), F.lit(REPEATS)).cast("int")
        found = found.select("label", F.explode(F.array_repeat("v", repeats)).alias("v"))
    return found.select("label", F.col("v").alias("value"))
