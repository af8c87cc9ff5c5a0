"""Exact statistics that stay distributed whatever the size or skew of the input."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.columns import as_text, col, dtype_of, present

SKETCH_ACCURACY = 10_000  # of the opt-in approximate quantiles
COARSE_PER_OCTAVE = 8
FINE_SLICES = 65_536
FINE_LEVELS = 4
SPREAD_OVER = 100_000  # rows of a group from which on it is spread
SPREAD_GROUPS = 10_000  # groups spread at most, the largest


def spread_join(
    facts: DataFrame,
    per_group: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "inner",
    rows: str | None = None,
) -> DataFrame:
    """Joins rows to their group's few figures without sending a hot group to one task.

    ``rows`` names the figure that tells how many facts a group has, or an upper bound of it; without
    it they are counted, which reads the facts once more. Groups with over ``SPREAD_OVER`` rows get their figures by a
    broadcast of at most ``SPREAD_GROUPS`` of them, the largest, so that its size is bounded and any other group holds less than
    one in ``SPREAD_GROUPS`` of the rows. Their rows, and rows without a key, are then dealt by
    ``spread_by``, where no figures wait for them; all others meet theirs by key. Counted groups are spread
    whether they have figures or not; with ``rows``, a group without figures has no known size, so name it
    only where every large group has them. One row of figures per group; ``how``: inner or left.
    """
    keys = [col(c) for c in on]
    kept = [c for c in per_group.columns if c not in on]
    unmatched = reduce(lambda a, b: a | b, [k.isNull() for k in keys])  # matches nothing, so any salt
    known = per_group.withColumn("_known", F.lit(True))
    figures = F.struct("_known", *[col(c) for c in kept])
    # zero, but as a constant it would be taken out of the join's keys
    if rows is None:
        sizes = facts.where(~unmatched).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
        sized, rows, zero = sizes.join(known, list(on), "left"), "_rows", F.xxhash64(*keys).bitwiseAND(F.lit(0))
    else:
        # of the size, so that both sides of the figures hold the same columns and one aggregate serves both
        sized, zero = known, F.least(col(rows), F.lit(0)).cast("bigint")
    largest = sized.where(col(rows) > SPREAD_OVER).orderBy(col(rows).desc(), *keys).limit(SPREAD_GROUPS)
    hot = largest.select(*keys, figures.alias("_hot"))
    salt = F.when(F.col("_hot").isNotNull() | unmatched, F.pmod(F.xxhash64(*[col(c) for c in spread_by]), F.lit(1 << 30)) + 1)
    dealt = facts.join(F.broadcast(hot), list(on), "left").withColumn("_salt", F.coalesce(salt, F.lit(0).cast("bigint")))
    if how == "inner":
        dealt = dealt.where("_hot IS NULL OR _hot._known")
    cold = known.select(*keys, figures.alias("_cold"), zero.alias("_salt"))
    joined = dealt.join(cold, [*on, "_salt"], "left").withColumn("_cold", F.coalesce("_hot", "_cold"))
    if how == "inner":
        joined = joined.where("_cold IS NOT NULL")
    return joined.select(*[col(c) for c in facts.columns], *[F.col("_cold").getField(c).alias(c) for c in kept])


_SIZE = f"{10_000} + int(floor(least(log2(abs(v)), 1100D) * {COARSE_PER_OCTAVE}))"
_COARSE = f"CASE WHEN v = 0 THEN 0 WHEN v > 0 THEN {_SIZE} ELSE -({_SIZE}) END"
_FINE = f"CASE WHEN hi = lo THEN 0 ELSE int(least(floor((v - lo) / (hi - lo) * {FINE_SLICES}), {FINE_SLICES - 1})) END"


def _ranks(probs: Sequence[float]) -> tuple[list[str], list[str]]:
    """The interpolated position of each quantile among ``n`` values, and the 1-based ranks on both sides of it."""
    positions = [f"{float(p)!r}D * (n - 1)" for p in probs]
    return positions, [r for x in positions for r in (f"floor({x}) + 1", f"ceil({x}) + 1")]


def counted_values(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Equal values of a group counted: ``by..., v, times``, without missing ones."""
    v = col(value).cast("double")
    facts = df.select(*[col(b) for b in by], (v + F.lit(0.0)).alias("v")).where(v.isNotNull() & ~F.isnan(v))
    return facts.groupBy(*[col(b) for b in by], "v").agg(F.count(F.lit(1)).alias("times"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str],
    bounded_groups: bool = False,
) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group: ``by..., n, q``.

    Equal values of a group are counted first, in one scan; the rest works on these counts and
    selects by counting: cumulative counts by coarse slice of the number line (an eighth of an
    octave) tell which slices hold the wanted ranks; these are cut finely between their lowest
    and highest value and counted again, FINE_LEVELS times. An eighth of an octave holds fewer
    than 2 ** 49 doubles and a level divides by 2 ** 16, so in the end a slice is one
    value, however tight a cluster it lies in.

    Every step is an aggregate that combines before its shuffle, windows run over one group's
    slices (tens of thousands at most), and no group is ever held in one task, whatever its size: there is one
    path for every table. Counts, minima and maxima do not depend on the order rows arrive in, so a stage
    recomputed after a lost executor gives the same cuts.

    Distinct values meet their slice's cuts by (group, coarse slice, salt): a group has a handful of cuts,
    so each is simply copied once per salt, and distinct values spread evenly over the salts. With
    ``bounded_groups`` the groups are columns of a schema and the cuts are broadcast.
    """
    inner = [f"g{i}" for i in range(len(by))]
    keys = ", ".join(inner)

    positions, ranks = _ranks(probs)
    wanted = " OR ".join(f"({r}) BETWEEN base + 1 AND base + c" for r in dict.fromkeys(ranks))
    at = [f"max(CASE WHEN ({r}) BETWEEN base + 1 AND base + c THEN v END)" for r in ranks]
    picked = ", ".join(f"{x} AS r{i}" for i, x in enumerate(at))
    quantiles = ", ".join(
        f"r{2 * j} + (r{2 * j + 1} - r{2 * j}) * ({x} - floor({x}))" for j, x in enumerate(positions)
    )

    coarse, fine = _COARSE, _FINE
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def meet(cuts: str) -> str:
        """Every value of a wanted slice next to the slice's cuts."""
        on = " AND ".join(f"f.{k} = w.{k}" for k in [*inner, "coarse"]) + " AND f.v BETWEEN w.lo AND w.hi"
        columns = "w.*, f.v, f.c"
        if bounded_groups:
            return f"SELECT /*+ BROADCAST(w) */ {columns} FROM counts f JOIN {cuts} w ON {on}"
        return f"""SELECT {columns} FROM (SELECT *, int(pmod(xxhash64(v), {salts})) AS salt FROM counts) f
            JOIN (SELECT *, explode(sequence(0, {salts - 1})) AS salt FROM {cuts}) w ON {on} AND f.salt = w.salt"""

    steps, cuts = [], "cuts0"
    for level in range(1, FINE_LEVELS + 1):
        steps.append(f"""by{level} AS (SELECT {keys}, coarse, lo AS outer_lo, {fine} AS fine, sum(c) AS c,
            min(v) AS lo, max(v) AS hi, first(n) AS n, first(start) AS start
            FROM ({meet(cuts)}) GROUP BY {keys}, coarse, lo, {fine}),
        in{level} AS (SELECT *, start + sum(c) OVER (PARTITION BY {keys}, coarse, outer_lo ORDER BY fine) - c AS base
            FROM by{level}),
        cuts{level} AS (SELECT {keys}, coarse, lo, hi, n, base AS start, base, c FROM in{level} WHERE {wanted})""")
        # the counts of the level go no further than its ranks
        steps.append(f"next{level} AS (SELECT {keys}, coarse, lo, hi, n, start FROM cuts{level})")
        cuts = f"next{level}"
    groups = [col(b).alias(g) for g, b in zip(inner, by)]
    source = df.select(*groups, col(value).cast("double").alias("v"))
    result = df.sparkSession.sql(
        f"""
        WITH facts AS (SELECT {keys}, v + 0D AS v FROM {{source}} WHERE v IS NOT NULL AND NOT isnan(v)),
        counts AS (SELECT {keys}, v, {coarse} AS coarse, count(*) AS c FROM facts GROUP BY {keys}, v),
        by0 AS (SELECT {keys}, coarse, sum(c) AS c, min(v) AS lo, max(v) AS hi FROM counts GROUP BY {keys}, coarse),
        in0 AS (SELECT *, sum(c) OVER (PARTITION BY {keys} ORDER BY coarse) - c AS base,
            sum(c) OVER (PARTITION BY {keys}) AS n FROM by0),
        cuts0 AS (SELECT {keys}, coarse, lo, hi, n, base AS start FROM in0 WHERE {wanted}),
        {", ".join(steps)},
        picked AS (SELECT {keys}, first(n) AS n, {picked} FROM (SELECT *, lo AS v FROM cuts{FINE_LEVELS}) GROUP BY {keys})
        SELECT {keys}, n, array({quantiles}) AS q FROM picked
        """,
        source=source,
    )
    return result.select(*[F.col(g).alias(b) for g, b in zip(inner, by)], "n", "q")


def long_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (column, value) over numeric columns, as doubles."""
    wide = df.select(*[col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([], [col(c) for c in columns], "column", "value")


def long_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (column, value) over any columns; whole numbers and fractions keep their
    type (``whole``, ``real``), everything else is in ``text``."""
    cells: list[Column] = []
    for name in columns:
        dtype = dtype_of(df, name)
        whole = real = text = None
        if isinstance(dtype, T.IntegralType):
            whole = col(name).cast("bigint")
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            real = present(name, dtype).cast("double")
        else:
            text = as_text(name, dtype)
        cells += [
            F.lit(name),
            F.lit(None).cast("bigint") if whole is None else whole,
            F.lit(None).cast("double") if real is None else real,
            F.lit(None).cast("string") if text is None else text,
        ]
    return df.select(F.stack(F.lit(len(columns)), *cells).alias("column", "whole", "real", "text"))


def long_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per (column, value) over any columns, in comparable text form."""
    wide = df.select(*[as_text(c, dtype_of(df, c)).alias(c) for c in columns])
    return wide.unpivot([], [col(c) for c in columns], "column", "value")


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], lazy: bool = False
) -> DataFrame:
    """Exact quantiles of several numeric columns: ``column, n, q``.

    Selected where they are asked for, unless ``lazy`` keeps them a plan.
    """
    if lazy:
        return exact_quantiles(long_numbers(df, columns), "value", probs, by=["column"], bounded_groups=True)
    found = selected(df, columns, probs)
    rows = [(name, n, q) for name, (n, q) in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, n bigint, q array<double>")


def selected(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, tuple[int, list[float]]]:
    """Number of values and exact quantiles of each numeric column that has any, by selection that ends on
    the data.

    A round is one scan and one aggregate that combines inside the tasks, so that no value is
    shuffled: it counts a column's values by slices of the number line and keeps those few that hold a wanted
    rank. The first round cuts all values into eighths of octaves, every further one the kept slices into
    FINE_SLICES, whose bounds reach the scan as filters. It is over when every kept slice is one value,
    mostly after two rounds; an eighth of an octave has fewer than 2 ** 49 doubles, so after
    FINE_LEVELS further ones at the latest. The driver gets one row per column and wanted rank in each round.
    """
    names = list(dict.fromkeys(columns))
    positions, ranks = _ranks(probs)
    wanted = " OR ".join(f"({r}) BETWEEN base + 1 AND base + c" for r in dict.fromkeys(ranks))
    wide = df.select(*[present(c, dtype_of(df, c)).cast("double").alias(f"c{i}") for i, c in enumerate(names)])

    def values(rows: DataFrame) -> DataFrame:
        cells = [x for i in range(len(names)) for x in (F.lit(i), F.col(f"c{i}") + F.lit(0.0))]
        return rows.select(F.stack(F.lit(len(names)), *cells).alias("i", "v")).where("v IS NOT NULL")

    spark = df.sparkSession
    cuts = spark.sql(
        f"""
        WITH slices AS (SELECT i, coarse, count(*) AS c, min(v) AS lo, max(v) AS hi
            FROM (SELECT i, v, {_COARSE} AS coarse FROM {{rows}}) GROUP BY i, coarse),
        placed AS (SELECT *, sum(c) OVER (PARTITION BY i ORDER BY coarse) - c AS base, sum(c) OVER (PARTITION BY i) AS n
            FROM slices)
        SELECT i, lo, hi, n, base, c FROM placed WHERE {wanted}""",
        rows=values(wide),
    ).collect() if names else []
    while open_cuts := [r for r in cuts if r["lo"] < r["hi"]]:
        inside = [F.col(f"c{r['i']}").between(r["lo"], r["hi"]) for r in open_cuts]
        few = spark.createDataFrame([tuple(r) for r in open_cuts], "i int, lo double, hi double, n bigint, base bigint, c bigint")
        finer = spark.sql(
            f"""
            WITH met AS (SELECT /*+ BROADCAST(w) */ w.i, w.lo AS cut, w.hi, w.lo, w.n, w.base AS start, f.v
                FROM {{rows}} f JOIN {{cuts}} w ON f.i = w.i AND f.v BETWEEN w.lo AND w.hi),
            slices AS (SELECT i, cut, {_FINE} AS fine, count(*) AS c, min(v) AS lo, max(v) AS hi, first(n) AS n,
                first(start) AS start FROM met GROUP BY i, cut, {_FINE}),
            placed AS (SELECT *, start + sum(c) OVER (PARTITION BY i, cut ORDER BY fine) - c AS base FROM slices)
            SELECT i, lo, hi, n, base, c FROM placed WHERE {wanted}""",
            rows=values(wide.where(reduce(lambda a, b: a | b, inside))), cuts=few,
        ).collect()
        cuts = [r for r in cuts if r["lo"] == r["hi"]] + finer
    found = {}
    for i, name in enumerate(names):
        own = [r for r in cuts if r["i"] == i]
        if own:
            n, q = own[0]["n"], []
            for p in probs:
                at = float(p) * (n - 1)
                low, high = (next(r["lo"] for r in own if r["base"] < k <= r["base"] + r["c"]) for k in (floor(at) + 1, ceil(at) + 1))
                q.append(low + (high - low) * (at - floor(at)))
            found[name] = (n, q)
    return found


def approx_column_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """The one-scan alternative, opt-in: returns elements within the sketch's rank error."""
    return (
        long_numbers(df, columns)
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("column")
        .agg(
            F.count("value").alias("n"),
            F.percentile_approx("value", list(probs), SKETCH_ACCURACY).alias("q"),
        )
    )


# The figures below describe a whole column in one row, so they are computed where a step is
# declared and enter its plan as constants. A chain of steps then grows by one projection or
# filter per step, instead of nesting every earlier statistic into each later one, and filter
# bounds reach the scan.


def quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Exact quantiles per column; None for columns without values."""
    quantiles = dict.fromkeys(columns, [None] * len(probs))
    return quantiles | {name: q for name, (_, q) in selected(df, columns, probs).items()}


def moments(df: DataFrame, column: str) -> Row:
    """``mean, std, lo, hi`` of one numeric column."""
    v = present(column, dtype_of(df, column)).cast("double")
    return df.agg(
        F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"),
        F.min(v).alias("lo"),
        F.max(v).alias("hi"),
    ).first()


def mode_value(df: DataFrame, column: str):
    """The smallest of the most frequent values.

    Counted by value first, so no task holds the set of distinct values.
    """
    value = present(column, dtype_of(df, column))
    counts = df.select(value.alias("_v")).where("_v is not null").groupBy("_v").count()
    best = counts.agg(F.min(F.struct((-F.col("count")).alias("_c"), "_v")).alias("_b"))
    return best.select("_b._v").first()[0]
