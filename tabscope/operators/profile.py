"""Descriptive statistics, missing values, value distributions and quality issues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabscope.functions.columns import (
    as_text,
    dtype_of,
    is_present,
    numeric_columns,
    present,
    ratio,
    require,
    text_columns,
)
from tabscope.functions.stats import approx_column_quantiles, column_quantiles, long_text, quantile_values
from tabscope.operators.inspect import column_counts, dtype_column

STATISTICS = ("count", "mean", "std", "min", "25%", "50%", "75%", "max")
QUARTILES = (0.25, 0.5, 0.75)


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One wide aggregate in one scan, turned into one row per column."""
    cells = []
    for name in columns:
        v = present(name, dtype_of(df, name)).cast("double")
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(v).alias("count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                F.max(v).alias("max"),
            )
        )
    return df.agg(F.array(*cells).alias("_all")).select(F.inline("_all"))


def _described(df: DataFrame, columns: Sequence[str] | None, exact: bool, lazy: bool) -> DataFrame:
    names = list(columns) if columns is not None else numeric_columns(df)
    if not names:
        raise ValueError("no numeric columns")
    if exact:
        quartiles = column_quantiles(df, names, QUARTILES, lazy).select("column", "q")
    else:
        quartiles = approx_column_quantiles(df, names, QUARTILES).select("column", "q")
    return _moments(df, names).join(quartiles, "column", "left")


def describe_long(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True, lazy: bool = False
) -> DataFrame:
    """``column, statistic, value`` over the numeric columns.

    Exact quartiles are selected at once; ``lazy`` keeps them a plan, which takes more steps.
    """
    q = F.col("q")
    values = [F.col("count").cast("double"), "mean", "std", "min", q[0], q[1], q[2], "max"]
    pairs = [
        F.struct(F.lit(s).alias("statistic"), (F.col(v) if isinstance(v, str) else v).alias("value"))
        for s, v in zip(STATISTICS, values)
    ]
    return _described(df, columns, exact, lazy).select("column", F.inline(F.array(*pairs)))


def describe_wide(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """``statistic`` and one column per numeric column."""
    names = list(columns) if columns is not None else numeric_columns(df)
    return (
        describe_long(df, names, exact).groupBy("statistic").pivot("column", names).agg(F.first("value"))
    )


def missing_summary(df: DataFrame) -> DataFrame:
    """``column, null_count, null_pct`` from one scan."""
    total = F.count(F.lit(1))
    cells = []
    for name in df.columns:
        nulls = F.count_if(present(name, dtype_of(df, name)).isNull())
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                nulls.alias("null_count"),
                F.round(ratio(nulls, total) * 100, 2).alias("null_pct"),
            )
        )
    return df.agg(F.array(*cells).alias("_all")).select(F.inline("_all"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of every text column, ties by value.

    Counts are combined before the shuffle and the top-k is limited inside each task before
    the per-column ranking, so a column never gathers its distinct values in one place.
    """
    names = list(columns) if columns is not None else text_columns(df)
    if not names:
        raise ValueError("no text columns")
    counted = long_text(df, names).where("value is not null").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("count")
    )
    order = W.partitionBy("column").orderBy(F.desc("count"), "value")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def value_distribution(df: DataFrame, column: str, top_n: int = 10) -> DataFrame:
    """``value, count, pct, total_unique`` of the most frequent values; pct is of all rows."""
    require(df, column)
    value = as_text(column, dtype_of(df, column))
    counted = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("count"))
    whole = counted.agg(
        F.struct(F.sum("count").alias("rows"), F.count("value").alias("unique"))
    ).scalar()
    # the missing value goes last and out after the limit: a filter before it would be pushed
    # into the scan and keep this branch from sharing the counts with the totals
    return (
        counted.orderBy(F.col("value").isNull(), F.desc("count"), "value")
        .limit(top_n)
        .where("value is not null")
        .select(
            "value",
            "count",
            F.round(ratio(F.col("count"), whole["rows"]) * 100, 2).alias("pct"),
            whole["unique"].alias("total_unique"),
        )
    )


def quick_profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, missing and distinct counts per column, with mean/std/min/max where numeric."""
    base = column_counts(df, exact).select(
        "column",
        dtype_column(df).alias("dtype"),
        (F.col("total") - F.col("non_null")).alias("null_count"),
        F.round(ratio(F.col("total") - F.col("non_null"), F.col("total")) * 100, 2).alias("null_pct"),
        F.col("unique").alias("unique_count"),
    )
    names = numeric_columns(df)
    if not names:
        empty = F.lit(None).cast("double")
        return base.select("*", *[empty.alias(c) for c in ("mean", "std", "min", "max")])
    moments = _moments(df, names).select(
        "column", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "max"
    )
    return base.join(moments, "column", "left")


def quality_issues(df: DataFrame, t: float = 1.5) -> DataFrame:
    """``column, issue, n, pct``: columns with missing values, and IQR outliers if numeric.

    One scan counts all issues of all columns, after the quartiles of the numeric ones.
    """
    names = numeric_columns(df)
    quartiles = quantile_values(df, names, (0.25, 0.75)) if names else {}
    total = F.count(F.lit(1))
    cells = []

    def count(name: str, issue: str, n: Column) -> None:
        pct = F.round(ratio(n, total) * 100, 2)
        cells.append(
            F.struct(
                F.lit(name).alias("column"), F.lit(issue).alias("issue"), n.alias("n"), pct.alias("pct")
            )
        )

    for name in df.columns:
        count(name, "missing_values", F.count_if(~is_present(name, dtype_of(df, name))))
    for name, (q1, q3) in quartiles.items():
        if q1 is None:
            continue
        v = present(name, dtype_of(df, name)).cast("double")
        outside = (v < q1 - t * (q3 - q1)) | (v > q3 + t * (q3 - q1))
        count(name, "iqr_outliers", F.count_if(outside))
    return df.agg(F.array(*cells).alias("_all")).select(F.inline("_all")).where("n > 0")
