"""Group statistics and correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import (
    choice,
    col,
    dtype_of,
    is_present,
    present,
    require,
    require_numeric,
)


def group_statistics(
    df: DataFrame, group_col: str, value_col: str, agg_func: str = "mean"
) -> DataFrame:
    """One aggregate per group: ``<group_col>, "<agg>(<value_col>)"``, missing keys dropped.

    Hash aggregation combines before the shuffle, so hot groups arrive as one row per task.
    """
    require(df, group_col, value_col)
    agg_func = choice(agg_func, ("mean", "sum", "count", "min", "max"), "aggregate")
    if agg_func in ("mean", "sum"):
        require_numeric(df, value_col)
    v = present(value_col, dtype_of(df, value_col))
    aggregate = {
        "mean": F.avg(v),
        "sum": F.coalesce(F.sum(v), F.lit(0)),
        "count": F.count(v),
        "min": F.min(v),
        "max": F.max(v),
    }[agg_func]
    return (
        df.where(is_present(group_col, dtype_of(df, group_col)))
        .groupBy(col(group_col))
        .agg(aggregate.alias(f"{agg_func}({value_col})"))
    )


def correlation(df: DataFrame, col_a: str, col_b: str) -> DataFrame:
    """Pearson correlation over complete pairs, with strength and direction; one row."""
    require_numeric(df, col_a, col_b)
    a, b = col(col_a).cast("double"), col(col_b).cast("double")
    both = is_present(col_a, dtype_of(df, col_a)) & is_present(col_b, dtype_of(df, col_b))
    pairs = df.where(both).select(a.alias("a"), b.alias("b"))
    r = F.col("coefficient")
    return pairs.agg(
        F.try_divide(
            F.covar_samp("a", "b"), F.stddev_samp("a") * F.stddev_samp("b")
        ).alias("coefficient"),
        F.count(F.lit(1)).alias("n"),
    ).select(
        "coefficient",
        "n",
        F.when(F.abs(r) >= 0.7, "strong")
        .when(F.abs(r) >= 0.4, "moderate")
        .when(r.isNotNull(), "weak")
        .alias("strength"),
        F.when(r >= 0, "positive").when(r < 0, "negative").alias("direction"),
    )
