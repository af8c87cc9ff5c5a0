"""First looks at a table: schema, shape, head and a reproducible sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import col, dtype_of, present, ratio, require
from tabscope.functions.stats import long_values


def dtype_column(df: DataFrame) -> Column:
    """Spark type name of the column named in ``column`` (one entry per schema field)."""
    pairs = [F.lit(x) for name, dtype in df.dtypes for x in (name, dtype)]
    return F.create_map(*pairs)[F.col("column")]


def column_counts(df: DataFrame, exact: bool = True) -> DataFrame:
    """``column, total, non_null, unique`` for every column.

    Exact: one scan, values counted per (column, value) with map-side combine, then summed
    per column, so distinct sets are spread over the cluster and hot values cost nothing.
    Approximate (opt-in): one scan, one row shuffled per task.
    """
    if exact:
        key = ["column", "whole", "real", "text"]
        counted = long_values(df, df.columns).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        # a zero per column, so that an empty table still lists its columns
        every = df.sparkSession.range(1).select(
            F.explode(F.array(*[F.lit(c) for c in df.columns])).alias("column"),
            F.lit(None).cast("bigint").alias("whole"),
            F.lit(None).cast("double").alias("real"),
            F.lit(None).cast("string").alias("text"),
            F.lit(0).cast("bigint").alias("n"),
        )
        filled = F.col("whole").isNotNull() | F.col("real").isNotNull() | F.col("text").isNotNull()
        return counted.unionByName(every).groupBy("column").agg(
            F.sum("n").alias("total"),
            F.sum(F.when(filled, F.col("n")).otherwise(0)).alias("non_null"),
            F.count_if(filled).alias("unique"),
        )
    cells = []
    for name in df.columns:
        c = present(name, dtype_of(df, name))
        cells.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(F.lit(1)).alias("total"),
                F.count(c).alias("non_null"),
                F.approx_count_distinct(c).alias("unique"),
            )
        )
    return df.agg(F.array(*cells).alias("_all")).select(F.inline("_all"))


def schema_info(df: DataFrame, exact: bool = True) -> DataFrame:
    """Type, share of non-missing values and distinct count of every column."""
    return column_counts(df, exact).select(
        "column",
        dtype_column(df).alias("dtype"),
        F.round(ratio(F.col("non_null"), F.col("total")), 4).alias("non_null_rate"),
        F.col("unique").alias("unique_count"),
    )


def frame_info(df: DataFrame, exact: bool = True) -> DataFrame:
    """Shape of the table next to type, present, missing and distinct counts per column."""
    return column_counts(df, exact).select(
        "column",
        dtype_column(df).alias("dtype"),
        "non_null",
        (F.col("total") - F.col("non_null")).alias("missing"),
        "unique",
        F.col("total").alias("table_rows"),
        F.lit(len(df.columns)).alias("table_columns"),
    )


def load_info(df: DataFrame) -> DataFrame:
    """One row: row and column counts, column names, size of the values as text in KB."""
    size = F.lit(0)
    for name in df.columns:
        text = F.coalesce(col(name).cast("string"), F.lit(""))
        size = size + F.octet_length(text)
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.lit(",".join(df.columns)).alias("columns"),
        F.coalesce(F.round(F.sum(size) / 1024, 2), F.lit(0.0)).alias("size_kb"),
    )


def head(df: DataFrame, n: int = 5, order_by: str | list[str] | None = None) -> DataFrame:
    """The first ``n`` rows by ``order_by``; any ``n`` rows without it, as a Spark table has no
    row order of its own."""
    if order_by is None:
        return df.limit(n)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    require(df, *keys)
    return df.orderBy(*[col(k) for k in keys]).limit(n)


def sample_rows(df: DataFrame, key: str | list[str], n: int = 5, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all of them if there are fewer, never less than one).

    Rows are taken by the smallest seeded hash of their key, so the same rows come back on
    every run and on every cluster size; each task keeps only its ``n`` best.
    """
    keys = [key] if isinstance(key, str) else list(key)
    require(df, *keys)
    text = F.concat_ws(":", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    return df.orderBy(F.md5(text), *[col(k) for k in keys]).limit(max(1, n))
