"""Imputation, outlier filters, scaling, de-duplication and type conversion.

Every step is described by a ``Change``: a new expression for one column, a condition rows
must meet, or both. The column statistics a step needs are one row, computed when the step is
declared; the step itself is then a plain projection or filter over the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.columns import (
    choice,
    col,
    dtype_of,
    is_numeric,
    is_present,
    present,
    require,
    require_numeric,
)
from tabscope.functions.stats import mode_value, moments, quantile_values


@dataclass(frozen=True)
class Change:
    column: str
    value: Column | None = None
    keep: Column | None = None

    def apply(self, df: DataFrame) -> DataFrame:
        if self.value is not None:
            df = df.withColumn(self.column, self.value)
        return df if self.keep is None else df.where(self.keep)


def fill_change(df: DataFrame, column: str, strategy: str) -> Change:
    strategy = choice(strategy, ("mean", "median", "mode", "drop", "zero"), "strategy")
    dtype = dtype_of(df, column)
    v = present(column, dtype)
    if strategy == "drop":
        return Change(column, keep=is_present(column, dtype))
    if strategy == "mode":
        return Change(column, F.coalesce(v, F.lit(mode_value(df, column)).cast(dtype)))
    if not is_numeric(dtype):
        raise ValueError(f"strategy {strategy!r} needs a numeric column, {column!r} is not")
    if strategy == "zero":
        return Change(column, F.coalesce(v, F.lit(0).cast(dtype)))
    # averages of whole numbers are fractions, so the filled column is always DOUBLE
    if strategy == "mean":
        filler = moments(df, column)["mean"]
    else:
        filler = quantile_values(df, [column], (0.5,))[column][0]
    return Change(column, F.coalesce(v.cast("double"), F.lit(filler).cast("double")))


def outlier_change(
    df: DataFrame, column: str, method: str, threshold: float = 1.5, z: float = 3.0
) -> Change:
    require_numeric(df, column)
    method = choice(method, ("iqr", "zscore"), "method")
    v = present(column, dtype_of(df, column)).cast("double")
    if method == "iqr":
        q1, q3 = quantile_values(df, [column], (0.25, 0.75))[column]
        if q1 is None:
            return Change(column, keep=F.lit(False))
        spread = q3 - q1
        # the bare column, so that the bounds reach the scan; NaN is above every bound
        return Change(column, keep=col(column).between(q1 - threshold * spread, q3 + threshold * spread))
    m = moments(df, column)
    if m["std"] == 0:
        return Change(column)  # no spread: nothing is an outlier
    if m["std"] is None:
        return Change(column, keep=F.lit(False))  # nothing can be told from one value
    return Change(column, keep=F.abs((v - m["mean"]) / m["std"]) <= z)


def normalize_change(df: DataFrame, column: str, method: str) -> Change:
    require_numeric(df, column)
    method = choice(method, ("minmax", "standard"), "method")
    v = present(column, dtype_of(df, column)).cast("double")
    m = moments(df, column)
    if method == "minmax":
        origin, unit = m["lo"], None if m["lo"] is None else m["hi"] - m["lo"]
    else:
        origin, unit = m["mean"], m["std"]
    if unit == 0:
        return Change(column, v)
    if unit is None:
        return Change(column, F.lit(None).cast("double"))
    return Change(column, (v - origin) / unit)


def convert_change(df: DataFrame, column: str, dtype: str) -> Change:
    require(df, column)
    return Change(column, col(column).try_cast(dtype))


def fill_missing(df: DataFrame, column: str, strategy: str = "mean") -> DataFrame:
    """Fill missing values with the mean, median, mode or zero, or drop those rows."""
    return fill_change(df, column, strategy).apply(df)


def remove_outliers(
    df: DataFrame, column: str, method: str = "iqr", threshold: float = 1.5, z: float = 3.0
) -> DataFrame:
    """Keep rows inside the IQR fences or within ``z`` standard deviations.

    Rows with a missing value do not meet either condition and are dropped as well.
    """
    return outlier_change(df, column, method, threshold, z).apply(df)


def normalize_column(df: DataFrame, column: str, method: str = "minmax") -> DataFrame:
    """Scale to [0, 1] or standardise in place; a column without spread stays as it is."""
    return normalize_change(df, column, method).apply(df)


def drop_duplicates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct combination: of rows alike in ``columns`` the smallest one stays.

    Rows are compared by their other columns from left to right, missing values first, as one
    combining aggregate, so that repeated runs keep the same rows. Columns without an order
    are compared as JSON.
    """
    if not columns:
        return df.dropDuplicates(df.columns)
    require(df, *columns)
    others = [c for c in df.columns if c not in columns]
    if not others:
        return df.dropDuplicates(list(columns))
    plain = [F.to_json(col(c)) if "map<" in dtype_of(df, c).simpleString() else col(c) for c in others]
    order = F.struct(*[p.alias(f"o{i}") for i, p in enumerate(plain)])
    row = F.struct(*[col(c).alias(f"v{i}") for i, c in enumerate(others)])
    keys = [col(c).alias(f"k{i}") for i, c in enumerate(columns)]
    first = df.groupBy(*keys).agg(F.min_by(row, order).alias("_row"))
    named = {c: F.col(f"k{i}") for i, c in enumerate(columns)} | {c: F.col(f"_row.v{i}") for i, c in enumerate(others)}
    return first.select(*[named[c].alias(c) for c in df.columns])


def convert_type(df: DataFrame, column: str, dtype: str) -> DataFrame:
    """Change a column's type; values that do not convert become missing."""
    return convert_change(df, column, dtype).apply(df)
