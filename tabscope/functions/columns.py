"""Column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Reference a top-level column by its exact name, dots and backticks included."""
    return F.col(quoted(name))


def require(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s) {missing}; available: {df.columns}")


def choice(value: str, allowed: tuple[str, ...], what: str) -> str:
    cleaned = value.lower().strip()
    if cleaned not in allowed:
        raise ValueError(f"unknown {what} {value!r}; use one of {', '.join(allowed)}")
    return cleaned


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    require(df, name)
    return df.schema[name].dataType


def is_numeric(dtype: T.DataType) -> bool:
    """Numbers only: booleans are a kind of their own."""
    return isinstance(dtype, T.NumericType)


def require_numeric(df: DataFrame, *names: str) -> None:
    for name in names:
        if not is_numeric(dtype_of(df, name)):
            raise ValueError(f"column {name!r} is not numeric")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_numeric(f.dataType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def present(name: str, dtype: T.DataType) -> Column:
    """The column with NaN read as missing, since NaN and NULL mean the same here."""
    c = col(name)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    return c


def is_present(name: str, dtype: T.DataType) -> Column:
    """``present(...)`` is not NULL, as a condition the scan can use."""
    c = col(name)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def as_text(name: str, dtype: T.DataType) -> Column:
    """A text form in which two values are equal exactly when the originals are."""
    c = present(name, dtype)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (c + F.lit(0).cast(dtype)).cast("string")  # -0.0 and 0.0 count once
    if isinstance(dtype, T.BinaryType):
        return F.base64(c)
    if isinstance(dtype, (T.MapType, T.StructType, T.VariantType)):
        return F.to_json(c)
    return c.cast("string")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields 0.0 where the denominator is zero or missing."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def clamp(value: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
