"""CSV with types found from the data, under one rule for missing values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.columns import col, present
from tabscope.operators.inspect import load_info, sample_rows, schema_info
from tabscope.operators.profile import describe_long, missing_summary, top_values

# --- fixed values: texts that stand for a missing value
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_WHOLE = r"^\s*[+-]?\d+\s*$"
_REAL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
_SURPLUS = "__surplus"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")


def _cleaned(name: str, na_values: Iterable[str]) -> Column:
    c = col(name)
    return F.when(~c.isin(*na_values), c)


def infer_types(
    df: DataFrame, na_values: Iterable[str] = NA_VALUES, surplus: str | None = None
) -> T.StructType:
    """BIGINT, DOUBLE, BOOLEAN or STRING per text column, from one aggregate over the table.

    Whole numbers need every value present to be BIGINT and become DOUBLE otherwise; truth
    values with gaps stay text; a column without any value is DOUBLE; dates stay text. A value
    in the column ``surplus`` means a row had more fields than the header, which is an error.
    """
    names = [c for c in df.columns if c != surplus]
    if not names:
        raise ValueError("the table has no columns")
    counts = [] if surplus is None else [F.count(col(surplus)).alias(surplus)]
    for name in names:
        c = _cleaned(name, na_values)
        whole = c.rlike(_WHOLE) & c.try_cast("bigint").isNotNull()
        counts.append(
            F.struct(
                F.count(F.lit(1)).alias("rows"),
                F.count(c).alias("filled"),
                F.count_if(whole).alias("whole"),
                F.count_if(c.rlike(_REAL)).alias("real"),
                F.count_if(c.isin(*_TRUTH)).alias("truth"),
            ).alias(name)
        )
    seen = df.agg(*counts).first()  # one row, as wide as the schema
    if surplus is not None and seen[surplus]:
        raise ValueError(f"{seen[surplus]} rows have more fields than the header")
    fields = []
    for name in names:
        n = seen[name]
        if n["filled"] == 0:
            # a header without rows says nothing about types
            dtype = T.DoubleType() if n["rows"] else T.StringType()
        elif n["whole"] == n["rows"]:
            dtype = T.LongType()
        elif n["real"] == n["filled"]:
            dtype = T.DoubleType()
        elif n["truth"] == n["rows"]:
            dtype = T.BooleanType()
        else:
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def apply_types(
    df: DataFrame, schema: T.StructType, na_values: Iterable[str] = NA_VALUES
) -> DataFrame:
    """Text columns cast to ``schema``; missing-value texts become NULL."""
    cells = []
    for field in schema:
        c = _cleaned(field.name, na_values)
        cells.append(c.try_cast(field.dataType).alias(field.name))
    return df.select(*cells)


def typed(df: DataFrame, na_values: Iterable[str] = NA_VALUES) -> DataFrame:
    """A table of text columns with its types found and applied."""
    return apply_types(df, infer_types(df, na_values), na_values)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    na_values: Iterable[str] = NA_VALUES,
    multi_line: bool = False,
) -> DataFrame:
    """A CSV file or folder with a header row.

    A given ``schema`` saves the typing scan, and with it the check for rows with too many
    fields; rows with too few are filled with missing values. Files are split between tasks
    unless ``multi_line`` says that quoted fields may contain line breaks.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    try:
        raw = reader.csv(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from exc
        raise
    if not raw.columns:
        raise ValueError(f"file is empty: {path}")
    if schema is None:
        # two columns past the header: one to see surplus fields, and one never asked for, so
        # that the reader always picks columns and does not take short rows for broken ones
        names = [*raw.columns, "_surplus", "_unread"]
        text = T.StructType([T.StructField(n, T.StringType()) for n in names])
        checked = reader.schema(text).csv(path).drop("_unread")
        return apply_types(checked, infer_types(checked, na_values, "_surplus"), na_values)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return normalize_nan(apply_types(raw, schema, na_values))


def parse_lines(
    lines: DataFrame, names: Iterable[str], line: str = "value", na_values: Iterable[str] = NA_VALUES
) -> DataFrame:
    """CSV lines held in a text column, without their header, as a table with types found from the data.

    ``names`` are the fields of the header. The rules are those of ``read_csv``: fields in quotes may hold
    commas, doubled quotes and line breaks, short lines are filled with missing values, and a
    line with more fields than the header is an error. Parsing is an expression over the lines, so the scan that finds
    the types is the only one before the table is used. Null and blank lines are left out, as files leave them out.
    """
    names = list(names)
    if not names:
        raise ValueError("the header has no fields")
    if len(set(names)) < len(names):
        raise ValueError("the header repeats a field")
    quoted = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}
    parsed = lines.where(col(line).isNotNull() & (F.trim(col(line)) != "")).select(
        F.from_csv(col(line), f"{quoted}, `{_SURPLUS}` string", options).alias("r")
    )
    text = parsed.select(*[F.col("r").getField(n).alias(n) for n in [*names, _SURPLUS]])
    return apply_types(text, infer_types(text, na_values, _SURPLUS), na_values)


def normalize_nan(df: DataFrame) -> DataFrame:
    """NaN in float columns becomes NULL."""
    return df.select(*[present(f.name, f.dataType).alias(f.name) for f in df.schema])


def register_views(df: DataFrame, name: str, key: str | list[str], n: int = 5) -> list[str]:
    """Read-only views ``<name>_schema, _profile, _missing, _top, _sample, _info``.

    Views are plans; nothing is computed until one is queried.
    """
    views = {
        "schema": schema_info(df),
        "missing": missing_summary(df),
        "sample": sample_rows(df, key, n),
        "info": load_info(df),
    }
    try:
        views["profile"] = describe_long(df, lazy=True)
    except ValueError:
        pass  # no numeric columns
    try:
        views["top"] = top_values(df)
    except ValueError:
        pass  # no text columns
    for suffix, view in views.items():
        view.createOrReplaceTempView(f"{name}_{suffix}")
    return [f"{name}_{suffix}" for suffix in views]
