"""Running a declared list of cleaning steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.clean import (
    Change,
    convert_change,
    drop_duplicates,
    fill_change,
    normalize_change,
    outlier_change,
)

_LOG = "step int, column string, action string, status string, rows_in bigint, rows_out bigint"
_PASSED = "_steps_passed"


@dataclass(frozen=True)
class PlanRun:
    """The cleaned table and a log with one row per step, both as plans; the statistics that steps need are
    already in them as constants."""

    df: DataFrame
    log: DataFrame


def _change(df: DataFrame, action: str, column: str, params: Mapping[str, Any]) -> Change | None:
    if action == "fill_missing":
        return fill_change(df, column, params.get("strategy", "mean"))
    if action == "remove_outliers":
        threshold = float(params.get("threshold", 1.5))
        return outlier_change(df, column, params.get("method", "iqr"), threshold)
    if action == "normalize_column":
        return normalize_change(df, column, params.get("method", "minmax"))
    if action == "convert_type":
        return convert_change(df, column, params.get("dtype", "string"))
    return None


def run_plan(df: DataFrame, steps: Sequence[Mapping[str, Any]]) -> PlanRun:
    """Applies ``{column, action, params}`` steps in order.

    Unknown actions are logged as skipped and impossible steps (unknown column, wrong type)
    as failed; both leave the table as it is. The statistics a step needs are computed when
    the step is reached (one row each) and become constants, so the plan grows by one
    projection or filter per step however many there are.

    The log counts rows without one scan per step:
    a second, marked form of the table keeps removed rows together with the number of steps
    they passed, and one aggregate over it yields every count. De-duplication cannot be
    expressed as a mark and starts a new marked form.
    """
    clean = df
    marked = df.withColumn(_PASSED, F.lit(0))
    depth = 0
    stretches: list[tuple[DataFrame, list[tuple[int, str, str, str, int, int]]]] = []
    entries: list[tuple[int, str, str, str, int, int]] = []
    joint: list[tuple[int, str, str, str, int]] = []  # steps whose row counts span two stretches

    for number, step in enumerate(steps, start=1):
        column, action = step.get("column") or "", step.get("action") or ""
        params = step.get("params") or {}
        try:
            if action == "drop_duplicates":
                subset = params.get("columns") or ([column] if column else None)
                if isinstance(subset, str):
                    subset = [c.strip() for c in subset.split(",")]
                deduplicated = drop_duplicates(clean, subset)
                stretches.append((marked, entries))
                joint.append((number, column, action, "applied", depth))
                clean, marked = deduplicated, deduplicated.withColumn(_PASSED, F.lit(0))
                entries, depth = [], 0
                continue
            change = _change(clean, action, column, params)
        except (ValueError, TypeError, ParseException, AnalysisException) as exc:
            reason = str(exc).partition("\n")[0]
            entries.append((number, column, action, f"failed: {reason}", depth, depth))
            continue
        if change is None:
            entries.append((number, column, action, "skipped", depth, depth))
            continue
        here = F.col(_PASSED) == depth
        kept = here if change.keep is None else here & F.coalesce(change.keep, F.lit(False))
        passed = F.when(kept, depth + 1).otherwise(F.col(_PASSED))
        marked = marked.withColumn(_PASSED, passed)
        if change.value is not None:
            marked = marked.withColumn(column, change.value)
        clean = change.apply(clean)
        entries.append((number, column, action, "applied", depth, depth + 1))
        depth += 1
    stretches.append((marked, entries))
    return PlanRun(clean, _log(stretches, joint))


def _rows_at(depth: int):
    return F.count_if(F.col(_PASSED) >= depth)


def _entry(number: int, column: str, action: str, status: str, rows_in, rows_out):
    return F.struct(
        F.lit(number).alias("step"),
        F.lit(column).alias("column"),
        F.lit(action).alias("action"),
        F.lit(status).alias("status"),
        rows_in.alias("rows_in"),
        rows_out.alias("rows_out"),
    )


def _log(stretches, joint) -> DataFrame:
    parts = []
    for i, (marked, entries) in enumerate(stretches):
        rows = [
            _entry(number, column, action, status, _rows_at(before), _rows_at(after))
            for number, column, action, status, before, after in entries
        ]
        if i > 0:  # the de-duplication that opened this stretch
            number, column, action, status, before = joint[i - 1]
            rows_in = stretches[i - 1][0].agg(_rows_at(before)).scalar()
            rows.insert(0, _entry(number, column, action, status, rows_in, F.count(F.lit(1))))
        if rows:
            counted = marked.select(_PASSED).agg(F.array(*rows).alias("_rows"))
            parts.append(counted.select(F.inline("_rows")))
    if not parts:
        return stretches[0][0].sparkSession.createDataFrame([], _LOG)
    return reduce(DataFrame.unionByName, parts)
