"""A table with a history of named versions and rollback."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabscope.operators.clean import Change
from tabscope.session import shared_dir


@dataclass(frozen=True)
class _Version:
    number: int
    label: str
    df: DataFrame
    created_at: datetime
    stretch: int  # versions of one stretch differ by changes of cells and by row filters
    marked: DataFrame  # the stretch's rows, removed ones too, with the number of changes they passed
    depth: int  # changes of the stretch up to this version


_MARK = "__passed"


class VersionedTable:
    """Versions are plans, so keeping them costs nothing and rolling back is a lookup.

    ``snapshot=True`` (or ``every=k``) writes versions as Parquet below the shared
    checkpoint folder instead, which ends their lineage: later steps read the written table
    and row counts come from its footers. Written tables outlive lost executors.

    Changes of cells and row filters (``change``, ``where``) are kept in a second, marked form as well, which
    holds removed rows together with the number of changes they passed. One aggregate over it counts
    all versions of such a stretch in one scan. ``apply`` takes any function, and begins a new stretch.
    """

    def __init__(
        self, df: DataFrame | None = None, label: str = "initial", snapshot: bool = False, every: int = 1
    ):
        self._versions: list[_Version] = []
        self._every = every if snapshot else 0
        self._folder: str | None = None
        if df is not None:
            self.load(df, label)

    def _kept(self, df: DataFrame, number: int) -> DataFrame:
        if not self._every or (number - 1) % self._every:
            return df
        if self._folder is None:
            self._folder = shared_dir(df.sparkSession, "versions")
        # a version number can come back after a rollback, so each writing has its own folder
        stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
        path = f"{self._folder}/v{number}-{stamp}"
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def _add(self, df: DataFrame, label: str, marked: DataFrame | None = None, depth: int = 0) -> None:
        number = self.version + 1
        kept = self._kept(df, number)
        if marked is None or kept is not df:  # a written version is counted by itself
            stretch, marked, depth = number, kept.withColumn(_MARK, F.lit(0)), 0
        else:
            stretch = self._versions[-1].stretch
        self._versions.append(_Version(number, label, kept, datetime.now(timezone.utc), stretch, marked, depth))

    @property
    def version(self) -> int:
        """0 as long as nothing is loaded."""
        return self._versions[-1].number if self._versions else 0

    @property
    def df(self) -> DataFrame:
        if not self._versions:
            raise ValueError("no table loaded; call load() first")
        return self._versions[-1].df

    def load(self, df: DataFrame, label: str = "initial") -> "VersionedTable":
        """Starts over at version 1."""
        self._versions = []
        self._add(df, label)
        return self

    def apply(self, label: str, fn: Callable[[DataFrame], DataFrame | None]) -> "VersionedTable":
        """Adds the version ``fn`` makes of the current one; None stands for no change."""
        result = fn(self.df)
        last = self._versions[-1]
        if result is None:
            self._add(last.df, label, last.marked, last.depth)
        else:
            self._add(result, label)
        return self

    def change(self, label: str, fn: Callable[[DataFrame], Change | None]) -> "VersionedTable":
        """Adds the version that a cleaning change of the current one makes, in the same stretch."""
        change = fn(self.df)
        if change is None:
            return self.apply(label, lambda df: None)
        last = self._versions[-1]
        here = F.col(_MARK) == last.depth
        passed = here if change.keep is None else here & F.coalesce(change.keep, F.lit(False))
        marked = last.marked.withColumn(_MARK, F.when(passed, last.depth + 1).otherwise(F.col(_MARK)))
        if change.value is not None:
            marked = marked.withColumn(change.column, change.value)
        self._add(change.apply(last.df), label, marked, last.depth + 1)
        return self

    def where(self, label: str, keep: Column | str) -> "VersionedTable":
        """Adds the version with the rows for which ``keep`` holds."""
        condition = F.expr(keep) if isinstance(keep, str) else keep
        first = self.df.columns[0]
        return self.change(label, lambda df: Change(first, keep=condition))

    def rollback(self, versions: int = 1) -> "VersionedTable":
        """Goes back, at most to version 1, and forgets what came after."""
        target = max(1, self.version - versions)
        if self._versions and target < self.version:
            self._versions = self._versions[:target]
        return self

    def history(self) -> DataFrame:
        """``version, label, n_rows, n_cols, created_at``; counts are taken when it is read, in one scan
        for all versions of a stretch."""
        if not self._versions:
            raise ValueError("no table loaded; call load() first")
        parts = []
        for stretch in dict.fromkeys(v.stretch for v in self._versions):
            own = [v for v in self._versions if v.stretch == stretch]
            rows = [
                F.struct(
                    F.lit(v.number).alias("version"),
                    F.lit(v.label).alias("label"),
                    F.count_if(F.col(_MARK) >= v.depth).alias("n_rows"),
                    F.lit(len(v.df.columns)).alias("n_cols"),
                    F.lit(v.created_at).alias("created_at"),
                )
                for v in own
            ]
            counted = own[-1].marked.select(_MARK).agg(F.array(*rows).alias("rows"))
            parts.append(counted.select(F.inline("rows")))
        return reduce(DataFrame.unionByName, parts)

    def diffs(self) -> DataFrame:
        """``version, label, rows_delta``: rows gained or lost against the version before.

        The window runs over the history, which has one row per version.
        """
        before = F.lag("n_rows").over(W.partitionBy(F.lit(0)).orderBy("version"))
        return self.history().select(
            "version", "label", F.coalesce(F.col("n_rows") - before, F.lit(0)).alias("rows_delta")
        )
