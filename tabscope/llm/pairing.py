"""Comparing the rows of buckets: hot buckets are dealt in blocks, tasks return spanning links."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 2048  # rows of a bucket that are compared in one piece


def hot_keys(rows: DataFrame, key: str, limit: int = BLOCK) -> DataFrame:
    """The buckets of more than ``limit`` rows and the blocks they are cut into, by partial sums."""
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    return hot.select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_blocks"))


def deal(rows: DataFrame, key: str, member: str, limit: int = BLOCK, hot: DataFrame | None = None) -> DataFrame:
    """Brings the rows of each bucket together, in pieces of about two blocks at most.

    A bucket of more than ``limit`` rows is cut into blocks by a digest of the member, and every
    pair of blocks becomes a piece of its own (first, second); each row goes to the pieces of its
    block, marked by ``side``. Two rows of a bucket meet in exactly one piece, or with both rows on
    the same side and ``first`` unlike ``second``, where they are not to be compared. The other buckets
    are one piece (0, 0). Sizes are counted with partial sums; the join with the
    hot buckets is left to the optimizer, which knows their size where ``hot`` gives them as a
    written table, and then moves the rows once. No row is dropped.
    """
    hot = hot_keys(rows, key, limit) if hot is None else hot
    zero = F.lit(0)
    cold = rows.join(hot, key, "left_anti").withColumns({"first": zero, "second": zero, "side": zero})
    cut = rows.join(hot, key).withColumn("_own", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cut = cut.withColumns(
        {
            "first": F.least("_own", "_other"),
            "second": F.greatest("_own", "_other"),
            "side": (F.col("_own") > F.col("_other")).cast("int"),
        }
    ).drop("_blocks", "_own", "_other")
    return gathered(cold.unionByName(cut), key, member)


def gathered(rows: DataFrame, key: str, member: str) -> DataFrame:
    """Dealt rows, or some of them, brought together by their pieces."""
    piece = [key, "first", "second"]
    return rows.repartition(*piece).sortWithinPartitions(*piece, member)


def pieces(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole pieces out of sorted batches, and a number for the piece of each row."""
    waiting: pa.Table | None = None
    for batch in batches:
        here = pa.Table.from_batches([batch])
        waiting = here if waiting is None else pa.concat_tables([waiting, here])
        new = _changes(waiting, key)
        last = int(np.flatnonzero(new)[-1]) if new.any() else 0
        if last:
            yield waiting.slice(0, last), np.cumsum(new[:last])
            waiting = waiting.slice(last)
    if waiting is not None and waiting.num_rows:
        yield waiting, np.cumsum(_changes(waiting, key))


def _changes(rows: pa.Table, key: str) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    for name in (key, "first", "second"):
        values = rows.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return new


def neighbours(piece: np.ndarray, first: np.ndarray, second: np.ndarray, side: np.ndarray):
    """All pairs of rows to compare, as arrays of row numbers, distance by distance in the order."""
    left = np.arange(len(piece))
    for step in range(1, len(piece)):
        left = left[left + step < len(piece)]
        left = left[piece[left] == piece[left + step]]
        if not len(left):
            return
        right = left + step
        apart = (first[left] == second[left]) | (side[left] != side[right])
        yield left[apart], right[apart]


class Links:
    """Collects pairs of rows and keeps, in bounded memory, a forest that links the same rows."""

    def __init__(self, size: int):
        self.size, self.pending, self.count = size, [], 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        self.pending.append((left, right))
        self.count += len(left)
        if self.count > 4 * self.size + 1_000_000:
            self._reduce()

    def _reduce(self) -> np.ndarray:
        label = np.arange(self.size)
        if self.pending:
            left = np.concatenate([a for a, _ in self.pending])
            right = np.concatenate([b for _, b in self.pending])
            while True:
                low = np.minimum(label[left], label[right])
                before = label.copy()
                np.minimum.at(label, left, low)
                np.minimum.at(label, right, low)
                np.minimum.at(label, before[left], low)
                np.minimum.at(label, before[right], low)
                label = label[label]
                if np.array_equal(label, before):
                    break
        moved = np.flatnonzero(label != np.arange(self.size))
        self.pending, self.count = [(moved, label[moved])], len(moved)
        return label

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows that are not the first of their group, and that first row."""
        self._reduce()
        return self.pending[0]
