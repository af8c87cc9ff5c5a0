"""Order within a group without one task per group: ranges of the whole order, and what crosses them.

Rows are range-partitioned by group and order, so that a group of any size lies over as many
ranges as it needs. Window functions run inside (range, group); what a range needs from
before it is one row per range, put together by a small aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.columns import col
from tabscope.session import shared_dir

_RANGE, _TIE = "__range", "__tie"


def in_ranges(df: DataFrame, keys: Sequence[str], ranges: int | None = None) -> DataFrame:
    """The rows with the number of their range, written to the shared folder.

    Equal keys are told apart by their place in the input, so they may fall into several ranges
    too. Written, because every later step must see the same ranges: by default as many as the
    shuffle has partitions.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn(_TIE, F.monotonically_increasing_id())
    placed = placed.repartitionByRange(ranges, *[col(k) for k in keys], F.col(_TIE))
    path = shared_dir(spark, "ranges")
    placed.withColumn(_RANGE, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def _edges(placed: DataFrame, group: Sequence[str], order: Sequence[str], carried: Column, weight: Column) -> DataFrame:
    """One row per range: its first group, and from the range before it the last group, the value
    of its last row, and the weight of that group's rows up to there."""
    whole = F.struct(*[col(g) for g in group])
    place = F.struct(*[col(o) for o in order], F.col(_TIE))
    groups = placed.groupBy(_RANGE, *[col(g) for g in group]).agg(
        F.sum(weight).alias("n"), F.max(F.struct(place.alias("place"), carried.alias("value")))["value"].alias("value")
    )
    ranges = groups.groupBy(_RANGE).agg(
        F.min(whole).alias("first"),
        F.max(F.struct(whole.alias("group"), F.col("n"), F.col("value"))).alias("last"),
    )
    # one row per range from here on, a number that is a setting
    same = Window.partitionBy("last.group").orderBy(_RANGE)
    sums = ranges.withColumn("so_far", F.sum("last.n").over(same))
    before = Window.partitionBy(F.lit(0)).orderBy(_RANGE)
    sums = sums.withColumn("prior", F.lag(F.struct("last.group", "last.value", "so_far")).over(before))
    return sums.where(F.col("prior.group") == F.col("first")).select(
        _RANGE, F.col("first").alias("__group"), "prior.value", F.col("prior.so_far")
    )


def _with_edges(
    df: DataFrame, group: Sequence[str], order: Sequence[str], carried: Column, ranges: int | None, weight: Column | None = None
) -> tuple[DataFrame, Window]:
    placed = in_ranges(df, [*group, *order], ranges)
    edges = _edges(placed, group, order, carried, F.lit(1) if weight is None else weight).withColumnRenamed(_RANGE, "__at")
    own = F.struct(*[col(g) for g in group])
    joined = placed.join(F.broadcast(edges), (F.col(_RANGE) == F.col("__at")) & (own == F.col("__group")), "left")
    window = Window.partitionBy(_RANGE, *[col(g) for g in group]).orderBy(*[col(o) for o in order], _TIE)
    return joined, window


def lagged(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str, ranges: int | None = None
) -> DataFrame:
    """The rows with ``name``, the ``value`` of the row before in the group, null for its first row.

    Rows that are alike in ``order`` follow each other in the order of the input. A null is a group
    as any other, and comes first in the order.
    """
    joined, window = _with_edges(df, group, order, col(value), ranges)
    first = F.row_number().over(window) == 1
    before = F.when(first, F.col("value")).otherwise(F.lag(col(value)).over(window))
    return joined.withColumn("__before", before).select(*[col(c) for c in df.columns], F.col("__before").alias(name))


def numbered(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str, ranges: int | None = None
) -> DataFrame:
    """The rows with ``name``, their number in the group from 0 on, without gaps or repeats whatever the
    values of ``order`` are."""
    joined, window = _with_edges(df, group, order, F.lit(0), ranges)
    number = F.row_number().over(window) - 1 + F.coalesce(F.col("so_far"), F.lit(0))
    return joined.withColumn("__number", number.cast("bigint")).select(
        *[col(c) for c in df.columns], F.col("__number").alias(name)
    )


def running(
    df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, name: str, ranges: int | None = None
) -> DataFrame:
    """The rows with ``name``, the sum of the whole number ``value`` over the group up to the row itself."""
    joined, window = _with_edges(df, group, order, F.lit(0), ranges, col(value))
    own = F.sum(col(value)).over(window.rowsBetween(Window.unboundedPreceding, 0))
    total = own + F.coalesce(F.col("so_far"), F.lit(0))
    return joined.withColumn("__sum", total).select(*[col(c) for c in df.columns], F.col("__sum").alias(name))
