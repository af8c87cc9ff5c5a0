"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.llm.common import written

# Slices of a source's shuffled order. A running sum is taken inside a slice and over the
# sums of the slices, so a source of any size is dealt to this many tasks.
SLICES = 4096
EPOCHS = 2


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = 1.5, epochs: int = EPOCHS) -> DataFrame:
    """Targets from rows (source, source_size, weight).

    The budget, ``share`` times all sizes, is dealt by weight; a target stops at ``epochs``
    times its source's size and the excess is dealt again by weight until none is above. In
    the end every source has the same level of words per weight, but for those that stop
    below it: in the order of the level at which they stop, a source stops if the budget less
    what the ones before it hold is too much for the weights that are left. From the first that
    does not stop on, these levels only fall, so the highest of them is the common one. One row per
    source goes through these windows.
    """
    stops = f"({epochs} * source_size)"
    order = Window.orderBy(F.expr(f"{stops} / weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    levels = sizes.select(
        "*",
        F.sum("source_size").over(everything).alias("all_size"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum(F.expr(stops)).over(before), F.lit(0)).alias("held"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("spent"),
    ).withColumn("level", F.expr(f"(all_size * {share}D - held) / (all_weight - spent)"))
    stopped = levels.withColumn("stops", F.expr(f"{stops} <= level * weight"))
    free = stopped.withColumn("free_level", F.max(F.expr("CASE WHEN NOT stops THEN level END")).over(everything))
    return free.selectExpr(
        "source", "source_size", "weight",
        f"CASE WHEN stops THEN double({stops}) ELSE free_level * weight END AS target",
    )


def cycle_weights(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """Gives the sources, by code point with null last, these weights in turn."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    picked = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    return sizes.withColumn("weight", picked)


def schedule(rows: DataFrame, targets: DataFrame, epochs: int = EPOCHS) -> DataFrame:
    """Every copy of every document with its virtual finish time.

    rows: (row, id, source, size), ``row`` a number of its own for each. targets: (source, source_size, target). Returns for each row and
    epoch the columns of both, ``epoch``, ``before`` (words of its source served before it, in the
    shuffled order, epoch after epoch), ``finish`` = (before + size) / target, and ``taken``:
    the words of the copy that are served by virtual time 1, when each source has had its target
    and the budget, their sum, is spent. All sources advance in proportion to their
    targets, so this is the truncation of the global order at the budget; the copy that a
    source has in service then is cut.

    The shuffle is by the digest of the id, then id and size, so reruns agree; rows alike in
    all of these and the source are interchangeable and follow each other by row number. Running sums are taken per source and slice of the digest's range, then over
    the slices: a source with a third of all rows is 4096 small windows.
    """
    # the first three hexadecimal digits number the 4096 slices in the order of the digest
    place = rows.withColumn("place", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    place = place.withColumn("slice", F.substring("place", 1, 3))
    slices = place.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    over_slices = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("offset", F.coalesce(F.sum("slice_size").over(over_slices), F.lit(0)))
    facts = slices.alias("s").join(
        targets.alias("t"), F.expr("s.source <=> t.source"), "inner"
    ).selectExpr("s.source AS of", "s.slice AS part", "s.offset", "t.source_size", "t.target")
    within = Window.partitionBy("source", "slice").orderBy("place", "id", "size", "row").rowsBetween(
        Window.unboundedPreceding, -1
    )
    inside = place.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    served = inside.join(facts, F.expr("source <=> of AND slice = part")).drop("of", "part")
    copies = served.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    copies = copies.withColumn("before", F.expr("epoch * source_size + offset + inside"))
    return copies.selectExpr(
        "row", "id", "source", "size", "source_size", "target", "place", "epoch", "before",
        "CASE WHEN target > 0 THEN (before + size) / target ELSE double('Infinity') END AS finish",
        "least(size, greatest(0L, bigint(floor(target)) - before)) AS taken",
    )


def in_order(copies: DataFrame) -> DataFrame:
    """The copies that the mix takes, sorted by virtual finish time over all partitions."""
    keys = ["finish", "source", "place", "id", "epoch", "row"]
    return copies.where("taken > 0").repartitionByRange(*keys).sortWithinPartitions(*keys)


def mix(
    docs: DataFrame,
    weigh=cycle_weights,
    share: float = 1.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Mixes documents: (copies, order).

    ``copies`` has one row per document and epoch (see ``schedule``), ``order`` the copies that
    are taken, in the order of their virtual finish times, which is the order of the mix.
    weigh: adds a column ``weight`` to the rows (source, source_size). Both tables name the input
    row by ``row``: a written number that differs for every row, taken from ``row_col`` if given.

    Null texts and empty ones have size 0 and are never taken; null is a source of its own;
    repeated rows are documents like any other; a table without words gives targets of 0. Texts
    are read once, to count their words; only (row, id, source, size) is moved.
    """
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = docs.select(
        row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size")
    )
    rows = written(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(weigh(sizes), share), "mix-targets")
    copies = schedule(rows, targets)
    return copies, in_order(copies)
