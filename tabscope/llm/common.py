"""Shared steps: tables in the shared folder, connected components, text helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, one below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/llm/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: a lost executor costs no
    recomputation, every reader sees the same rows, and the plan starts anew."""
    spark = df.sparkSession
    path = fresh_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str | Column) -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def draw(rows: DataFrame, group: str, limit: Column) -> DataFrame:
    """At most ``limit`` ids of each group, in the order of a digest of the id: rows (id, group).

    Ids are first thinned by their digest to about four times the limit, from the counted size of
    the group, so that ranking them is little work whatever the size. Groups are what a model tells
    apart, which holds figures for each of them anyway; their sizes, one row each, are broadcast, so that
    rows of a large group are thinned where they are read.
    """
    ids = rows.select("id", group)
    sizes = ids.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = ids.join(F.broadcast(sizes), group).withColumn("_limit", limit)
    few = few.where(place * F.col("_n") < F.col("_limit") * 4.0).select("id", group, "_limit").distinct()
    order = Window.partitionBy(group).orderBy(F.xxhash64("id"), "id")
    ranked = few.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= F.col("_limit")).select("id", group)


def components(edges: DataFrame, purpose: str = "links") -> DataFrame:
    """Connected components of undirected edges (a, b), as rows (node, component).

    ``component`` is the smallest node reachable. Alternates the two star operations: every
    node's larger neighbours are hung on its smallest neighbour, then its smaller ones, until
    nothing moves; the number of rounds grows with the logarithm of the longest chain. A round
    is two aggregates and two joins over at most as many rows as there are edges; minima are
    combined before the shuffle, so a node with very many neighbours is no hot task, and the
    joins are plain ones, which adaptive execution may split. Each round is written to the
    shared folder. Nodes without an edge are not returned.
    """
    pairs = edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
    pairs = written(pairs, purpose)
    state = None
    while (before := state) != (state := _state(pairs)):
        pairs = written(_star(_star(pairs, both=True), both=False), purpose)
        if not state[0]:
            break
    # every edge (a, b) now runs from a member to its component's smallest node
    return pairs.selectExpr("a AS node", "b AS component").unionByName(
        pairs.selectExpr("b AS node", "b AS component").distinct()
    )


def _state(pairs: DataFrame) -> tuple:
    """Number and digest of the rows, which are distinct; in any order."""
    digest = F.xxhash64("a", "b")
    row = pairs.agg(F.count(F.lit(1)), F.bit_xor(digest), F.sum(digest.cast("decimal(38,0)"))).first()
    return tuple(row)


def _star(pairs: DataFrame, both: bool) -> DataFrame:
    """One star operation over rows (a, b) with a > b.

    both: every neighbour counts and the larger ones are hung on the smallest of all
    (the node itself included); else the smaller neighbours and the node are.
    """
    if both:
        around = pairs.unionByName(pairs.selectExpr("b AS a", "a AS b"))
        low = around.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) AS m")
        hung = around.where("b > a").join(low, "a").selectExpr("b AS a", "m AS b")
    else:
        low = pairs.groupBy("a").agg(F.min("b").alias("m"))
        hung = pairs.join(low, "a").where("b <> m").selectExpr("b AS a", "m AS b")
        hung = hung.unionByName(low.selectExpr("a", "m AS b"))
    return hung.where("a > b").distinct()
