"""Exact de-duplication against a persistent digest index."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm.common import fresh_path, text_of, written

BUCKETS = 64


class DigestIndex:
    """A table (digest, keep_id), one row per distinct text ever seen, bucketed and sorted by
    digest at a path of the caller's. It outlives the session: opening the same path again
    finds the earlier digests. Because it is bucketed, joins with it never shuffle it."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = "digest_index_" + hashlib.sha256(path.encode()).hexdigest()[:24]
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append(self, fresh: DataFrame) -> None:
        fresh.select("digest", "keep_id").repartition(self.buckets, "digest").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, digest): the SHA-256 of the text's UTF-8 bytes; null counts as empty."""
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text_of(text_col), 256)).alias("digest"))


def deduplicate(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Adds a batch of documents to the index and tells which of them stay.

    Returns one row per input row: id, digest, keep_id, group_size (rows of the batch with this
    text), kept. A text that the index knows keeps the id stored there, so no row of the batch
    stays; of texts new to it the largest id stays and is appended. Texts are read once, to
    digest them; all that follows moves 32-byte digests.

    Equal digests are combined before they are shuffled, and the new ones are found by a
    sort-merge anti-join that shuffles only this combined side. The rows then join their group
    through two written tables, so that adaptive execution can split a digest that very many
    rows share. A null id never stays over an id that is not null. Repeated rows (same id, same
    text) are members of their group like any other, and all of them are kept if the id is.
    An empty batch gives an empty result.
    """
    rows = written(digests(docs, id_col, text_col), "digests")
    groups = rows.groupBy("digest").agg(F.max("id").alias("last_id"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups, "digest-groups")
    fresh = groups.withColumnRenamed("last_id", "keep_id").join(
        index.read().hint("merge").select("digest"), "digest", "left_anti"
    )
    index.append(fresh)
    kept = groups.join(index.read().hint("merge"), "digest").select("digest", "keep_id", "group_size")
    kept = written(kept, "digest-kept")
    return rows.join(kept.hint("merge"), "digest").select(
        "id", "digest", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept")
    )


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder."""
    return DigestIndex(spark, fresh_path(spark, "digest-index"))


def keep_first_seen(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns they came with, one row per text.

    The join is by (id, digest); rows repeated as a whole leave one, found in the join's own
    partitioning.
    """
    stays = deduplicate(docs, index, id_col, text_col).where("kept").select("id", "digest").distinct()
    stays = written(stays, "digest-stays").toDF("__llm_id", "__llm_digest")
    own = docs.withColumns(
        {"__llm_id": F.col(id_col), "__llm_digest": F.unhex(F.sha2(text_of(text_col), 256))}
    )
    same = own["__llm_id"].eqNullSafe(stays["__llm_id"]) & (own["__llm_digest"] == stays["__llm_digest"])
    found = own.join(stays.hint("merge"), same, "left_semi")
    return found.dropDuplicates(["__llm_id", "__llm_digest"]).drop("__llm_id", "__llm_digest")
