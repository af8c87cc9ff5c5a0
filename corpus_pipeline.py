"""A pipeline over documents: language, copies, near copies, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the documents of the next. All but the last return the columns that came in.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm import bpe, exactdedup, langid, mixing, simhash
from tabscope.llm.common import written
from tabscope.llm.queries import language_model

KEY = "__llm_key"  # columns of our own, named so that they clash with none
ROW = "__llm_row"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is found: null texts and texts without a letter.

    The model is learned from the documents that came in; documents found to be in another
    language than they are labelled with stay. Without any labelled document there is no
    language to find, and the texts with a letter stay.
    """
    model = language_model(docs)
    if not model.languages:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify_rows(docs, model, KEY)
    return found.where(F.col(KEY) != langid.UNKNOWN).drop(KEY)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of equal texts the document with the largest id, once."""
    return exactdedup.keep_first_seen(docs, exactdedup.new_index(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest id.

    Documents that share an id are told apart by a digest of their texts.
    """
    keyed = docs.withColumn(KEY, F.struct("doc_id", F.xxhash64("text")))
    found = simhash.near_duplicates(keyed, KEY)
    stays = found.where(F.col("id") == F.col("component_id")).select(F.col("id").alias("_stays")).distinct()
    stays = written(stays, "near-stays")
    return keyed.join(stays.hint("merge"), keyed[KEY] == stays["_stays"], "left_semi").drop(KEY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for every time it takes them, whole or in part,
    sorted by their virtual finish times."""
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(F.xxhash64("text", "source")))
    keyed = written(docs.withColumn(ROW, F.monotonically_increasing_id()), "mix-rows").withColumn(KEY, key)
    _, order = mixing.mix(keyed, id_col=KEY, row_col=ROW)
    taken = order.select(F.col("row").alias("_taken"), F.col("finish").alias("_finish"), F.col("epoch").alias("_epoch"))
    copies = keyed.alias("d").join(taken.hint("merge").alias("t"), F.col(f"d.{ROW}") == F.col("t._taken"))
    keys = [F.col("t._finish"), F.col(f"d.{KEY}"), F.col("t._epoch"), F.col(f"d.{ROW}")]
    ordered = copies.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ordered.select(*[F.col("d.`" + c.replace("`", "``") + "`") for c in docs.columns])


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and a digest of what they decode to: rows (doc_id,
    n_tokens, ids, decoded_sha256)."""
    coded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", tokenize),
]

# hashing of shingles, the language model and merging are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
