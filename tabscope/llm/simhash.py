"""Near-duplicate documents by SimHash fingerprints and an inverted index of their bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.batches import chunks, texts
from tabscope.llm.common import components, written
from tabscope.llm.pairing import Links, deal, neighbours, pieces

SHINGLE = 4
SEED = 42
BITS = 4  # two fingerprints link at so many differing bits at most
SHARED = 8 - BITS  # bytes that such fingerprints share at least, each at its position


def fingerprint(text: str, words: int = SHINGLE) -> int:
    """The 64-bit SimHash of the text's word shingles; 0 without words.

    A-Z are lower-cased, words end at ASCII white space. Every shingle, repeats included, is
    hashed with XXH64; a bit is set if it is in over half the hashes. A text shorter than
    a shingle is one.
    """
    found = text.encode().lower().split()
    if not found:
        return 0
    joined, hashed = b" ".join(found), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    last = ends[min(words, len(found)) - 1 :]
    counts = np.zeros(64, np.int64)
    spans = list(zip(starts[:n].tolist(), last.tolist()))
    for k in range(0, n, 1 << 16):
        some = np.array([hashed(joined[a:b], SEED) for a, b in spans[k : k + (1 << 16)]], ">u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """Rows (id, fp) for whole texts, null as empty; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            found = np.array([fingerprint(t, words) for t in texts(batch, "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.selectExpr(f"`{id_col}` AS id", f"`{text_col}` AS text")
    return rows.mapInArrow(run, f"id {kind}, fp bigint")


def index_positions() -> list[tuple[int, int, int]]:
    """Byte positions, three at a time, such that any four of the eight hold one of the threes.

    The positions are dealt to three groups in a ring; a three is taken if it lies in one
    group, or has two in a group and one in the next.
    """
    group = [p * 3 // 8 for p in range(8)]

    def taken(three: tuple[int, ...]) -> bool:
        counts = [sum(group[p] == g for p in three) for g in range(3)]
        return 3 in counts or any(counts[g] == 2 and counts[(g + 1) % 3] == 1 for g in range(3))

    return [three for three in combinations(range(8), 3) if taken(three)]


def postings(fps: DataFrame) -> DataFrame:
    """The inverted index: rows (key, fp) with the three bytes at each of the index's positions."""
    entries = []
    for number, three in enumerate(index_positions()):
        mask = sum(0xFF << (8 * p) for p in three)
        signed = mask - (1 << 64) if mask >> 63 else mask
        entries.append(F.xxhash64(F.lit(number), F.col("fp").bitwiseAND(F.lit(signed))))
    return fps.select(F.explode(F.array(*entries)).alias("key"), "fp")


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) that link distinct fingerprints as all pairs at BITS bits or fewer do.

    At most BITS bytes of such a pair differ, so that it shares at least SHARED positional bytes, and
    with them a posting. In each posting the shared positional bytes of every pair are
    tallied, pairs that reach SHARED are kept and their differing bits counted. A posting
    returns a forest, at most one edge for each of its fingerprints.
    """
    dealt = deal(postings(fps), "key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, piece in pieces(batches, "key"):
            fp = rows.column("fp").to_numpy()
            sides = [rows.column(c).to_numpy() for c in ("first", "second", "side")]
            found = Links(len(fp))
            for left, right in neighbours(piece, *sides):
                differing = (fp[left] ^ fp[right]).view(np.uint64)
                tally = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(1)
                near = np.flatnonzero(tally >= SHARED)
                near = near[np.bitwise_count(differing[near]) <= BITS]
                found.add(left[near], right[near])
            a, b = found.forest()
            yield pa.RecordBatch.from_arrays([pa.array(fp[a]), pa.array(fp[b])], ["a", "b"])

    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """Rows (id, fp, component_id): the smallest id reachable over links, itself included.

    Equal fingerprints are one class, so copies cost nothing; zero fingerprints are linked
    like any other. Each document's fingerprint is written once and shuffled as two longs; all else
    works on distinct fingerprints. Null ids come last among the ids of a class.
    """
    rows = written(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "fingerprint-classes")
    found = components(links(classes.select("fp")), "fingerprint-links")
    groups = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    groups = written(groups.withColumn("component", F.coalesce("component", "fp")), "fingerprint-groups")
    lowest = groups.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = written(groups.join(lowest, "component").select("fp", "component_id"), "fingerprint-names")
    return rows.join(named.hint("merge"), "fp").select("id", "fp", "component_id")
