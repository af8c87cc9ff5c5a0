"""Repeated byte strings across documents, by merging Burrows-Wheeler transforms of text pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.batches import chunks, texts
from tabscope.llm.common import written

LENGTH = 200  # bytes of a repeated string
GRAM = 32  # bytes of the strings whose smallest digest names a window
REACH = 1 << 20  # places told apart in one stretch of a text
MERGE_BYTES = 1 << 20  # text merged at once; whole names only
HOT_BYTES = 4 << 20  # names with more text than this are counted by window instead
NONE = 0xFFFF  # stands for no pair of bytes; never occurs in UTF-8
ONE, TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def gram_digests(data: np.ndarray) -> np.ndarray:
    """A digest of the GRAM bytes from every place, built up by doubling."""
    x = data.astype(np.uint64)
    for shift in (1, 2, 4):
        x = x[:-shift] | (x[shift:] << np.uint64(8 * shift))
    x = x * ONE
    x ^= x >> np.uint64(32)
    for shift in (8, 16):
        x = x[:-shift] * TWO + x[shift:]
        x ^= x >> np.uint64(29)
        x *= ONE
    return x


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts the windows of a text into stretches: (start, number of windows, name).

    The windows of ``length`` bytes whose smallest gram digest is at the same place, the first one on
    ties, are a stretch, named by that digest. Equal windows have the same name, wherever they are, and
    two windows of one stretch are never equal. Very long texts are cut every REACH / 2
    windows as well, which only makes more stretches.
    """
    grams = length - GRAM + 1
    parts = []
    half = REACH // 2
    for base in range(0, len(raw) - length + 1, half):
        data = np.frombuffer(raw, np.uint8, min(len(raw) - base, half + length - 1), base)
        digests = gram_digests(data)
        places = np.arange(len(digests), dtype=np.uint64)
        low = sliding_minimum((digests & np.uint64(~(REACH - 1) & (2**64 - 1))) | places, grams)
        place = (low & np.uint64(REACH - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        parts.append((first + base, np.diff(np.r_[first, len(place)]), digests[place[first]]))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate([p[k] for p in parts]) for k in range(3))


def repeated_windows(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For every piece of text the starts of windows that occur elsewhere in the pieces.

    Merges the transforms of all pieces by refining their interleave. The suffixes of all pieces
    stand in the order of their first bytes, equal ones in one block. The symbols before them, read
    in this order, are the merged transform; dealing the suffixes out by these symbols, in a stable
    way, gives the order by that much more text. Where symbol or block changes a common prefix ends.
    A block of one suffix stays alone whatever precedes it and is dropped, so only what
    is still repeated is carried on. A symbol is a pair of bytes. After length / 2 rounds
    the blocks are the intervals of suffixes with ``length`` bytes in common. No
    suffixes are compared, and memory is a few words for each byte.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    gap = b"\xff\xff"  # keeps pieces apart
    data = np.frombuffer(gap + gap.join(pieces) + gap, np.uint8).astype(np.uint16)
    starts = 2 + np.cumsum(np.r_[0, sizes[:-1] + 2])
    symbol = data[:-1] * np.uint16(256) + data[1:]
    symbol[(data[:-1] == 0xFF) | (data[1:] == 0xFF)] = NONE
    order = np.flatnonzero(symbol != NONE).astype(np.int32)
    block = np.zeros(len(order), np.int32)
    before = symbol[order]
    for reached in range(2, length + 1, 2):
        if reached > 2:
            order = order - np.int32(2)
            before = symbol[order]
            whole = before != NONE
            order, block, before = order[whole], block[whole], before[whole]
        dealt = np.argsort(before, kind="stable")
        order, block, before = order[dealt], block[dealt], before[dealt]
        edge = np.ones(len(order) + 1, bool)
        edge[1:-1] = (before[1:] != before[:-1]) | (block[1:] != block[:-1])
        shared = ~(edge[:-1] & edge[1:])
        order, block = order[shared], np.cumsum(edge[:-1], dtype=np.int32)[shared]
    found = np.sort(order).astype(np.int64)
    cuts = np.searchsorted(found, np.r_[starts, len(data)])
    return [found[cuts[k] : cuts[k + 1]] - starts[k] for k in range(len(pieces))]


def runs(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of consecutive sorted places: first of each, and how many."""
    if not len(places):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.flatnonzero(np.r_[True, np.diff(places) > 1])
    return places[first], np.diff(np.r_[first, len(places)])


def marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, mark, text); id and mark, a digest of the text, name a document's text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def cut_up(docs: DataFrame, kind: str) -> DataFrame:
    """Rows (id, mark, start, windows, name, digest), one for each stretch of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in chunks(batches, "text", 1 << 19):
            parts, whose, digests = [], [], []
            for k, text in enumerate(texts(batch, "text")):
                raw = text.encode()
                if len(raw) < LENGTH:
                    continue
                found = stretches(raw)
                parts.append(found)
                whose.append(np.full(len(found[0]), k))
                more = LENGTH - 1
                digests += [digest(raw[a : a + n + more]) for a, n in zip(found[0].tolist(), found[1].tolist())]
            if not parts:
                continue
            owner = pa.array(np.concatenate(whose))
            start, count, name = (np.concatenate([p[k] for p in parts]) for k in range(3))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(owner), batch.column("mark").take(owner),
                    pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                    pa.array(name.view(np.int64)), pa.array(np.array(digests, np.uint64).view(np.int64)),
                ],
                ["id", "mark", "start", "windows", "name", "digest"],
            )

    return docs.mapInArrow(run, f"id {kind}, mark bigint, start int, windows int, name bigint, digest bigint")


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (name, digest, piece): the bytes of one stretch for every (name, digest) wanted."""
    lists = wanted.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "windows", "name", "digest")).alias("wanted"))
    lists = lists.toDF("_id", "_mark", "wanted")
    same = docs["id"].eqNullSafe(lists["_id"]) & (docs["mark"] == lists["_mark"])
    joined = docs.join(lists, same).select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            rows = []
            for text, wanted in zip(texts(batch, "text"), batch.column("wanted").to_pylist()):
                raw = text.encode()
                rows += [(w["name"], w["digest"], raw[w["start"] : w["start"] + w["windows"] + LENGTH - 1]) for w in wanted]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                ["name", "digest", "piece"],
            )

    return joined.mapInArrow(run, "name bigint, digest bigint, piece binary")


def merged(pieces: DataFrame) -> DataFrame:
    """Rows (name, digest, at, n): runs of repeated windows, found name by name.

    Pieces of one name meet in one task; names are merged together up to MERGE_BYTES of text, as
    windows of unlike names are never equal.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int, bytes]] = []
        held, last = 0, None
        for batch in batches:
            for name, digest, piece in zip(*(batch.column(c).to_pylist() for c in ("name", "digest", "piece"))):
                if name != last and held > MERGE_BYTES:
                    yield answer(rows)
                    rows, held = [], 0
                rows.append((name, digest, piece))
                held, last = held + len(piece), name
        if rows:
            yield answer(rows)

    def answer(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        at, n, owner = [], [], []
        for k, places in enumerate(repeated_windows([r[2] for r in rows])):
            first, count = runs(places)
            at.append(first)
            n.append(count)
            owner.append(np.full(len(first), k))
        who = np.concatenate(owner)
        names, digests = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        columns = [names[who], digests[who], np.concatenate(at).astype(np.int32), np.concatenate(n).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["name", "digest", "at", "n"])

    dealt = pieces.repartition("name").sortWithinPartitions("name", "digest")
    return dealt.mapInArrow(run, "name bigint, digest bigint, at int, n int")


def counted(pieces: DataFrame) -> DataFrame:
    """The same for names with very much text: every window is a row and equal ones are counted,
    which is spread over tasks by window and combined before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, digest, piece in zip(*(batch.column(c).to_pylist() for c in ("name", "digest", "piece"))):
                n = len(piece) - LENGTH + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, name)), pa.array(np.full(n, digest)), pa.array(np.arange(n, dtype=np.int32)),
                        pa.array([xxhash.xxh3_128_digest(piece[k : k + LENGTH]) for k in range(n)], pa.binary()),
                    ],
                    ["name", "digest", "at", "window"],
                )

    windows = written(pieces.mapInArrow(run, "name bigint, digest bigint, at int, window binary"), "bwt-windows")
    often = windows.groupBy("name", "window").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    return windows.join(often.select("name", "window"), ["name", "window"], "left_semi").select(
        "name", "digest", "at", F.lit(1).alias("n")
    )


def repeated_spans(docs: DataFrame, kind: str) -> DataFrame:
    """Rows (id, mark, spans): array of (start, end), the bytes of each text that are covered.

    docs: rows (id, mark, text).
    """
    rows = written(cut_up(docs, kind), "bwt-stretches")
    # equal stretches are combined before they are shuffled and before anything meets by name alone;
    # any one of them stands for the others
    classes = rows.groupBy("name", "digest").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("id", "mark", "start", "windows")]
    )
    classes = written(classes, "bwt-classes")
    per_name = classes.groupBy("name").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum(F.col("windows") + LENGTH - 1).alias("bytes")
    )
    unlike = written(per_name.where("kinds > 1").select("name", "bytes"), "bwt-names")
    wanted = classes.join(unlike.select("name"), "name", "left_semi")
    pieces = written(texts_of(docs, wanted), "bwt-pieces")
    hot = written(unlike.where(F.col("bytes") > HOT_BYTES).select("name"), "bwt-hot")
    parts = merged(pieces.join(hot, "name", "left_anti")).unionByName(counted(pieces.join(hot, "name", "left_semi")))
    parts = written(parts, "bwt-runs")
    every = classes.where("copies > 1").select("name", "digest", F.lit(0).alias("at"), F.col("windows").alias("n"))
    some = parts.join(every.select("name", "digest"), ["name", "digest"], "left_anti")
    hits = written(some.unionByName(every), "bwt-hits")
    found = rows.join(hits, ["name", "digest"]).select("id", "mark", (F.col("start") + F.col("at")).alias("first"), "n")
    return found.groupBy("id", "mark").agg(F.collect_list(F.struct("first", "n")).alias("found"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_bytes, spans, kept) for every document.

    ``spans`` are the maximal runs of bytes covered by a string of LENGTH bytes that also starts
    anywhere else, in the same document or another, judged on the input; ``kept`` holds the
    other bytes. Matches do not cross documents. Null and short texts lose nothing; repeated rows are
    copies of each other.

    1. The windows of each text are cut into stretches by a digest of their content, so
       that equal windows have the same name; names, digests and places are shuffled, not texts.
       Stretches that are equal as a whole are repeated; a name of one kind of stretch is done with.
    2. Where unlike stretches share a name, the text of one copy of each is fetched and
       the transforms of a name's pieces are merged to find the windows in common.
    3. The covered runs go to their documents, which are read and cut.
    Equal names and digests of 64 bits each are taken for equal stretches.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    source = marked(docs, id_col, text_col)
    spans = repeated_spans(source, kind).toDF("_id", "_mark", "found")
    spans = written(spans, "bwt-spans")
    same = source["id"].eqNullSafe(spans["_id"]) & (source["mark"] == spans["_mark"])
    joined = source.join(spans.hint("merge"), same, "left").select("id", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1 << 20):
            sizes, spans, kept = [], [], []
            for text, found in zip(texts(batch, "text"), batch.column("found").to_pylist()):
                raw = text.encode()
                sizes.append(len(raw))
                if not found:
                    spans.append([])
                    kept.append(raw)
                    continue
                covered = np.zeros(len(raw) + 1, np.int32)
                first = np.array([f["first"] for f in found])
                np.add.at(covered, first, 1)
                np.add.at(covered, first + np.array([f["n"] for f in found]) + LENGTH - 1, -1)
                gone = np.cumsum(covered[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False])).tolist()
                spans.append([{"start": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                ["id", "n_bytes", "spans", "kept"],
            )

    return joined.mapInArrow(run, f"id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
