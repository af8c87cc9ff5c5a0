"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import components, written
from tabscope.llm.pairing import BLOCK, Links, deal, gathered, hot_keys, neighbours, pieces

TABLES = 8
FACTORS = 2  # cross-polytopes that make up one bucket
PROBES = 3  # buckets of a table that a vector is put in
SEED = 20_240
PAIRS = 1 << 12  # pairs that are compared at once


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of every row; the width is a power of two."""
    width, half = rows.shape[1], 1
    while half < width:
        cut = rows.reshape(len(rows), -1, 2, half)
        rows = np.concatenate([cut[:, :, :1] + cut[:, :, 1:], cut[:, :, :1] - cut[:, :, 1:]], axis=2).reshape(len(rows), width)
        half *= 2
    return rows / np.sqrt(width)


def buckets(vectors: np.ndarray, tables: int = TABLES, factors: int = FACTORS, probes: int = PROBES) -> np.ndarray:
    """Bucket numbers of unit vectors, rows by tables by probes.

    Each factor rotates by three rounds of random signs and the Hadamard transform and
    takes the nearest corner of the cross-polytope: the largest coordinate and its sign. The further
    probes swap the corner of one factor for its second nearest, the closest call first.
    """
    count, dims = vectors.shape
    width = 1 << max(1, (dims - 1).bit_length())
    padded = np.zeros((count, width))
    padded[:, :dims] = vectors
    random = np.random.default_rng([SEED, dims])
    found = np.empty((count, tables, probes), np.int64)
    for table in range(tables):
        corners, gaps = [], []
        for _ in range(factors):
            turned = padded
            for _ in range(3):
                turned = hadamard(turned * random.choice([-1.0, 1.0], width))
            size = np.abs(turned)
            near = np.argpartition(-size, 1, axis=1)[:, :2]
            order = np.argsort(-np.take_along_axis(size, near, 1), axis=1, kind="stable")
            near = np.take_along_axis(near, order, 1)
            sizes = np.take_along_axis(size, near, 1)
            corners.append(2 * near + (np.take_along_axis(turned, near, 1) < 0))
            gaps.append(sizes[:, 0] - sizes[:, 1])
        home = np.zeros(count, np.int64)
        for corner in corners:
            home = home * (2 * width) + corner[:, 0]
        base = np.int64(table) * (2 * width) ** factors
        found[:, table, 0] = base + home
        swapped = []
        for k, corner in enumerate(corners):
            scale = (2 * width) ** (factors - 1 - k)
            swapped.append(home + (corner[:, 1] - corner[:, 0]) * scale)
        closest = np.argsort(np.array(gaps), axis=0, kind="stable")
        swapped = np.array(swapped)
        for probe in range(1, probes):
            found[:, table, probe] = base + np.take_along_axis(swapped, closest[probe - 1 : probe], 0)[0]
    return found


VALID = (
    "{0} IS NOT NULL AND size({0}) > 0 AND forall({0}, x -> x IS NOT NULL AND NOT isnan(x) "
    "AND abs(x) < double('Infinity')) AND exists({0}, x -> x <> 0)"
)


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)  # no square overflows
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def layout(dims: int) -> tuple[int, int, np.dtype]:
    """Of vectors this long: the padded width, the coordinates of a sketch, the type of a bucket number."""
    width = 1 << max(1, (dims - 1).bit_length())
    numbers = (2 * width) ** FACTORS
    return width, width // 2, np.dtype(np.uint16 if numbers <= 1 << 16 else np.uint32 if numbers <= 1 << 32 else np.int64)


def marks(vectors: np.ndarray, found: np.ndarray) -> list[bytes]:
    """What the screening needs of unit vectors and their buckets, as bytes.

    A further rotation of the vector, of which half of the coordinates are kept to a byte each: their scale, the
    length of the rest, the coordinates. Then the numbers of the buckets inside their tables.
    """
    count, dims = vectors.shape
    width, kept, kind = layout(dims)
    padded = np.zeros((count, width))
    padded[:, :dims] = vectors
    part = hadamard(padded * np.random.default_rng([SEED, dims, 1]).choice([-1.0, 1.0], width))[:, :kept]
    up = np.float32(np.inf)
    scale = np.nextafter(np.maximum(np.abs(part).max(1), 1e-6).astype(np.float32), up)
    rest = np.nextafter((np.sqrt(np.maximum(0, 1 - (part * part).sum(1))) + 1e-7).astype(np.float32), up)
    levels = np.rint(part / scale[:, None].astype(np.float64) * 127).astype(np.int8)
    base = np.arange(found.shape[1], dtype=np.int64)[None, :, None] * (2 * width) ** FACTORS
    own = (found - base).astype(kind).reshape(count, -1)
    whole = [scale[:, None].view(np.uint8), rest[:, None].view(np.uint8), levels.view(np.uint8), own.view(np.uint8)]
    return [row.tobytes() for row in np.concatenate(whole, axis=1)]


class Marks:
    """The marks of rows with vectors of one length, read back."""

    def __init__(self, packed: list[bytes], dims: int):
        width, kept, kind = layout(dims)
        rows = np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)
        self.scale, self.rest = (rows[:, k : k + 4].copy().view(np.float32)[:, 0].astype(np.float64) for k in (0, 4))
        self.levels = rows[:, 8 : 8 + kept].view(np.int8).astype(np.float32)
        own = rows[:, 8 + kept :].copy().view(kind).astype(np.int64).reshape(len(rows), TABLES, PROBES)
        self.own = own + np.arange(TABLES, dtype=np.int64)[None, :, None] * (2 * width) ** FACTORS
        self.off = np.sqrt(kept) / 2 * self.scale / 127  # rounding moved the kept part no further than this

    def highest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """No cosine is above this: that of the rounded parts, what rounding and the rest may add."""
        near = (self.levels[a] * self.levels[b]).sum(1) * self.scale[a] * self.scale[b] / 127**2
        off_a, off_b = self.off[a], self.off[b]
        return near + self.rest[a] * self.rest[b] + off_a + off_b + 3 * off_a * off_b + 1e-5

    def first_shared(self, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether the bucket at ``place`` of ``a`` is the lowest that both are in."""
        shared = (self.own[a][:, :, :, None] == self.own[b][:, :, None, :]).any(3)
        lowest = np.where(shared, self.own[a], np.iinfo(np.int64).max).min((1, 2))
        return lowest == self.own[a, place[a] // PROBES, place[a] % PROBES]


def hashed(classes: DataFrame) -> DataFrame:
    """Adds ``buckets`` and ``marks`` to rows (rep, n, dims, vector); vectors of unlike length never meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                some = batch.slice(start, 2048)
                dims = some.column("dims").to_numpy()
                found, packed = np.empty((len(dims), TABLES * PROBES), np.int64), np.empty(len(dims), object)
                for d in np.unique(dims):
                    own = np.flatnonzero(dims == d)
                    vectors = unit(matrix(some.column("vector").take(pa.array(own)), int(d)))
                    numbers = buckets(vectors)
                    found[own] = numbers.reshape(len(own), -1)
                    packed[own] = marks(vectors, numbers)
                lists = pa.ListArray.from_arrays(np.arange(0, found.size + 1, TABLES * PROBES, dtype=np.int32), found.ravel())
                columns = [*some.columns, lists, pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, [*some.schema.names, "buckets", "marks"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    return classes.mapInArrow(run, f"{schema}, buckets array<bigint>, marks binary")


def _pairs(rows: pa.Table, piece: np.ndarray) -> Iterator[tuple[np.ndarray, Marks, np.ndarray, np.ndarray]]:
    """Pairs of rows to compare, a bounded number at a time, length by length: the rows, their marks, both sides."""
    dims = rows.column("dims").to_numpy()
    for d in np.unique(dims):
        at = np.flatnonzero(dims == d)
        some = rows.take(pa.array(at))
        read = Marks(some.column("marks").to_pylist(), int(d))
        sides = [some.column(c).to_numpy() for c in ("first", "second", "side")]
        for left, right in neighbours(piece[at], *sides):
            for k in range(0, len(left), PAIRS):
                yield at, read, left[k : k + PAIRS], right[k : k + PAIRS]


def screen(entries: DataFrame, cosine: float) -> DataFrame:
    """The rows of dealt buckets that may have a link there, by their marks alone.

    A row stays if the bound on its cosine with another row to be compared reaches ``cosine`` and this is
    the first bucket that both are in. Marks leave without being needed again, so only rows (key, first,
    second, side, rep, place) go on.
    """
    columns = ["key", "first", "second", "side", "rep", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, piece in pieces(batches, "key"):
            place, stay = rows.column("place").to_numpy(), np.zeros(rows.num_rows, bool)
            for at, read, a, b in _pairs(rows, piece):
                close = read.highest(a, b) >= cosine
                a, b = a[close], b[close]
                mine = read.first_shared(a, b, place[at])
                stay[at[a[mine]]] = stay[at[b[mine]]] = True
            yield from rows.select(columns).filter(pa.array(stay)).to_batches()

    return entries.mapInArrow(run, "key bigint, first int, second int, side int, rep bigint, place int")


def compare(entries: DataFrame, cosine: float) -> DataFrame:
    """Verifies the pairs of every bucket: rows (node, other, n).

    A pair that meets in several buckets counts in the first that both are in, by table and
    number. A row with ``other`` null adds ``n`` to the links of its node, the copies that
    stand behind the vectors on the other side; a row with ``other`` is an edge of a forest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, piece in pieces(batches, "key"):
            rep, n, place = (rows.column(c).to_numpy() for c in ("rep", "n", "place"))
            counts, forest = np.zeros(len(rep), np.int64), Links(len(rep))
            lengths, units, held = rows.column("dims").to_numpy(), np.empty((0, 0)), None
            for at, read, a, b in _pairs(rows, piece):
                if held is not read:
                    units = unit(matrix(rows.column("vector").take(pa.array(at)), int(lengths[at[0]])))
                    held = read
                close = (units[a] * units[b]).sum(1) >= cosine
                a, b = a[close], b[close]
                mine = read.first_shared(a, b, place[at])
                a, b = at[a[mine]], at[b[mine]]
                np.add.at(counts, a, n[b])
                np.add.at(counts, b, n[a])
                forest.add(a, b)
            child, parent = forest.forest()
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([rep[some], rep[child]])),
                    pa.array(np.concatenate([rep[some], rep[parent]]), mask=np.arange(len(some) + len(child)) < len(some)),
                    pa.array(np.concatenate([counts[some], np.zeros(len(child), np.int64)])),
                ],
                ["node", "other", "n"],
            )

    return entries.mapInArrow(run, "node bigint, other bigint, n bigint")


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """Rows (id, n_links, component_id, kept) for vectors linked at ``cosine`` or more.

    Equal vectors are one class, represented by its smallest id, so copies cost nothing and
    are linked with each other. Vectors that are null, empty, zero, or hold null or non-finite
    components link with nothing, and are their own component; so do rows with a null id.
    Candidates are vectors that share one of the buckets of their PROBES in one of TABLES tables;
    every candidate pair is verified in double precision, so no link is wrong, and a link is
    missed only if the pair shares no bucket. A bucket with many vectors is compared in blocks by
    several tasks; per bucket at most two rows a vector come back, however many links there are.
    What meets in every bucket is not the vector but its marks, about a byte for every two components;
    they bound the cosine from above, and only rows that may have a link in a bucket meet there as vectors.
    Repeated rows are copies, whatever their ids; ties at ``cosine`` are links; other columns are not
    read; a table without rows gives none. A vector of any length is one row.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    valid = F.expr("id IS NOT NULL AND " + VALID.format("vector"))
    # equal as vectors: one sign of zero
    plain = F.expr("transform(vector, x -> CASE WHEN x = 0 THEN x * 0 + 0 ELSE x END)")
    rows = rows.withColumn("vector", F.when(valid, plain))
    good = rows.where("vector IS NOT NULL")
    classes = good.groupBy("vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))
    classes = classes.select(F.col("rep").cast("bigint").alias("rep"), "n", F.size("vector").alias("dims"), "vector")
    table = written(hashed(classes), "vector-buckets")
    entries = table.select("rep", "dims", "marks", F.posexplode("buckets").alias("place", "bucket"))
    entries = entries.withColumn("key", F.xxhash64("dims", "bucket")).drop("bucket")
    hot = written(hot_keys(entries, "key", BLOCK), "vector-hot")
    near = written(screen(deal(entries, "key", "rep", BLOCK, hot), cosine), "vector-screened")
    meeting = gathered(near.join(table.select("rep", "n", "dims", "vector", "marks"), "rep"), "key", "rep")
    found = written(compare(meeting, cosine), "vector-links")
    linked = found.where("other IS NULL").groupBy("node").agg(F.sum("n").alias("links"))
    groups = components(found.where("other IS NOT NULL").selectExpr("node AS a", "other AS b"), "vector-components")
    named = table.select("rep", "n", "vector").join(linked.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select(
        "vector",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    named = written(named, "vector-names")
    known = rows.where("vector IS NOT NULL").join(named.hint("merge"), "vector").select("id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = known.unionByName(alone)
    return both.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
