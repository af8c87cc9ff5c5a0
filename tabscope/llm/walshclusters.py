"""Clusters of vectors around centroids, found by a progressive search of Walsh-Hadamard coefficients."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.common import written

WIDTH = 64  # components of a vector, a power of two
SCALE = 64.0  # components are multiplied by it before they are rounded down
LARGEST = 1 << 27  # components beyond it, after scaling, count as it: squared distances then fit 64 bits
EXACT = 1 << 20  # up to here the coefficients' squared differences fit 64 bits as well
CLUSTERS = 16
ROUNDS = 3
SEED = 1
LEVELS = (4, 8, 16, 32, 64)  # coefficients that are known after each step of the search
BLOCK = 1 << 17  # pairs of vector and centroid that are held at a time


def sequency() -> np.ndarray:
    """The transform's rows by their number of sign changes: bit-reversed Gray code."""
    bits = WIDTH.bit_length() - 1
    gray = [k ^ (k >> 1) for k in range(WIDTH)]
    return np.array([int(f"{g:0{bits}b}"[::-1], 2) for g in gray])


ORDER = sequency()


def walsh(rows: np.ndarray) -> np.ndarray:
    """The integer Walsh-Hadamard transform of each row, coarse coefficients first. Squared distances
    of coefficients are WIDTH times those of the rows."""
    out, step = rows, 1
    while step < WIDTH:
        halves = out.reshape(len(out), -1, 2, step)
        out = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], 2).reshape(len(out), WIDTH)
        step *= 2
    return out[:, ORDER]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each vector, ties to the smaller number,
    and how many coefficients were compared.

    The coarsest coefficients are compared with all centroids; the one that looks nearest there is
    compared to the end, which bounds the least distance from above. Differences of finer
    coefficients are then added only for centroids whose sum so far is not over the bound. What
    was left out is strictly farther, and what is left has all its coefficients compared, so
    the result is exact.
    """
    kind = np.int64
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) > EXACT:
        kind = object  # Python's integers
    fine = walsh(centroids.astype(kind))
    found, distance, work = np.zeros(len(vectors), np.int64), np.zeros(len(vectors), np.int64), 0
    size = max(1, BLOCK // len(centroids))
    for start in range(0, len(vectors), size):
        own = walsh(vectors[start : start + size].astype(kind))
        n = len(own)
        first = LEVELS[0]
        gap = own[:, None, :first] - fine[None, :, :first]
        sums = (gap * gap).sum(2)
        guess = sums.argmin(1)
        gap = own[:, first:] - fine[guess, first:]
        bound = sums[np.arange(n), guess] + (gap * gap).sum(1)
        row, centre = np.nonzero(sums <= bound[:, None])
        left = sums[row, centre]
        work += n * len(fine) * first + n * (WIDTH - first)
        for done, level in zip(LEVELS, LEVELS[1:]):
            gap = own[row, done:level] - fine[centre, done:level]
            left = left + (gap * gap).sum(1)
            work += len(row) * (level - done)
            still = left <= bound[row]
            row, centre, left = row[still], centre[still], left[still]
        # rows are in order, and within a row the centroids
        ends = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        best = np.minimum.reduceat(left, ends)
        is_best = left == np.repeat(best, np.diff(np.r_[ends, len(row)]))
        chosen, places = row[is_best], centre[is_best]
        opening = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        found[start : start + n] = places[opening]
        distance[start : start + n] = (best // WIDTH).astype(np.int64)
    return found, distance, work


def _vectors(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def integers(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows (id, v): the vectors with exactly WIDTH components, all finite, as integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("v")
            whole = pc.fill_null(pc.equal(pc.list_value_length(vectors), WIDTH), False)
            batch = batch.filter(whole)
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, WIDTH)
            fine = np.isfinite(values).all(1)  # a null component reads as NaN
            with np.errstate(over="ignore"):
                scaled = np.clip(np.floor(values[fine] * SCALE), -LARGEST, LARGEST).astype(np.int32)
            offsets = pa.array(np.arange(len(scaled) + 1) * WIDTH, pa.int32())
            kept = pa.ListArray.from_arrays(offsets, pa.array(scaled.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id").filter(pa.array(fine)), kept], ["id", "v"])

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    return rows.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, v array<int>")


def start_centroids(vectors: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest digests of seed and id, in that order; equal ids by their values."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = vectors.select(F.sha2(key, 256).alias("place"), "v").orderBy("place", "v").limit(clusters)
    rows = first.collect()  # as many as there are clusters
    return np.array([r["v"] for r in rows], np.int64).reshape(-1, WIDTH)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: means of their vectors, rounded down; one without vectors stays.

    Tasks add up their vectors by centroid, so what is shuffled is one row of sums per task and
    centroid, and the driver gets one per centroid.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.zeros(len(centroids), np.int64)
        sums = np.zeros((len(centroids), WIDTH), np.int64)
        for batch in batches:
            rows = _vectors(batch.column("v"))
            found, _, _ = nearest(rows, centroids)
            number += np.bincount(found, minlength=len(centroids))
            for k in np.unique(found):
                sums[k] += rows[found == k].sum(0, dtype=np.int64)
        used = np.flatnonzero(number)
        offsets = pa.array(np.arange(len(used) + 1) * WIDTH, pa.int32())
        columns = [
            pa.array(used.astype(np.int32)),
            pa.array(number[used]),
            pa.ListArray.from_arrays(offsets, pa.array(sums[used].ravel())),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    parts = vectors.select("v").mapInArrow(run, "cluster int, n bigint, sums array<bigint>")
    sums = [F.sum(F.col("sums")[i].cast("decimal(20,0)")).alias(f"s{i}") for i in range(WIDTH)]
    after = centroids.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():  # one row per cluster
        after[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(WIDTH)]
    return after


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Rows (id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, distance, _ = nearest(_vectors(batch.column("v")), centroids)
            columns = [batch.column("id"), pa.array(found.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    kind = vectors.schema["id"].dataType.simpleString()
    return vectors.mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Clusters vectors; returns the vectors' rows and the clusters' rows.

    vectors: ``id, cluster, distance`` (squared, of the integer vectors). clusters: ``cluster,
    centroid, cluster_inertia, inertia``, one row per cluster in use.

    The integer vectors are written once to the shared folder and read in every round; the
    centroids, a few numbers, go to the tasks with the plan. All figures are sums of integers,
    which no order of rows or repeated task changes, and no vector is shuffled: clusters of any
    size are summed in the tasks.

    Vectors that are null, of another length, or hold a null or non-finite component are left
    out. Components beyond +-2**27 after scaling count as that. Repeated rows count as often
    as they stand there. With fewer vectors than ``clusters`` each starts one; of equal centroids
    the first gets the vectors and the others stay as they are. Without any vector both results are
    empty. Inertias over 2**63 - 1 are null. Columns other than the two are not read.
    """
    vectors = written(integers(df, id_col, vector_col), "walsh-vectors")
    centroids = start_centroids(vectors, clusters, seed)
    if not len(centroids):
        empty = vectors.selectExpr("id", "0 AS cluster", "0L AS distance").where("false")
        return empty, empty.selectExpr("cluster", "array(0L) AS centroid", "0L AS cluster_inertia", "0L AS inertia")
    for _ in range(rounds):
        centroids = moved(vectors, centroids)
    found = written(assigned(vectors, centroids), "walsh-assigned")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("own"))
    total = sums.agg(F.sum("own")).first()[0]
    rows = [(k, [int(x) for x in c]) for k, c in enumerate(centroids)]
    centres = df.sparkSession.createDataFrame(rows, "cluster int, centroid array<bigint>")
    inertia = F.lit(None if total is None or total >= 1 << 63 else int(total)).cast("bigint")
    about = centres.join(sums, "cluster").select(
        "cluster", "centroid", F.col("own").try_cast("bigint").alias("cluster_inertia"), inertia.alias("inertia")
    )
    return found, about
