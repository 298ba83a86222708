"""Centroid clustering over a VA-file: exact k-means in whole numbers with interval bounds.

Vectors become whole numbers, and each is kept beside its approximation: every dimension's range
is cut into ``CELLS`` equal cells (six bits; with four, nearly all intervals overlap at 64
dimensions). For a set of centroids, tables give, for each cell, the least and the greatest squared
distance that its dimension can add. Summed they give an interval per centroid. A centroid whose least distance is over
another's greatest is out; where one centroid is left, the vector is assigned without being
looked at, and where intervals overlap the full vector is fetched and its exact distances to just
those centroids decide. All of it is integer arithmetic, so results do not depend on the order of
rows, partitions or machines.

The input is read three times (first centroids, ranges, cells), and the table of vectors is written
once with its cells. A round is one pass over it that shuffles one
row of sums per centroid and task; the centroids (``k`` rows, whatever the data) come to the driver
and go out with the next round's tasks. Spark reads a vector's columns together, so what the
approximation saves is arithmetic; a round's sums need every vector once.

Defined results: vectors take part that have exactly ``DIMS`` components, none null or non-finite;
null vectors and ids: a null id prints as nothing where ids are hashed; repeated rows each count;
rows of one id go by their vectors in array order; fewer vectors than ``k`` are all centroids; an
empty table gives an empty result; a component beyond 2**27 in whole numbers fails the job, since
its squared distance would not fit; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, saved

DIMS = 64
SCALE = 256
K = 40
ROUNDS = 5
#: Cells per dimension (six bits).
CELLS = 64
LIMIT = 1 << 27
#: Vectors whose intervals are computed at a time.
BATCH = 4_096


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * x) of the vectors that take part, as an array of int."""
    rows = pick(vectors, id_column, column).toDF("vec_id", "e").filter(F.size("e") == dims)
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    number = lambda x: F.floor(x.cast("double") * scale)
    fits = lambda x: F.abs(x.cast("double") * scale) <= float(LIMIT)
    beyond = F.raise_error(F.lit(f"a vector component is beyond {LIMIT // scale}")).cast("int")
    return rows.filter(finite).select("vec_id", F.transform("e", lambda x: F.when(fits(x), number(x).cast("int")).otherwise(beyond)).alias("v"))


def first_centroids(rows: DataFrame, k: int = K, seed: int = 2) -> np.ndarray:
    """The k vectors whose id's hash is smallest, in the order of the hashes: (at most k, dims)."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def ranges(rows: DataFrame, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Least value and cell width of every dimension, exact over all rows; a task sends one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dims, LIMIT), np.full(dims, -LIMIT)
        for batch in batches:
            if len(batch):
                v = _numbers(batch, dims)
                low, high = np.minimum(low, v.min(0)), np.maximum(high, v.max(0))
        yield pa.record_batch([pa.array([x.tolist()], pa.list_(pa.int64())) for x in (low, high)], ["low", "high"])

    found = rows.select("v").mapInArrow(run, "low array<long>, high array<long>").select(F.posexplode(F.arrays_zip("low", "high")).alias("d", "x"))
    ends = {r["d"]: r for r in found.groupBy("d").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high")).collect()}  # a row per dimension
    low, high = (np.array([ends[d][side] for d in range(dims)], np.int64) for side in ("low", "high"))
    return low, (high - low) // CELLS + 1


def cells_of(v: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Approximations of (n, dims) vectors: a cell number per dimension."""
    return ((v - low) // width).astype(np.uint8)


def interval_tables(centroids: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance by dimension, cell and centroid."""
    near = (low[:, None] + np.arange(CELLS) * width[:, None])[:, :, None]  # a cell holds near..far
    far = near + width[:, None, None] - 1
    at = centroids.T[:, None, :]
    least = np.maximum(np.maximum(near - at, at - far), 0) ** 2
    most = np.maximum(np.abs(near - at), np.abs(far - at)) ** 2
    return least, most


def nearest(v: np.ndarray, cells: np.ndarray, centroids: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """The nearest centroid of every vector (ties: the smaller number), and how many vectors were
    fetched because intervals overlapped."""
    n, k = len(v), len(centroids)
    least, most = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
    for d in range(cells.shape[1]):
        least += tables[0][d][cells[:, d]]
        most += tables[1][d][cells[:, d]]
    open_ = least <= most.min(1, keepdims=True)
    chosen = open_.argmax(1)
    unsure = np.flatnonzero(open_.sum(1) > 1)
    if len(unsure):
        exact = np.full((len(unsure), k), np.iinfo(np.int64).max)
        for c in range(k):
            own = np.flatnonzero(open_[unsure, c])
            exact[own, c] = ((v[unsure[own]] - centroids[c]) ** 2).sum(1)  # only these are fetched
        chosen[unsure] = exact.argmin(1)
    return chosen, len(unsure)


def _numbers(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The batch's vectors as (n, dims), a view of the batch."""
    column = batch.column("v")
    return column.flatten().to_numpy().reshape(len(column), dims)


def _approximations(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("cells").to_pylist()), np.uint8).reshape(len(batch), dims)


def approximated(rows: DataFrame, low: np.ndarray, width: np.ndarray, dims: int = DIMS) -> DataFrame:
    """The VA-file: (vec_id, v, cells), written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = cells_of(_numbers(batch, dims), low, width)
            yield pa.record_batch([batch.column("vec_id"), batch.column("v"), pa.array([r.tobytes() for r in packed], pa.binary())], ["vec_id", "v", "cells"])

    kind = dict(rows.dtypes)["vec_id"]
    return saved(rows.select("vec_id", "v").mapInArrow(run, f"vec_id {kind}, v array<int>, cells binary"))


def _assigner(centroids: np.ndarray, low: np.ndarray, width: np.ndarray):
    """Function from a batch to pieces of it with their vectors and chosen centroids, and one that
    makes the tables it needs."""
    dims = centroids.shape[1]

    def assign(batch: pa.RecordBatch, tables) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        for at in range(0, len(batch), BATCH):
            part = batch.slice(at, BATCH)
            v = _numbers(part, dims)
            yield part, v, nearest(v, _approximations(part, dims), centroids, tables)[0]

    return assign, lambda: interval_tables(centroids, low, width)


def next_centroids(table: DataFrame, centroids: np.ndarray, low: np.ndarray, width: np.ndarray) -> np.ndarray:
    """One round: floor(sum / count) of each centroid's vectors; empty ones stay."""
    dims = centroids.shape[1]
    assign, tables_of = _assigner(centroids, low, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of()
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, v, chosen in assign(batch, tables):
                order = np.argsort(chosen, kind="stable")
                found, starts, own = np.unique(chosen[order], return_index=True, return_counts=True)
                sums[found] += np.add.reduceat(v[order], starts, axis=0, dtype=np.int64)
                counts[found] += own
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(counts[some], pa.int64()), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = table.select("v", "cells").mapInArrow(run, "cluster int, n long, sums array<long>").select("cluster", "n", F.posexplode("sums").alias("d", "s"))
    # decimals: no sum of long numbers overflows
    totals = parts.groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s"))
    after = centroids.copy()
    for r in totals.collect():  # a number per centroid and dimension
        after[r["cluster"], r["d"]] = int(r["s"]) // r["n"]
    return after


def assigned(table: DataFrame, centroids: np.ndarray, low: np.ndarray, width: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector: its nearest centroid and the squared distance to it,
    written to the shared folder."""
    assign, tables_of = _assigner(centroids, low, width)
    kind = dict(table.dtypes)["vec_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tables_of()
        for batch in batches:
            for part, v, chosen in assign(batch, tables):
                distance = ((v - centroids[chosen]) ** 2).sum(1)
                yield pa.record_batch([part.column("vec_id"), pa.array(chosen, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return saved(table.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"))


def centroid_digest(centroid) -> str:
    """sha256 of a centroid's components, as decimals joined by commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: int = 2) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), centroids) after ``rounds`` rounds and one last assignment."""
    rows = whole_vectors(vectors, dims=dims, scale=scale)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    low, width = ranges(rows, dims)
    table = approximated(rows, low, width, dims)
    for _ in range(rounds):
        centroids = next_centroids(table, centroids, low, width)
    return assigned(table, centroids, low, width), centroids


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): distances summed over a
    vector's cluster and over all, and its centroid's digest."""
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows at most
    info = [(c, s, sum(sums.values()), centroid_digest(centroids[c])) for c, s in sorted(sums.items())]
    by_cluster = found.sparkSession.createDataFrame(info, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
