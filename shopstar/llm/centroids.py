"""Centroid clustering in whole numbers, with a Walsh-Hadamard progressive search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from shopstar.llm.tables import Spool

# Fixed by the query contract.
SIZE = 64
UNITS = 256

# Beyond this a squared distance of transformed vectors may not fit 64 bits.
LIMIT = 1 << 16


@dataclass(frozen=True)
class Clustering:
    """levels: number of coefficients summed up before each elimination; the last is all of them."""

    clusters: int = 40
    rounds: int = 5
    seed: str = "2"
    levels: tuple[int, ...] = (4, 8, 16, 32, 64)
    slice_rows: int = 2048


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of every row, exact in whole numbers."""
    width = 1
    while width < SIZE:
        pairs = x.reshape(len(x), SIZE // (2 * width), 2, width)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), SIZE)
        width *= 2
    return x


def coarse_first() -> np.ndarray:
    """Order of the coefficients by the sign changes of their rows, few first."""
    rows = hadamard(np.eye(SIZE, dtype=np.int64))
    return np.argsort((np.diff(rows, axis=1) != 0).sum(1), kind="stable")


def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, coefs) of the vectors that are kept."""
    order = coarse_first()
    for batch in batches:
        vectors = batch.column("embedding")
        right = pa.compute.fill_null(pa.compute.equal(pa.compute.list_value_length(vectors), SIZE), False)
        batch = batch.filter(right)
        flat = batch.column("embedding").flatten()
        x = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, SIZE)
        fits = (np.abs(x) < LIMIT).all(1)  # false for what is not a number, too
        whole = np.floor(UNITS * x[fits]).astype(np.int64)
        coefs = hadamard(whole)[:, order].astype(np.int32)
        offsets = pa.array(np.arange(len(coefs) + 1, dtype=np.int32) * SIZE)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id").filter(pa.array(fits)), pa.ListArray.from_arrays(offsets, pa.array(coefs.ravel()))],
            ["vec_id", "coefs"])


def nearest(x: np.ndarray, centers: np.ndarray, levels: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Cluster and squared distance of every row, from transformed rows and centroids.

    The squared difference over some coefficients never exceeds that over all, which
    is SIZE times the distance. The centroid that is best on the coarse ones bounds
    the distance; those whose sum has passed the bound are strictly worse and go. The
    rest is summed up to all coefficients; of equal ones the smallest number wins.
    """
    first = levels[0]
    lower = ((x[:, None, :first] - centers[None, :, :first]) ** 2).sum(2)
    bound = ((x - centers[lower.argmin(1)]) ** 2).sum(1)
    row, center = np.nonzero(lower <= bound[:, None])
    part = lower[row, center]
    for done, upto in zip(levels, levels[1:], strict=False):
        part = part + ((x[row, done:upto] - centers[center, done:upto]) ** 2).sum(1)
        left = part <= bound[row]
        row, center, part = row[left], center[left], part[left]
    best = np.minimum.reduceat(part, np.searchsorted(row, np.arange(len(x))))
    hits = np.flatnonzero(part == best[row])
    winner = hits[np.unique(row[hits], return_index=True)[1]]
    return center[winner].astype(np.int32), best // SIZE


def rows_of(batch: pa.RecordBatch, slice_rows: int) -> Iterator[tuple[int, np.ndarray]]:
    """Positions and transformed vectors of a batch, some rows at a time."""
    flat = batch.column("coefs").flatten().to_numpy(zero_copy_only=False)
    x = flat.reshape(-1, SIZE)
    for at in range(0, len(x), slice_rows):
        yield at, x[at:at + slice_rows].astype(np.int64)


def sum_clusters(centers: np.ndarray, rule: Clustering):
    """Per task the number of vectors and the sum of every coefficient, by nearest centroid."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centers), np.int64)
        sums = np.zeros((len(centers), SIZE), np.int64)
        for batch in batches:
            for _, x in rows_of(batch, rule.slice_rows):
                cluster, _ = nearest(x, centers, rule.levels)
                n += np.bincount(cluster, minlength=len(centers))
                np.add.at(sums, cluster, x)
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(met, SIZE).astype(np.int32)), pa.array(np.tile(np.arange(SIZE, dtype=np.int32), len(met))),
             pa.array(np.repeat(n[met], SIZE)), pa.array(sums[met].ravel())],
            ["cluster", "place", "n", "total"])

    return work


def assigned(centers: np.ndarray, rule: Clustering):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(x, centers, rule.levels) for _, x in rows_of(batch, rule.slice_rows)]
            cluster, distance = (np.concatenate(c) for c in zip(*found, strict=True)) if found else ([], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"])

    return work


def moved(stored: DataFrame, centers: np.ndarray, rule: Clustering) -> np.ndarray:
    """Centroids (not transformed) after one round; what reaches the driver is one sum per component.

    The transform is linear and its own inverse but for the factor SIZE, so the
    sums of the components follow exactly from those of the coefficients.
    """
    order = coarse_first()
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = (
        stored.select("coefs").mapInArrow(
            sum_clusters(hadamard(centers)[:, order], rule), "cluster int, place int, n long, total long")
        .groupBy("cluster", "place").agg(wide("n").alias("n"), wide("total").alias("total")).collect())
    sums = np.zeros((len(centers), SIZE), object)
    count = np.zeros(len(centers), object)
    for r in rows:
        sums[r["cluster"], order[r["place"]]] = int(r["total"])
        count[r["cluster"]] = int(r["n"])
    new = centers.copy()
    for c in np.flatnonzero(count):
        new[c] = [int(s) // SIZE // count[c] for s in hadamard(sums[c:c + 1])[0]]
    return new


def cluster_vectors(vectors: DataFrame, rule: Clustering = Clustering()) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector that is kept.

    Kept are vectors of SIZE components, none of them null or not finite; each
    component x becomes floor(256 * x). Components of 65536 or more would not leave
    room for exact sums, so their vectors are left out, too. The first centroids are
    the vectors with the smallest hash of their id, equal ids by their components;
    vectors without an id belong to a cluster, but never start one. With fewer
    vectors than clusters there are fewer clusters. Repeated rows are vectors of
    their own. An empty table gives an empty one. Other columns are not read.
    """
    spark = vectors.sparkSession
    spool = Spool(spark, "centroids")
    order = coarse_first()
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    stored = spool.write(
        vectors.select("vec_id", "embedding").mapInArrow(transformed, f"vec_id {id_type}, coefs array<int>"), "coefs")
    starts = (
        stored.filter("vec_id is not null")
        .select(F.sha2(F.concat(F.lit(f"{rule.seed}:"), F.col("vec_id").cast("string")), 256).alias("hash"), "coefs")
        .orderBy("hash", "coefs").limit(rule.clusters).collect())
    out = f"vec_id {id_type}, cluster int, distance long"
    if not starts:
        none = spark.createDataFrame([], out)
        return none.select("*", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    coefs = np.array([r["coefs"] for r in starts], np.int64)
    centers = np.zeros_like(coefs)
    centers[:, order] = coefs
    centers = hadamard(centers) // SIZE
    for _ in range(rule.rounds):
        centers = moved(stored, centers, rule)
    final = spool.write(stored.mapInArrow(assigned(hadamard(centers)[:, order], rule), out), "clusters")
    hashes = [(c, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centers.tolist())]
    # One row per centroid; the window and the broadcast see no others.
    about = (
        final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
        .withColumn("inertia", F.sum("cluster_inertia").over(W.partitionBy()))
        .join(spark.createDataFrame(hashes, "cluster int, centroid_sha256 string"), "cluster"))
    return final.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
