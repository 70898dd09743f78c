"""Centroid clustering over packed bit planes.

A vector of 64 integers is stored as bit planes: bit b of all its components is one 64-bit word,
so a vector of components of B bits is B words. In two's complement a component is the sum of its
bits times 1, 2, 4, ..., with the highest weighing negatively. An inner product is therefore the sum,
over pairs of planes, of both weights times the number of common bits (AND and popcount), and the
squared distance follows from it and the norms. All of it is exact in integers.

Vectors are packed once and written; each round reads the packed words, and a task returns, for
each run of rows, one count and one sum of components per centroid. Only those sums, one row for
each centroid and component, reach the driver.

Defined cases: vectors that are null, of another length than 64, or hold a null or non-finite
component take no part. Components of 2^27 or more in size after scaling fail the job, as their
squared distances need not fit in 64 bits. Ties go to the centroid with the smaller number. Rows
that repeat an id are separate vectors; among equal starting hashes the smaller vector comes first.
A row without an id starts with the hash of an empty one. With fewer vectors than centroids there
are as many centroids as vectors; without vectors the result is empty. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.session import materialize

WIDTH = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
SEED = 1
#: Components below this size give distances of less than 2^63.
LARGEST = 1 << 27
#: Vectors whose distances are computed at once.
RUN = 1 << 14


def pack(components: np.ndarray) -> np.ndarray:
    """Planes (one row each, lowest bit first, the sign last) of rows of 64 integers."""
    largest = max(int(components.max(initial=0)), -int(components.min(initial=0)) - 1)
    planes = [
        np.packbits((components >> bit & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8").ravel()
        for bit in range(max(1, largest.bit_length()) + 1)
    ]
    return np.stack(planes)


def plane_weights(n_planes: int) -> np.ndarray:
    weights = 1 << np.arange(n_planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def unpack(planes: np.ndarray) -> np.ndarray:
    """Rows of 64 integers from their planes."""
    out = np.zeros((planes.shape[1], WIDTH), dtype=np.int64)
    for plane, weight in zip(planes, plane_weights(len(planes))):
        bits = np.unpackbits(np.ascontiguousarray(plane).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits * weight
    return out


def inner_products(planes: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Inner products of packed vectors with one packed centroid: weighted popcounts of common bits."""
    out = np.zeros(planes.shape[1], dtype=np.int64)
    for plane, weight in zip(planes, plane_weights(len(planes))):
        part = np.zeros(planes.shape[1], dtype=np.int64)
        for other, other_weight in zip(centroid[:, 0], plane_weights(len(centroid))):
            part += np.bitwise_count(plane & other) * other_weight
        out += part * weight
    return out


def nearest(planes: np.ndarray, norms: np.ndarray, centroids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller one of a tie) and the squared distance to it."""
    best = np.zeros(planes.shape[1], dtype=np.int64)
    least = np.full(planes.shape[1], np.iinfo(np.int64).max)
    for number, components in enumerate(centroids):
        distance = norms - 2 * inner_products(planes, pack(components[None, :])) + int((components**2).sum())
        closer = distance < least
        best[closer], least[closer] = number, distance[closer]
    return best, least


def _packer(batches):
    for batch in batches:
        flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        scaled = np.floor(flat * SCALE).reshape(-1, WIDTH)
        if np.abs(scaled).max(initial=0) >= LARGEST:
            raise ValueError(f"a scaled component is not below {LARGEST}")
        components = scaled.astype(np.int64)
        planes = pack(components)
        # Planes above the sign are copies of it; a row keeps those that this batch needs.
        cuts = np.arange(len(components) + 1, dtype=np.int32) * len(planes)
        words = pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.ascontiguousarray(planes.T).ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), words, pa.array((components**2).sum(axis=1))], names=["vec_id", "planes", "norm"]
        )


def _runs(batch: pa.RecordBatch):
    """Runs of rows with the same number of planes: the rows, their planes and norms."""
    sizes = np.diff(batch.column("planes").offsets.to_numpy())
    cuts = np.flatnonzero(np.diff(sizes)) + 1
    for begin, end in zip([0, *cuts], [*cuts, len(sizes)]):
        for first in range(begin, end, RUN):
            rows = batch.slice(first, min(RUN, end - first))
            words = rows.column("planes").flatten().to_numpy().view(np.uint64).reshape(len(rows), -1)
            yield rows, np.ascontiguousarray(words.T), rows.column("norm").to_numpy()


def pack_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, planes, norm of the vectors that can be clustered."""
    vector = F.col("v")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(f"`{id_column}`").cast("bigint").alias("vec_id"), F.col(f"`{vector_column}`").alias("v"))
    kept = rows.where(vector.isNotNull() & (F.size(vector) == WIDTH) & ~bad)
    return kept.mapInArrow(_packer, "vec_id bigint, planes array<bigint>, norm bigint")


def _starts(packed: DataFrame, k: int, seed: int) -> list[np.ndarray]:
    """The k vectors of the smallest hashes of their ids."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    hashed = packed.withColumn("hash", F.sha2(key.cast("binary"), 256))
    return [unpack(np.array(r.planes, dtype=np.int64).view(np.uint64)[:, None])[0] for r in hashed.orderBy("hash", "norm", "planes").limit(k).collect()]


def _summed(centroids: list[np.ndarray]):
    def sums(batches):
        """cluster, n, sums: vectors of each cluster and their componentwise sums."""
        k = len(centroids)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, WIDTH), dtype=np.int64)
        for batch in batches:
            for _, planes, norms in _runs(batch):
                cluster, _ = nearest(planes, norms, centroids)
                order = np.argsort(cluster, kind="stable")
                present, first = np.unique(cluster[order], return_index=True)
                count += np.bincount(cluster, minlength=k)
                total[present] += np.add.reduceat(unpack(planes)[order], first, axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[used]), pa.array(list(total[used]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"]
        )

    return sums


def _moved(packed: DataFrame, centroids: list[np.ndarray]) -> list[np.ndarray]:
    """Centroids after one round: the floored componentwise means; empty ones stay."""
    parts = packed.mapInArrow(_summed(centroids), "cluster bigint, n bigint, sums array<bigint>")
    sums = parts.select("cluster", "n", F.posexplode("sums").alias("at", "value"))
    moved = [c.copy() for c in centroids]
    # One row for each centroid and component.
    for row in sums.groupBy("cluster", "at").agg(F.sum("value").alias("total"), F.sum("n").alias("n")).collect():
        moved[row.cluster][row["at"]] = row.total // row.n
    return moved


def centroids_of(packed: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> list[np.ndarray]:
    centroids = _starts(packed, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = _moved(packed, centroids)
    return centroids


def assign(packed: DataFrame, centroids: list[np.ndarray]) -> DataFrame:
    """vec_id, cluster and squared distance of each packed vector."""

    def assigned(batches):
        for batch in batches:
            for rows, planes, norms in _runs(batch):
                cluster, distance = nearest(planes, norms, centroids)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"]
                )

    return packed.mapInArrow(assigned, "vec_id bigint, cluster int, distance bigint")


def cluster(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and the centroid's sha256, one row per vector."""
    spark = vectors.sparkSession
    packed = materialize(pack_vectors(vectors, id_column, vector_column), "planes")
    centroids = centroids_of(packed, k, rounds, seed)
    assigned = materialize(assign(packed, centroids), "assigned")
    # One row for each centroid.
    own = {r.cluster: r.inertia for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    rows = [(number, own[number], sum(own.values()), digests[number]) for number in sorted(own)]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
