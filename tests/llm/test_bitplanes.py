"""Bit-plane clustering against plain integer arithmetic."""

import hashlib
import math
import random

import numpy as np
import pytest

from tallybook.llm import bitplanes

SCHEMA = "vec_id bigint, embedding array<float>"


def plain_clusters(rows, k=16, rounds=3, seed=1):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), sum(x * x for x in r[1]))
    centroids = [v for _, v in sorted(kept, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        own = [[] for _ in centroids]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, centroids)]
    last = [(i, *nearest(v)) for i, v in kept]
    out = []
    for i, distance, cluster in last:
        digest = hashlib.sha256(",".join(map(str, centroids[cluster])).encode()).hexdigest()
        out.append((i, cluster, distance, sum(d for _, d, c in last if c == cluster), sum(d for _, d, _ in last), digest))
    return sorted(out, key=str)


def clusters(df, **options):
    return sorted(map(tuple, bitplanes.cluster(df, **options).collect()), key=str)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert clusters(df) == plain_clusters([(r.vec_id, r.embedding) for r in df.collect()])


def test_awkward_rows(spark):
    chance = random.Random(3)
    some = [[chance.uniform(-1.5, 1.5) for _ in range(64)] for _ in range(30)]
    rows = [(i, v) for i, v in enumerate(some)] + [(5, some[5]), (5, some[6]), (None, some[1]), (None, None)]
    rows += [(100, None), (101, []), (102, [0.5] * 63), (103, [0.5] * 65), (104, [0.0] * 64), (105, [0.0] * 64)]
    rows += [(106, [float("nan")] + [0.0] * 63), (107, [float("inf")] * 64), (108, [None] + [0.0] * 63), (109, [3000.0, -70000.5] * 32)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("cluster", "planes", "norm", "hash", "distance", "v"):
        df = df.withColumn(name, df["vec_id"])
    plain = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert clusters(df.repartition(4)) == plain_clusters(plain)
    assert clusters(df, k=3, rounds=0, seed=9) == plain_clusters(plain, 3, 0, 9)
    assert bitplanes.cluster(df.limit(0)).count() == 0
    assert clusters(df.where("vec_id < 2")) == plain_clusters([r for r in plain if r[0] is not None and r[0] < 2])


def test_ties_go_to_the_smaller_number(spark):
    """All vectors equal: one cluster gets them, and the empty ones stay."""
    df = spark.createDataFrame([(i, [0.25] * 64) for i in range(40)], SCHEMA)
    assert {(r.cluster, r.distance, r.inertia) for r in bitplanes.cluster(df).collect()} == {(0, 0, 0)}


@pytest.mark.parametrize("low, high", [(0, 0), (-1, 0), (0, 1), (-64, 63), (-65, 64), (-(1 << 27) + 1, (1 << 27) - 1)])
def test_planes_are_exact(low, high):
    chance = np.random.default_rng(1)
    x, c = chance.integers(low, high + 1, (50, 64)), chance.integers(low, high + 1, (1, 64))
    assert (bitplanes.unpack(bitplanes.pack(x)) == x).all()
    assert (bitplanes.inner_products(bitplanes.pack(x), bitplanes.pack(c)) == x @ c[0]).all()
    cluster, distance = bitplanes.nearest(bitplanes.pack(x), (x**2).sum(axis=1), [c[0], x[3]])
    assert distance.tolist() == [min(sum((a - b) ** 2 for a, b in zip(map(int, v), map(int, w))) for w in (c[0], x[3])) for v in x]
    assert cluster[3] == (0 if (c[0] == x[3]).all() else 1)


def test_components_without_a_64_bit_distance_fail(spark):
    df = spark.createDataFrame([(1, [3e6] * 64)], SCHEMA)
    with pytest.raises(Exception, match="scaled component"):
        bitplanes.cluster(df).collect()
