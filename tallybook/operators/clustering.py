"""Principal components and k-means over a feature matrix."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, ElementwiseProduct, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.session import materialize

RESTARTS = 10
SEED = 42
MAX_ROUNDS = 300
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Components:
    """A fitted, centred projection. Component signs are fixed so that each component's
    largest loading is positive, whatever the solver returned."""

    columns: list[str]
    model: PipelineModel
    loadings: np.ndarray  # features x components
    ratios: np.ndarray

    def transform(self, matrix: DataFrame, output: str = "components") -> DataFrame:
        projected = self.model.transform(matrix)
        extra = [c for c in matrix.columns if c not in self.columns]
        return projected.select(*extra, F.col("signed").alias(output))

    def needed_for(self, share: float = 0.90) -> int:
        """Number of components whose variance adds up to `share`."""
        return int(np.argmax(np.cumsum(self.ratios) >= share - 1e-12)) + 1


def fit_components(matrix: DataFrame, columns: list[str], k: int | None = None) -> Components:
    """Fit `k` components (all by default) on centred features."""
    k = len(columns) if k is None else k
    steps = [
        VectorAssembler(inputCols=columns, outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="centred", withMean=True, withStd=False),
        PCA(k=k, inputCol="centred", outputCol="raw"),
    ]
    model = Pipeline(stages=steps).fit(matrix)
    loadings = model.stages[-1].pc.toArray()
    largest = np.abs(loadings).argmax(axis=0)
    signs = np.where(loadings[largest, np.arange(k)] < 0, -1.0, 1.0)
    flip = ElementwiseProduct(scalingVec=Vectors.dense(signs), inputCol="raw", outputCol="signed")
    signed = PipelineModel(stages=[*model.stages, flip])
    return Components(columns, signed, loadings * signs, model.stages[-1].explainedVariance.toArray())


def variance_table(spark, components: Components) -> DataFrame:
    total = np.cumsum(components.ratios)
    rows = [(i + 1, float(r), float(c)) for i, (r, c) in enumerate(zip(components.ratios, total))]
    return spark.createDataFrame(rows, "component int, variance_ratio double, cumulative double")


def loadings_table(spark, components: Components, top: int = 5) -> DataFrame:
    """(component, feature, loading) of the first components."""
    top = min(top, components.loadings.shape[1])
    rows = [
        (j + 1, name, float(components.loadings[i, j]))
        for j in range(top)
        for i, name in enumerate(components.columns)
    ]
    return spark.createDataFrame(rows, "component int, feature string, loading double")


def covariance_table(spark, components: Components, total_variance: float) -> DataFrame:
    """(feature, other, covariance) that all components together stand for."""
    variances = components.ratios * total_variance
    matrix = (components.loadings * variances) @ components.loadings.T
    rows = [
        (a, b, float(matrix[i, j])) for i, a in enumerate(components.columns) for j, b in enumerate(components.columns) if a <= b
    ]
    return spark.createDataFrame(rows, "feature string, other string, covariance double")


def pick_components(projected: DataFrame, indices: list[int], output: str = "picked") -> DataFrame:
    return VectorSlicer(inputCol="components", outputCol=output, indices=indices).transform(projected)


@dataclass(frozen=True)
class KMeansFit:
    """Centres numbered by size, the largest cluster first, then by their coordinates."""

    centres: np.ndarray
    sizes: list[int]
    inertia: float
    column: str

    def transform(self, points: DataFrame, output: str = "cluster") -> DataFrame:
        """Add the number of the nearest centre, the smaller one of a tie."""
        x = vector_to_array(self.column)
        distances = F.array(
            *[
                F.aggregate(
                    F.zip_with(x, F.array(*[F.lit(float(v)) for v in centre]), lambda a, b: (a - b) * (a - b)),
                    F.lit(0.0),
                    lambda total, part: total + part,
                )
                for centre in self.centres
            ]
        )
        staged = points.withColumn("__distances", distances)
        nearest = F.array_position("__distances", F.array_min("__distances")) - 1
        return staged.withColumn(output, nearest.cast("int")).drop("__distances")


def _points(df: DataFrame, column: str) -> DataFrame:
    """(x, id): coordinates and a hash of the row, which draws the starting points."""
    hashed = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, (VectorUDT, T.MapType))]
    x = vector_to_array(column)
    return materialize(df.select(x.alias("x"), F.xxhash64(x, *hashed).alias("id")), "points")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, 0))


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, one row per point and one column per centre."""
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1))


def _draw(salt: int, ids: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1] that depend on the row's hash and the draw only."""
    z = ids.view(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2**53 + 2**-54


def _starting_points(points: DataFrame, k: int, restarts: int, seed: int) -> list[np.ndarray]:
    """Per restart k centres, each drawn with a chance proportional to its squared distance from
    those before it. One pass adds a centre to every restart: the point whose exponential
    waiting time, at a rate of that distance, is the shortest."""
    chosen: list[list[np.ndarray]] = [[] for _ in range(restarts)]
    for step in range(k):
        held = [np.array(c) for c in chosen]

        def race(batches, step=step, held=held):
            best: dict[int, tuple[float, list[float]]] = {}
            for batch in batches:
                x, ids = _matrix(batch), batch.column("id").to_numpy()
                for restart in range(restarts if len(x) else 0):
                    rate = np.ones(len(x)) if step == 0 else _squares(x, held[restart]).min(axis=1)
                    wait = np.full(len(x), np.inf)
                    some = rate > 1e-18
                    wait[some] = -np.log(_draw((seed + restart) * 64 + step, ids[some])) / rate[some]
                    first = int(wait.argmin())
                    key = (float(wait[first]), x[first].tolist())
                    best[restart] = min(best.get(restart, key), key)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(best), pa.int32()),
                    pa.array([w for w, _ in best.values()], pa.float64()),
                    pa.array([p for _, p in best.values()], pa.list_(pa.float64())),
                ],
                names=["restart", "wait", "x"],
            )

        raced = points.mapInArrow(race, "restart int, wait double, x array<double>")
        # One row for each restart.
        for row in raced.groupBy("restart").agg(F.min(F.struct("wait", "x")).alias("best")).collect():
            chosen[row.restart].append(np.array(row.best.x))
    return [np.array(c) for c in chosen]


#: Sums are kept in units of 2^-24, so that they don't depend on the order of adding.
_UNIT = float(1 << 24)


def _pass(points: DataFrame, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per model the sizes of its clusters, their sums, and its inertia: one pass for all models."""
    def sums(batches):
        counts = [np.zeros(len(m), np.int64) for m in models]
        totals = [np.zeros(m.shape, np.int64) for m in models]
        costs = [np.zeros(len(m), np.int64) for m in models]
        for batch in batches:
            x = _matrix(batch)
            if not len(x):
                continue
            fixed = np.rint(x * _UNIT).astype(np.int64)
            for at, centres in enumerate(models):
                squares = _squares(x, centres)
                nearest = squares.argmin(axis=1)
                counts[at] += np.bincount(nearest, minlength=len(centres))
                np.add.at(totals[at], nearest, fixed)
                np.add.at(costs[at], nearest, np.rint(squares[np.arange(len(x)), nearest] * _UNIT).astype(np.int64))
        rows = [(at, c) for at, m in enumerate(models) for c in range(len(m)) if counts[at][c]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([at for at, _ in rows], pa.int32()),
                pa.array([c for _, c in rows], pa.int32()),
                pa.array([[counts[at][c], costs[at][c], *totals[at][c]] for at, c in rows], pa.list_(pa.int64())),
            ],
            names=["model", "cluster", "sums"],
        )

    parts = points.mapInArrow(sums, "model int, cluster int, sums array<bigint>")
    added = parts.select("model", "cluster", F.posexplode("sums").alias("at", "value"))
    out = [(np.zeros(len(m), np.int64), np.zeros(m.shape), 0.0) for m in models]
    # One row for each centre and coordinate.
    for r in added.groupBy("model", "cluster", "at").agg(F.sum("value").alias("value")).collect():
        sizes, totals, cost = out[r.model]
        if r["at"] == 0:
            sizes[r.cluster] = r.value
        elif r["at"] == 1:
            out[r.model] = (sizes, totals, cost + r.value / _UNIT)
        else:
            totals[r.cluster, r["at"] - 2] = r.value / _UNIT
    return out


def fit_kmeans(
    points: DataFrame, ks: Iterable[int], column: str = "components", restarts: int = RESTARTS, seed: int = SEED,
    max_rounds: int = MAX_ROUNDS, tolerance: float = TOLERANCE,
) -> dict[int, KMeansFit]:
    """For each k the cheapest of several runs from different starting points.

    All runs of all k advance together, with one pass over the written points for each round.
    A run ends when its centres move by less than the tolerance, in terms of their spread.
    """
    ks = sorted(set(ks))
    rows = _points(points, column)
    starts = _starting_points(rows, max(ks), restarts, seed)
    models = {(k, r): starts[r][:k] for k in ks for r in range(restarts) if len(starts[r])}
    if not models:
        return {k: KMeansFit(np.zeros((0, 0)), [], 0.0, column) for k in ks}
    moving = set(models)
    spread = rows.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.var_pop("v").alias("v")).agg(F.avg("v")).first()[0]
    for _ in range(max_rounds):
        names = sorted(moving)
        for name, (sizes, totals, _) in zip(names, _pass(rows, [models[n] for n in names])):
            moved = np.where(sizes[:, None] > 0, totals / np.maximum(sizes, 1)[:, None], models[name])
            if ((moved - models[name]) ** 2).sum() <= tolerance * spread:
                moving.discard(name)
            models[name] = moved
        if not moving:
            break
    names = sorted(models)
    best: dict[int, KMeansFit] = {}
    for (k, _), (sizes, _, inertia), centres in zip(names, _pass(rows, [models[n] for n in names]), [models[n] for n in names]):
        if k not in best or inertia < best[k].inertia:
            order = sorted(range(len(centres)), key=lambda c: (-sizes[c], centres[c].tolist()))
            best[k] = KMeansFit(centres[order], [int(sizes[c]) for c in order], float(inertia), column)
    return best


def best_kmeans(points: DataFrame, k: int, column: str = "components", restarts: int = RESTARTS) -> KMeansFit:
    """The cheapest of several runs from different starting points."""
    return fit_kmeans(points, [k], column, restarts)[k]


def check_fits(points: DataFrame, fits: dict[int, KMeansFit]) -> DataFrame:
    """Per k: points, clusters in use, points that another centre is nearer to, and the relative
    error of the inertia, all computed again from the assigned rows."""
    found = None
    for k, fit in fits.items():
        x = vector_to_array(fit.column)

        def squared(centre: Column) -> Column:
            return F.aggregate(F.zip_with(x, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)

        centres = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in fit.centres])
        rows = fit.transform(points).withColumn("__centres", centres).withColumn("__own", squared(F.col("__centres")[F.col("cluster")]))
        nearer = F.exists("__centres", lambda c: squared(c) < F.col("__own"))
        one = rows.agg(
            F.lit(k).alias("k"),
            F.count(F.lit(1)).alias("points"),
            F.count_distinct("cluster").alias("clusters"),
            F.count_if(nearer).alias("misplaced"),
            F.round(F.abs(F.sum("__own") - fit.inertia) / max(fit.inertia, 1e-9), 5).alias("inertia_error"),
        )
        found = one if found is None else found.unionByName(one)
    return found


def silhouette(clustered: DataFrame, column: str = "components") -> float:
    """Mean silhouette with squared Euclidean distance, which is linear in the rows."""
    return ClusteringEvaluator(featuresCol=column, predictionCol="cluster").evaluate(clustered)


def crosstab(clustered: DataFrame, k: int, label: str = "failure_code") -> DataFrame:
    """Rows per label and cluster, with each cluster's share of its label."""
    counts = clustered.groupBy(label).agg(
        *[F.count_if(F.col("cluster") == i).alias(f"cluster_{i}") for i in range(k)],
        F.count(F.lit(1)).alias("total"),
    )
    shares = {
        f"share_{i}": F.round(F.col(f"cluster_{i}").cast("decimal(20,0)") / F.col("total"), 3) for i in range(k)
    }
    return counts.withColumns(shares).orderBy(label)


def choose_k(points: DataFrame, ks=range(2, 9), column: str = "components", restarts: int = RESTARTS) -> DataFrame:
    """Inertia and silhouette for each number of clusters; all are fitted together."""
    fits = fit_kmeans(points, ks, column, restarts)
    rows = [(k, fits[k].inertia, float(silhouette(fits[k].transform(points), column))) for k in fits]
    return points.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")
