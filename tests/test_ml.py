import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from tallybook.operators import clustering, features

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 4)) @ np.diag([5.0, 2.0, 1.0, 0.1]) + 10
    base[100:200, 0] += 40
    base[200:, 1] += 40
    rows = [(i, "abc"[i // 100], *map(float, r)) for i, r in enumerate(base)]
    df = spark.createDataFrame(rows, "id int, failure_code string, a double, b double, c double, d double")
    return base, df


def test_components_equal_numpy(points):
    base, df = points
    fitted = clustering.fit_components(df, NAMES)
    centred = base - base.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    assert np.allclose(fitted.ratios, s**2 / (s**2).sum())
    signs = np.sign(vt[np.arange(4), np.abs(vt).argmax(axis=1)])
    assert np.allclose(fitted.loadings, (vt * signs[:, None]).T, atol=1e-8)
    got = fitted.transform(df).select("id", vector_to_array("components").alias("p")).orderBy("id").collect()
    assert np.allclose([r.p for r in got], centred @ fitted.loadings, atol=1e-8)
    assert fitted.needed_for(0.9) == int(np.argmax(np.cumsum(fitted.ratios) >= 0.9)) + 1


def test_unseen_rows_use_the_fitted_centre(spark, points):
    base, df = points
    fitted = clustering.fit_components(df, NAMES, k=2)
    new = spark.createDataFrame([(1, "x", *map(float, base.mean(axis=0)))], df.schema)
    row = fitted.transform(new).select(vector_to_array("components").alias("p")).first()
    assert np.allclose(row.p, [0, 0], atol=1e-8)


def test_kmeans_finds_the_groups(points):
    _, df = points
    projected = clustering.fit_components(df, NAMES, k=3).transform(df)
    clustered = clustering.best_kmeans(projected, 3, restarts=3).transform(projected)
    table = clustering.crosstab(clustered, 3).collect()
    assert len(table) == 3 and all(max(r.cluster_0, r.cluster_1, r.cluster_2) == r.total == 100 for r in table)
    assert clustering.silhouette(clustered) > 0.8
    chosen = clustering.choose_k(projected, ks=(2, 3), restarts=2).orderBy("k").collect()
    assert chosen[0].inertia > chosen[1].inertia


def test_kmeans_numbers_and_inertia(points, spark):
    """The same fit from any partitioning; sizes, inertia and nearest centres recomputed."""
    base, df = points
    projected = clustering.fit_components(df, NAMES, k=2).transform(df)
    fits = clustering.fit_kmeans(projected, (1, 3, 5), restarts=4)
    again = clustering.fit_kmeans(projected.repartition(7), (1, 3, 5), restarts=4)
    for k, fit in fits.items():
        assert np.array_equal(fit.centres, again[k].centres) and fit.inertia == again[k].inertia and fit.sizes == again[k].sizes
        rows = fit.transform(projected).select("cluster", vector_to_array("components").alias("p")).collect()
        x, own = np.array([r.p for r in rows]), np.array([r.cluster for r in rows])
        squares = ((x[:, None, :] - fit.centres[None]) ** 2).sum(axis=2)
        assert (own == squares.argmin(axis=1)).all()
        assert fit.inertia == pytest.approx(squares.min(axis=1).sum(), rel=1e-6)
        assert fit.sizes == np.bincount(own, minlength=k).tolist() == sorted(fit.sizes, reverse=True)
        means = np.array([x[own == c].mean(axis=0) for c in range(k)])
        assert np.allclose(means, fit.centres, atol=0.2)
    assert np.allclose(fits[1].centres[0], [0, 0], atol=1e-6)
    few = clustering.fit_kmeans(projected.limit(2), (3,), restarts=2)[3]
    assert few.inertia == pytest.approx(0) and sum(few.sizes) == 2
    assert clustering.fit_kmeans(projected.limit(0), (2,), restarts=1)[2].sizes == []


def test_features(spark):
    schema = (
        "quarantine_id string, failure_code string, failure_count int, tx_timestamp timestamp, ingestion_timestamp timestamp, "
        "amount decimal(18,4), base_cncy string, c_id string, noise_level string, clean_count long, quarantine_count long, "
        "default_cncy string, hq_country string, industry_name string"
    )
    from datetime import datetime
    from decimal import Decimal

    at = datetime(2026, 1, 5, 12)
    rows = [
        ("q1", "A", 1, datetime(2026, 1, 5, 10), at, Decimal("10"), "EUR", "c", "low", 9, 1, "USD", "France", "Retail"),
        ("q2", "B", 1, None, at, None, "EUR", None, None, None, None, None, None, None),
        ("q3", "A", 1, datetime(2026, 1, 6, 14), at, Decimal("-4"), "USD", "c", "high", 5, 5, "USD", "Peru", "Retail"),
    ]
    derived = features.derive(spark.createDataFrame(rows, schema))
    model = features.fit(derived, ["Retail"], ["France", "Peru"])
    got = {r.quarantine_id: r for r in model.transform(derived).collect()}
    assert got["q1"].failure_count == 0.0  # a constant feature scales to 0
    assert (got["q1"].hour_of_day, got["q2"].hour_of_day, got["q3"].hour_of_day) == (0.0, 0.5, 1.0)
    assert (got["q1"].noise_level, got["q2"].noise_level, got["q3"].noise_level) == (0.0, 0.5, 1.0)
    # The missing rate is the mean of 0.1 and 0.5, the missing amount 0 between -4 and 10.
    assert got["q2"].batch_quarantine_rate == pytest.approx(0.5)
    assert got["q2"].amount == pytest.approx(4 / 14)
    assert (got["q1"].currency_mismatch, got["q2"].currency_mismatch, got["q3"].currency_mismatch) == (1, 0, 0)
    assert (got["q2"].country_france, got["q2"].industry_retail, got["q3"].country_peru) == (0, 0, 1)
    assert (got["q1"].amount_is_valid, got["q3"].amount_is_valid, got["q2"].company_known) == (1, 0, 0)
    known, unknown = features.split_by_company(model.transform(derived))
    assert known.count() == 2 and unknown.count() == 1
