import random
import statistics

import pytest
from pyspark.sql import functions as F

from tallybook.operators import joins
from tallybook.operators.quantile import exact_median


@pytest.mark.parametrize("how", ["left", "inner"])
def test_attach_is_the_same_beyond_the_broadcast_limit(spark, how):
    left = spark.createDataFrame([(i, None if i % 4 == 0 else i % 7) for i in range(200)], "id int, k int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k int, name string")
    small = joins.attach(left, dim, [("k", "k")], ["name"], how)
    large = joins.attach(left, dim, [("k", "k")], ["name"], how, max_rows=2)
    assert sorted(small.collect(), key=str) == sorted(large.collect(), key=str)
    want = 200 if how == "left" else sum(1 for i in range(200) if i % 4 and i % 7 < 5)
    assert large.count() == want


def test_null_keys_are_spread(spark):
    left = spark.range(4000).select("id", F.lit(None).cast("int").alias("k"))
    dim = spark.createDataFrame([(1, "a")], "k int, name string")
    joined = joins.spread_join(left, dim.withColumnRenamed("k", "__k"), [("k", "__k")], "left")
    assert joined.count() == 4000
    plan = joined._jdf.queryExecution().toString()
    assert "__spread" in plan


def test_dedupe_keeps_the_preferred_row(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, "c", 1), (None, "x", 1), (None, "w", 2)], "k int, s string, n int")
    assert sorted(joins.dedupe(df, ["k"], ["n"]).collect(), key=str) == sorted(
        [(1, "b", 2), (2, "c", 1), (None, "x", 1)], key=str
    )
    assert {r.s for r in joins.dedupe(df, ["k"]).collect()} == {"a", "c", "w"}


@pytest.mark.parametrize("max_rows", [100, 0], ids=["broadcast", "shuffled"])
def test_group_size(spark, max_rows):
    rows = [("a",)] * 3 + [("b",)] + [(None,)] * 2
    df = spark.createDataFrame(rows, "k string")
    sized = {(r.k, r.n) for r in joins.attach_group_size(df, ["k"], "n", max_rows=max_rows).collect()}
    assert sized == {("a", 3), ("b", 1), (None, 2)}
    alone = joins.attach_group_size(df, ["k"], "n", null_group=False, max_rows=max_rows)
    assert {(r.k, r.n) for r in alone.collect()} == {("a", 3), ("b", 1), (None, 1)}
    assert alone.count() == 6


def test_running_total(spark):
    rnd = random.Random(3)
    rows = [(k, t, rnd.randrange(100)) for k in "abc" for t in range(60)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    got = joins.running_total(df, ["k"], "t", "v", "total", F.floor(F.col("t") / 7))
    for r in got.collect():
        assert r.total == sum(v for k, t, v in rows if k == r.k and t <= r.t)


@pytest.mark.parametrize(
    "values",
    [[5], [1, 2], [3, 3, 3, 9], [-7, 10**17, 2, -(10**17), 0], list(range(1001)), [-5, -5, -4, -1], [2**21, 2**21 - 1, 2**42]],
)
def test_exact_median(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    assert exact_median(df, "v").first().median == pytest.approx(float(statistics.median(values)), rel=1e-15)


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([], "v bigint"), "v").first().median is None


def test_median_with_a_dominant_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 17).otherwise(F.col("id")).alias("v"))
    values = [17 if i % 3 == 0 else i for i in range(30000)]
    assert exact_median(df, "v").first().median == statistics.median(values)
