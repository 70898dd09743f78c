"""Distributed helpers shared by the operators: prefix sums, connected components, id checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.session import materialize

#: Rows that a broadcast may hold: a few dozen MB of ids. Above it the same join is shuffled.
BROADCAST_IDS = 1_000_000


def with_fresh_names(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Only the named columns, under their new names; all others, clashing or not, stay out."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in columns.items()])


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """`df` has `rows` rows (measured while it was written)."""
    return F.broadcast(df) if rows <= BROADCAST_IDS else df


def running_totals(df: DataFrame, groups: list[str], order: list[Column], value: Column, partitions: int) -> DataFrame:
    """Add `before`: the sum of `value` over the rows of the same group that come earlier in `order`.

    Rows are range-partitioned by group and order, so a hot group is spread over many tasks. Each
    range adds up its own rows; only one total per range and group is carried from range to
    range. `order` must fix the order of all rows. The ranges are written first, since range
    boundaries found anew could differ.
    """
    keys = [F.col(g).asc_nulls_last() for g in groups]
    ranged = df.withColumn("_value", value).repartitionByRange(partitions, *keys, *order)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy("_range", *groups).agg(F.sum("_value").alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col("_range").alias("_range2"),
        *[F.col(g).alias(f"_{g}") for g in groups],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_carried"),
    )
    inside = Window.partitionBy("_range", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_local", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    same = F.col("_range") == F.col("_range2")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return (
        local.join(carried, same)
        .withColumn("before", F.col("_local") + F.col("_carried"))
        .drop("_value", "_range", "_range2", "_local", "_carried", *[f"_{g}" for g in groups])
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node in `edges` (a, b); component is the smallest reachable node.

    Alternates linking all larger neighbours, then all smaller ones, to the smallest neighbour,
    until nothing changes: a number of rounds logarithmic in the number of nodes. A node's
    neighbours are only ever aggregated to a minimum and joined, never gathered in one place.
    """
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = materialize(links, "links")
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        ).distinct()
        large = materialize(large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .where("u <> v")
            .distinct()
        )
        links = materialize(small, "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
