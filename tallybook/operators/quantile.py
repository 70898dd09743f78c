"""Exact global median without sorting or collecting the column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BITS = 21
_MASK = (1 << _BITS) - 1


def exact_median(df: DataFrame, value: str) -> DataFrame:
    """One row `median` (double) of an integer column: the mean of the two middle values.

    Radix selection in three passes over 21 bits each. Every pass histograms the values that
    share the prefix found so far (at most 2^21 cells, aggregated map-side) and keeps the
    cell that holds the wanted rank. The built-in exact median gathers all distinct values
    in one task instead. Equal values are counted first, so a hot value costs one row.
    """
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(F.col(value).cast("bigint").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    digits = counted.select(
        F.shiftright("v", 2 * _BITS).alias("d0"),
        F.shiftright("v", _BITS).bitwiseAND(F.lit(_MASK)).alias("d1"),
        F.col("v").bitwiseAND(F.lit(_MASK)).alias("d2"),
        "n",
    )
    everything = Window.orderBy("d0")
    running = everything.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # First digit: find the cells that hold the two middle ranks.
    picks = (
        digits.groupBy("d0")
        .agg(F.sum("n").alias("n"))
        .select("d0", "n", F.sum("n").over(running).alias("upto"), F.sum("n").over(whole).alias("total"))
        .select(
            "d0",
            (F.col("upto") - F.col("n")).alias("below"),
            "upto",
            F.explode(F.expr("array((total - 1) div 2, total div 2)")).alias("rank"),
        )
        .where("rank >= below and rank < upto")
        .select("d0", (F.col("rank") - F.col("below")).alias("rank"))
        .distinct()
    )
    found = ["d0"]
    for level in ("d1", "d2"):
        # At most two rows are broadcast: one per middle rank.
        cells = digits.join(F.broadcast(picks), found).groupBy("rank", *found, level)
        upto = Window.partitionBy("rank", *found).orderBy(level).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        picks = (
            cells.agg(F.sum("n").alias("n"))
            .withColumn("upto", F.sum("n").over(upto))
            .withColumn("below", F.col("upto") - F.col("n"))
            .where("rank >= below and rank < upto")
            .select((F.col("rank") - F.col("below")).alias("rank"), *found, level)
        )
        found.append(level)
    # An odd count has one middle row, an even count one or two distinct ones.
    value_of = F.shiftleft("d0", 2 * _BITS) + F.shiftleft("d1", _BITS) + F.col("d2")
    return picks.select(value_of.cast("double").alias("v")).agg(
        ((F.min("v") + F.max("v")) / 2).alias("median")
    )
