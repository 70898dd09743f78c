"""Joins and de-duplication that hold up when a key is hot or a dimension is large."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.session import materialize

# A dimension is broadcast only when a bounded count shows at most this many rows.
BROADCAST_ROWS = 500_000


def is_bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `max_rows` rows; reads no more than that many plus one."""
    return df.limit(max_rows + 1).count() <= max_rows


def attach(
    left: DataFrame,
    dim: DataFrame,
    on: list[tuple[str, str]],
    columns: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    bounded: bool | None = None,
) -> DataFrame:
    """Add `columns` of `dim` to `left`, matching `on` pairs of (left column, dim column).

    `dim` has one row per key. It is broadcast after its size was checked. Otherwise the
    join is shuffled: rows without a key, which can match nothing, are spread by a hash of
    the row, and hot keys are left to the run-time skew splitting of the shuffled join.
    `bounded` passes on the outcome of a check already made.
    """
    names = [f"__k{i}" for i in range(len(on))]
    keyed = dim.select(*[F.col(d).alias(n) for n, (_, d) in zip(names, on)], *columns)
    if is_bounded(dim, max_rows) if bounded is None else bounded:
        match = [left[c] == keyed[n] for n, (c, _) in zip(names, on)]
        joined = left.join(F.broadcast(keyed), reduce(Column.__and__, match), how)
        return joined.drop(*names)
    return spread_join(left, keyed, [(c, n) for n, (c, _) in zip(names, on)], how).drop(*names)


def lookup(
    left: DataFrame, dim: DataFrame, on: list[tuple[str, str]], columns: list[str], how: str = "inner"
) -> DataFrame:
    """`attach` for a left side that is already aggregated to about one row per key: neither
    side dwarfs the other, so the choice is left to run-time sizes."""
    names = [f"__k{i}" for i in range(len(on))]
    keyed = dim.select(*[F.col(d).alias(n) for n, (_, d) in zip(names, on)], *columns)
    match = [left[c] == keyed[n] for n, (c, _) in zip(names, on)]
    return left.join(keyed, reduce(Column.__and__, match), how).drop(*names)


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One row holding the columns of several one-row aggregates.

    The others are scalar subqueries of the first, so nothing is joined.
    """
    names = list(first.columns)
    for i, other in enumerate(others):
        row = other.select(F.struct(*other.columns).alias("row")).scalar()
        first = first.withColumn(f"__row{i}", row)
        names += [f"__row{i}.{c}" for c in other.columns]
    return first.select(*names)


def spread_join(
    left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str
) -> DataFrame:
    """Shuffled equi-join in which left rows with a null key do not pile up in one task."""
    no_key = reduce(Column.__or__, [F.col(c).isNull() for c, _ in on])
    row_hash = F.xxhash64(*left.columns) + F.spark_partition_id()
    left = left.withColumn("__spread", F.when(no_key, row_hash).otherwise(F.lit(0)).cast("bigint"))
    right = right.withColumn("__zero", F.lit(0).cast("bigint"))
    match = [left[c] == right[r] for c, r in on] + [left["__spread"] == right["__zero"]]
    return left.join(right, reduce(Column.__and__, match), how).drop("__spread", "__zero")


def dedupe(df: DataFrame, keys: list[str], prefer: list[str] | None = None) -> DataFrame:
    """One row per key: the least by `prefer`, then by the remaining columns.

    An aggregate rather than a window: copies of a hot key collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    order = (prefer or []) + [c for c in rest if c not in (prefer or [])]
    if not order:
        return df.dropDuplicates(keys)
    best = F.min(F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(
        *[F.col(c) if c in keys else F.col(f"__best.{c}").alias(c) for c in df.columns]
    )


def not_in(new: DataFrame, existing: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Rows of `new` whose key is not in `existing`."""
    seen = existing.select(*[F.col(k).alias(f"__{k}") for k in keys])
    pairs = [
        new[k].eqNullSafe(seen[f"__{k}"]) if null_safe else new[k] == seen[f"__{k}"] for k in keys
    ]
    return new.join(seen, reduce(Column.__and__, pairs), "left_anti")


def restrict(existing: DataFrame, new: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """The rows of a large stored table that share a key with a batch, if the batch is small.

    The batch's keys are broadcast, so the stored table is filtered where it is read and
    never shuffled. A batch beyond the limit leaves the stored table as it is.
    """
    if not is_bounded(new.select(*keys)):
        return existing
    wanted = new.select(*[F.col(k).alias(f"__{k}") for k in keys])
    pairs = [
        existing[k].eqNullSafe(wanted[f"__{k}"]) if null_safe else existing[k] == wanted[f"__{k}"] for k in keys
    ]
    return existing.join(F.broadcast(wanted), reduce(Column.__and__, pairs), "left_semi")


def attach_group_size(
    df: DataFrame, keys: list[str], name: str, null_group: bool = True, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add the number of rows sharing `keys`.

    Groups are counted from the keys alone and only those of two or more are kept, written
    once. While they are few they are broadcast, so the rows themselves are not shuffled;
    otherwise they are joined back. A hot key costs one partial aggregate instead of a window
    over its whole group. With `null_group` false, rows with a null in the key count as
    groups of one.
    """
    sized = df if null_group else df.where(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))
    repeated = materialize(
        sized.groupBy(*[F.col(k).alias(f"__{k}") for k in keys])
        .agg(F.count(F.lit(1)).alias("__n"))
        .where("__n > 1"),
        "repeated",
    )
    few = is_bounded(repeated, max_rows)
    if few or null_group:
        match = reduce(Column.__and__, [df[k].eqNullSafe(repeated[f"__{k}"]) for k in keys])
        joined = df.join(F.broadcast(repeated) if few else repeated, match, "left")
    else:
        joined = spread_join(df, repeated, [(k, f"__{k}") for k in keys], "left")
    return joined.withColumn(name, F.coalesce("__n", F.lit(1))).drop("__n", *[f"__{k}" for k in keys])


def running_total(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, coarse: Column
) -> DataFrame:
    """Running sum of `value` per key in `order`, one row per (key, order) expected.

    Two levels: totals per (key, coarse period) are accumulated over the few periods, then
    each period runs on its own, so one key's long history spreads over many tasks.
    """
    from pyspark.sql import Window

    df = df.withColumn("__p", coarse)
    periods = df.groupBy(*keys, "__p").agg(F.sum(value).alias("__s"))
    before = Window.partitionBy(*keys).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    opening = periods.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        F.col("__p").alias("__q"),
        F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__open"),
    )
    match = [df[k].eqNullSafe(opening[f"__{k}"]) for k in keys] + [
        df["__p"].eqNullSafe(opening["__q"])
    ]
    inside = Window.partitionBy(*keys, "__p").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        df.join(opening, reduce(Column.__and__, match))
        .withColumn(name, F.sum(value).over(inside) + F.col("__open"))
        .drop("__p", "__q", "__open", *[f"__{k}" for k in keys])
    )


def numbered(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """Add `name`: 1, 2, 3... in `order`, which should tell all rows apart.

    Rows are sorted in range partitions, written once, and each range starts after the rows of
    those before it, so only one count per range is carried.
    """
    from pyspark.sql import Window

    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *order).withColumn("__range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n")).select(
        F.col("__range").alias("__of"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    placed = ranged.withColumn("__place", inside)
    # One row for each range.
    joined = placed.join(F.broadcast(starts), placed["__range"] == starts["__of"])
    return joined.withColumn(name, F.col("__start") + F.col("__place")).select(*df.columns, name)
