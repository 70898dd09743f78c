"""As-of joins: each left row gets the latest right row at or before its own time.

A window per key would leave one task per currency pair. Here time is cut into slots and
each slot starts from the last tick before it, so work spreads over keys x slots:

1. ticks are counted per (key, period); the ticks of a period with too many are reduced to the
   last one of each time, and the period is cut into FANOUT slices, those with too many again,
   down to single microseconds. Cuts thus follow the counts that were measured: a burst inside
   one second gets as many slots as it needs, and quiet times get none;
2. left rows are counted per (key, slot); a slot with too many is split by salt, and only
   that slot's ticks are copied to each salt (the copies are never more than a fraction
   of the left rows);
3. the last tick per (key, slot) is carried forward, first over days and then over the slots
   of a day (one row per slot), to give every slot its opening tick;
4. opening ticks, ticks and left rows meet in one shuffle on (key, slot, salt), where the
   last tick seen is carried to each left row.

Left rows without a key or a time match nothing and never enter the shuffle. Lists of dense
periods and crowded slots are written, counted and broadcast only while they are few. Equal left
rows share a salt.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.operators import joins
from tallybook.session import RowCounter, materialize

PERIOD_SECONDS = 3600
MAX_TICKS_PER_SLOT = 250_000
MAX_LEFT_PER_SLOT = 1_000_000
#: Slices that a dense period, or a dense slice, is cut into.
FANOUT = 1024
_DAY = 86_400_000_000


def _floor_to(us: Column, width: int) -> Column:
    """Start of the slice of `width` microseconds, counted from 1970, that a time is in."""
    return us - F.pmod(us, F.lit(width))


def _attach(df: DataFrame, few: DataFrame, rows: int, on: list[str]) -> DataFrame:
    """Left join with a written list of `rows` rows."""
    return df.join(F.broadcast(few) if rows <= joins.BROADCAST_ROWS else few, on, "left")


def _written(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    counter = RowCounter()
    stored = materialize(counter.watch(df), label)
    return stored, counter.rows


@dataclass
class Slots:
    """How time is cut for each key: even periods, and finer slices of the dense ones."""

    by: list[str]
    width: int
    # Per level: starts of the slices to be cut, how many those are, and the width of the cuts.
    levels: list[tuple[DataFrame, int, int]] = field(default_factory=list)

    def place(self, df: DataFrame) -> DataFrame:
        """Add `__slot`, the time at which a row's slot begins."""
        df = df.withColumn("__slot", _floor_to(F.col("__us"), self.width))
        for dense, rows, width in self.levels:
            inner = F.col("__us") - F.pmod(F.col("__us") - F.col("__slot"), F.lit(width))
            cut = F.when(F.col("__dense"), inner).otherwise(F.col("__slot"))
            df = _attach(df, dense, rows, [*self.by, "__slot"]).withColumn("__slot", cut).drop("__dense")
        return df

    def cut(self, ticks: DataFrame, max_ticks: int, width: int) -> int:
        """Find the slots that hold too many of the ticks and cut them to `width`; says how many."""
        counts = self.place(ticks).groupBy(*self.by, "__slot").agg(F.count(F.lit(1)).alias("__n"))
        dense = counts.where(F.col("__n") > max_ticks).select(*self.by, "__slot", F.lit(True).alias("__dense"))
        dense, rows = _written(dense, "dense")
        if rows:
            self.levels.append((dense, rows, width))
        return rows


def _cut_time(ticks: DataFrame, by: list[str], width: int, max_ticks: int, newest: Column) -> tuple[Slots, DataFrame]:
    """Slots with at most `max_ticks` ticks, and the ticks: in dense periods the last of each time."""
    slots = Slots(by, width)
    finer = -(-width // FANOUT)
    if not slots.cut(ticks, max_ticks, finer):
        return slots, ticks
    dense, rows, _ = slots.levels[0]
    period = ticks.withColumn("__slot", _floor_to(F.col("__us"), width))
    placed = _attach(period, dense, rows, [*by, "__slot"])
    last = placed.where("__dense").groupBy(*by, "__us").agg(F.max_by("__tick", newest).alias("__tick"))
    last = materialize(last, "last-ticks")
    while finer > 1:
        width, finer = finer, -(-finer // FANOUT)
        if not slots.cut(last, max_ticks, finer):
            break
    quiet = placed.where("__dense is null").select(*by, "__us", "__tick")
    return slots, quiet.unionByName(last)


def _openings(per_slot: DataFrame, ticks: DataFrame, by: list[str], newest: Column) -> DataFrame:
    """(by, __slot, __open): the last tick before each slot that has left rows.

    Two levels: the last tick is carried over days, and inside each day over its slots.
    """
    day = _floor_to(F.col("__slot"), _DAY).alias("__day")
    closing = ticks.groupBy(*by, "__slot").agg(F.max_by("__tick", newest).alias("__tick"))
    nothing = F.lit(None).cast(closing.schema["__tick"].dataType)
    entries = per_slot.select(*by, "__slot", F.lit(0).alias("__kind"), nothing.alias("__tick")).unionByName(
        closing.withColumn("__kind", F.lit(1))
    )
    entries = entries.withColumn("__day", _floor_to(F.col("__slot"), _DAY))
    # Of one slot's two entries, the left one sorts first, so it sees earlier slots only.
    before = Window.partitionBy(*by, "__day").orderBy("__slot", "__kind").rowsBetween(Window.unboundedPreceding, -1)
    inside = entries.withColumn("__open", F.last("__tick", ignorenulls=True).over(before)).where("__kind = 0")
    days = per_slot.select(*by, day).distinct().withColumn("__kind", F.lit(0)).withColumn("__tick", nothing)
    ends = closing.groupBy(*by, day).agg(F.max_by("__tick", "__slot").alias("__tick")).withColumn("__kind", F.lit(1))
    earlier = Window.partitionBy(*by).orderBy("__day", "__kind").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        days.unionByName(ends)
        .withColumn("__carried", F.last("__tick", ignorenulls=True).over(earlier))
        .where("__kind = 0")
        .select(*by, "__day", "__carried")
    )
    opened = inside.join(carried, [*by, "__day"]).withColumn("__open", F.coalesce("__open", "__carried"))
    return opened.where("__open is not null").select(*by, "__slot", "__open")


@dataclass(frozen=True)
class Prepared:
    """Both sides of the shuffle: columns by, __slot, __salt, __us, __side, __tick and __row."""

    supply: DataFrame
    demand: DataFrame
    keyed: Column


def prepare(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
    columns: list[str],
    allow_equal: bool = True,
    period_seconds: int = PERIOD_SECONDS,
    max_ticks: int = MAX_TICKS_PER_SLOT,
    max_left: int = MAX_LEFT_PER_SLOT,
) -> Prepared:
    """Place ticks and left rows in slots and salts."""
    keyed = reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, left_on]])
    newest = F.struct("__us", *[F.col(f"__tick.{c}") for c in columns])

    ticks = right.where(reduce(Column.__and__, [F.col(c).isNotNull() for c in [*by, right_on]]))
    ticks = ticks.select(
        *by, F.unix_micros(F.col(right_on).cast("timestamp")).alias("__us"),
        F.struct(right_on, *columns).alias("__tick"),
    )
    slots, ticks = _cut_time(ticks, by, period_seconds * 1_000_000, max_ticks, newest)
    ticks = slots.place(ticks)

    time = F.unix_micros(F.col(left_on).cast("timestamp")).alias("__us")
    per_slot = slots.place(left.where(keyed).select(*by, time)).groupBy(*by, "__slot").agg(F.count(F.lit(1)).alias("__n"))
    per_slot = materialize(per_slot, "left-slots")
    rows = left.where(keyed).select(
        *by, time, F.struct(*left.columns).alias("__row"),
        # Copies of one row differ by input partition, which a re-run does not change.
        (F.xxhash64(*left.columns) + F.spark_partition_id()).alias("__hash"),
    )
    rows = slots.place(rows)
    opened = _openings(per_slot, ticks, by, newest).select(
        *by, "__slot", F.lit(-(1 << 62)).alias("__us"), F.col("__open").alias("__tick")
    )
    supply = ticks.unionByName(opened)
    crowded = per_slot.where(F.col("__n") > max_left).select(
        *by, "__slot", F.ceil(F.col("__n") / max_left).cast("bigint").alias("__salts")
    )
    crowded, n_crowded = _written(crowded, "crowded")
    if n_crowded:
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("__salts") - 1, F.lit(0))))
        supply = _attach(supply, crowded, n_crowded, [*by, "__slot"]).withColumn("__salt", copies)
        salt = F.coalesce(F.pmod("__hash", "__salts"), F.lit(0))
        rows = _attach(rows, crowded, n_crowded, [*by, "__slot"]).withColumn("__salt", salt)
    else:
        supply, rows = (df.withColumn("__salt", F.lit(0).cast("bigint")) for df in (supply, rows))

    left_side, tick_side = (1, 0) if allow_equal else (0, 1)
    row_type, tick_type = rows.schema["__row"].dataType, ticks.schema["__tick"].dataType
    place = [*by, "__slot", "__salt", "__us"]
    return Prepared(
        supply.select(*place, F.lit(tick_side).alias("__side"), "__tick", F.lit(None).cast(row_type).alias("__row")),
        rows.select(*place, F.lit(left_side).alias("__side"), F.lit(None).cast(tick_type).alias("__tick"), "__row"),
        keyed,
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: list[str],
    left_on: str,
    right_on: str,
    columns: list[str],
    how: str = "left",
    allow_equal: bool = True,
    **tuning: int,
) -> DataFrame:
    """Left columns plus `right_on` and `columns` of the latest earlier right row.

    `how` is `left` (unmatched rows kept with nulls) or `inner`. With `allow_equal` false
    only strictly earlier rows match. Among right rows of one key and time, the greatest by
    `columns` wins. `tuning` is passed on to `prepare`.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    taken = [right_on, *columns]
    sides = prepare(left, right, by, left_on, right_on, columns, allow_equal, **tuning)
    so_far = (
        Window.partitionBy(*by, "__slot", "__salt")
        .orderBy("__us", "__side", *[F.col(f"__tick.{c}") for c in columns])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = (
        sides.supply.unionByName(sides.demand)
        .withColumn("__match", F.last("__tick", ignorenulls=True).over(so_far))
        .where("__row is not null")
        .select("__row.*", *[F.col(f"__match.{c}").alias(c) for c in taken])
    )
    if how == "inner":
        return matched.where(F.col(right_on).isNotNull())
    types = {f.name: f.dataType for f in right.select(*taken).schema}
    unmatched = left.where(~sides.keyed).select(
        "*", *[F.lit(None).cast(types[c]).alias(c) for c in taken]
    )
    return matched.unionByName(unmatched)


def match_fx_rates(
    transactions: DataFrame,
    ticks: DataFrame,
    ts: str = "tx_timestamp",
    how: str = "left",
    **tuning: int,
) -> DataFrame:
    """Latest rate at or before each transaction for its own (base, quote) pair."""
    return asof_join(
        transactions, ticks, ["base_cncy", "quote_cncy"], ts, "fx_timestamp", ["rate"], how, **tuning
    )
