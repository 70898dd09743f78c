"""Incremental promotion of raw tables into the star schema.

Every function returns only the rows to append: those whose key is not in the existing
table, so that running a step again adds nothing. Surrogate keys are functions of natural
keys (see `functions.timekeys` and `functions.ids`), so facts get their dimension keys
without joining the dimension.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import ids, timekeys
from tallybook.operators import asof, joins
from tallybook.session import scratch_path


def _unless_known(new: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    return new if existing is None else joins.not_in(new, existing, keys)


def fx_key(rate="rate", base="base_cncy", quote="quote_cncy"):
    text = F.col(rate).cast("decimal(14,7)").cast("string")
    return ids.surrogate_id("fx", text, F.col(base), F.col(quote))


def promote_fx_rates(ticks: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct (rate, base, quote) values."""
    distinct = ticks.select(
        F.col("rate").cast("decimal(14,7)").alias("rate"),
        F.trim("base_cncy").alias("base_cncy"),
        F.trim("quote_cncy").alias("quote_cncy"),
    ).distinct()
    new = distinct.select(fx_key().alias("fx_id"), "rate", "base_cncy", "quote_cncy")
    return _unless_known(new, existing, ["rate", "base_cncy", "quote_cncy"])


def _time_rows(keys: DataFrame) -> DataFrame:
    stamp = timekeys.t_stamp(F.col("time_id"))
    return keys.select(
        "time_id",
        stamp.alias("t_stamp"),
        timekeys.fisc_quarter(stamp).alias("fisc_quarter"),
        timekeys.day_of_week(stamp).alias("day_of_week"),
    )


def promote_time(
    transactions: DataFrame, expenses: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """One row per distinct transaction or expense time."""
    stamps = transactions.select(F.col("tx_timestamp").cast("timestamp").alias("ts")).union(
        expenses.select(F.col("expense_timestamp").cast("timestamp"))
    )
    keys = stamps.where("ts is not null").select(timekeys.time_id(F.col("ts")).alias("time_id")).distinct()
    return _time_rows(_unless_known(keys, existing, ["time_id"]))


def ensure_midnights(times: DataFrame) -> DataFrame:
    """Rows for the midnights of all days in `times` that it lacks."""
    midnights = times.select(timekeys.day_key(F.col("time_id")).alias("time_id")).distinct()
    return _time_rows(joins.not_in(midnights, times, ["time_id"]))


def promote_times_and_midnights(
    transactions: DataFrame, expenses: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Rows for all transaction and expense times and for the midnights of their days.

    `existing` needs to hold the rows of those days only.
    """
    stamps = transactions.select(F.col("tx_timestamp").cast("timestamp").alias("ts")).union(
        expenses.select(F.col("expense_timestamp").cast("timestamp"))
    )
    time_id = timekeys.time_id(F.col("ts"))
    both = F.explode(F.array(time_id, timekeys.day_key(time_id)))
    keys = stamps.where("ts is not null").select(both.alias("time_id")).distinct()
    return _time_rows(_unless_known(keys, existing, ["time_id"]))


def last_ticks(ticks: DataFrame) -> DataFrame:
    """The last tick of each pair and calendar day; of equal times the greatest rate."""
    pair = ["base_cncy", "quote_cncy"]
    day = F.to_date("fx_timestamp").alias("__day")
    latest = ticks.where("fx_timestamp is not null").groupBy(*pair, day).agg(
        F.max_by(F.struct("fx_timestamp", "rate"), F.struct("fx_timestamp", "rate")).alias("__t")
    )
    return latest.select(*pair, "__t.fx_timestamp", "__t.rate")


def promote_transactions(
    transactions: DataFrame,
    existing: DataFrame | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Native amount net of fee, once per tx_id; optionally only times in [start, end)."""
    rows = transactions.where("tx_timestamp is not null")
    if start is not None:
        rows = rows.where(F.col("tx_timestamp") >= F.lit(start))
    if end is not None:
        rows = rows.where(F.col("tx_timestamp") < F.lit(end))
    facts = rows.select(
        "tx_id",
        (F.col("amount") - F.coalesce("fee_amount", F.lit(0))).cast("decimal(18,4)").alias("amount"),
        "c_id",
        timekeys.time_id(F.col("tx_timestamp")).alias("time_id"),
        F.trim("base_cncy").alias("cncy"),
    )
    return _unless_known(facts, existing, ["tx_id"])


def transaction_windows(
    transactions: DataFrame, batch_days: int = 60
) -> Iterator[tuple[datetime, datetime]]:
    """Consecutive [start, end) windows covering all transaction times."""
    first, last = transactions.agg(F.min("tx_timestamp"), F.max("tx_timestamp")).first()
    while first is not None and first <= last:
        yield first, first + timedelta(days=batch_days)
        first += timedelta(days=batch_days)


def staged_windows(transactions: DataFrame, first: datetime, batch_days: int = 60) -> DataFrame:
    """The transactions written once, partitioned by their `window`: consecutive spans of
    `batch_days` from `first` on, numbered from 0. Rows without a time are left out."""
    spark = transactions.sparkSession
    width = batch_days * timekeys.MICROS_PER_DAY
    since = F.unix_micros("tx_timestamp") - F.unix_micros(F.lit(first))
    number = F.floor(since / F.lit(width)).cast("int")
    windowed = transactions.where("tx_timestamp is not null").withColumn("window", number)
    path = scratch_path(spark, "windows")
    windowed.hint("rebalance", F.col("window")).write.partitionBy("window").parquet(path)
    return spark.read.schema(windowed.schema).parquet(path)


def promote_expenses(expenses: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    facts = expenses.where("expense_timestamp is not null").select(
        "expense_id",
        F.col("amount").cast("decimal(18,4)").alias("amount"),
        "cncy",
        "c_id",
        timekeys.time_id(F.col("expense_timestamp")).alias("time_id"),
        "category_id",
    )
    return _unless_known(facts, existing, ["expense_id"])


def promote_conversions(
    transactions: DataFrame, ticks: DataFrame, existing: DataFrame | None = None, **tuning: int
) -> DataFrame:
    """Transactions with a quote currency and an earlier tick; the others wait for one."""
    waiting = _unless_known(transactions.where("quote_cncy is not null"), existing, ["tx_id"])
    matched = asof.match_fx_rates(
        waiting.select("tx_id", "base_cncy", "quote_cncy", "amount", "fee_amount", "tx_timestamp"),
        ticks,
        how="inner",
        **tuning,
    )
    return conversion_rows(matched).drop("tx_timestamp")


def conversion_rows(matched: DataFrame) -> DataFrame:
    """Conversion facts, with their transaction's time, of transactions matched with a rate."""
    return matched.select(
        ids.surrogate_id("cx", F.col("tx_id")).alias("cx_id"),
        F.col("amount").cast("decimal(18,4)").alias("base_amount"),
        F.coalesce(F.col("fee_amount").cast("decimal(16,4)"), F.lit(0).cast("decimal(16,4)")).alias("fee_amount"),
        fx_key().alias("fx_id"),
        "tx_id",
        "tx_timestamp",
    )


def drop_duplicate_times(times: DataFrame) -> DataFrame:
    """Keep the smallest time_id per t_stamp."""
    return joins.dedupe(times, ["t_stamp"], prefer=["time_id"]).select(*times.columns)
