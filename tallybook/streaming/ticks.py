"""Continuous ingestion of FX ticks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallybook.functions import parsing, timekeys
from tallybook.operators import joins, quality
from tallybook.session import materialize
from tallybook.sources import landing, versions
from tallybook.sources.tables import TableStore

PAIR_TIME = ["base_cncy", "quote_cncy", "fx_timestamp"]
LATEST = "base_cncy string, quote_cncy string, rate decimal(14,6), fx_timestamp timestamp"


def parse_quotes(quotes: DataFrame, quote_cncy: str = "USD") -> DataFrame:
    """(symbol `EUR/USD`, rate text, fx_timestamp) to ticks.

    Quotes with an unreadable rate or in another currency than `quote_cncy` are dropped; a
    symbol without a slash is quoted in it.
    """
    rated = parsing.parse_numbers(quotes.withColumn("rate", F.col("rate").cast("string")), "rate")
    quoted = F.upper(F.trim(F.split_part("symbol", F.lit("/"), F.lit(2))))
    return rated.where(F.col("rate").isNotNull() & quoted.isin(quote_cncy, "")).select(
        F.split_part("symbol", F.lit("/"), F.lit(1)).alias("base_cncy"),
        F.lit(quote_cncy).alias("quote_cncy"),
        *[c for c in quotes.columns if c not in ("symbol", "rate")],
        F.round(F.col("rate").cast("decimal(30,12)"), 7).cast("decimal(14,7)").alias("rate"),
    )


def newest_stored(store: TableStore) -> datetime | None:
    """Time of the newest stored tick; reads the newest day's partition only."""
    days = store.days("raw.fx_rate")
    if not days:
        return None
    return store.read("raw.fx_rate", days={max(days)}).agg(F.max("fx_timestamp")).first()[0]


def stream_fx_ticks(
    ticks: DataFrame,
    store: TableStore,
    checkpoint: str,
    delay: str = "10 minutes",
    bounds: dict[str, tuple[float, float]] | None = None,
    skip_seen: bool = False,
    on_batch: Callable[[int, landing.Loaded], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Land a stream of ticks: repeats are dropped, polls with an implausible rate refused.

    A tick later than `delay` behind the newest one is dropped. With `skip_seen`, ticks not
    newer than the newest stored one are dropped as well, which is how a restarted poller
    skips what it has already written. Replayed micro-batches add nothing. Ticks of one time
    are one poll, judged by what a micro-batch holds of it; `stream_polls` judges polls whole.
    """
    fresh = ticks.withWatermark("fx_timestamp", delay).dropDuplicatesWithinWatermark(PAIR_TIME)

    def land(batch: DataFrame, epoch: int) -> None:
        if skip_seen and (newest := newest_stored(store)) is not None:
            batch = batch.where(F.col("fx_timestamp") > F.lit(newest))
        loaded = landing.append_fx_rates(store, quality.validate_rate_bounds(batch, "fx_timestamp", bounds))
        if on_batch:
            on_batch(epoch, loaded)

    writer = fresh.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# --- polls -------------------------------------------------------------------

POLL = ["source", "poll_id"]
POLL_COLUMNS = [*POLL, "polled_at", "n_quotes", "base_cncy", "quote_cncy", "rate"]


@dataclass(frozen=True)
class Judged:
    """Quotes of accepted and of refused polls, those that still wait, and the new marks."""

    accepted: DataFrame
    refused: DataFrame
    pending: DataFrame
    marks: DataFrame


def judge_polls(
    arrived: DataFrame,
    pending: DataFrame,
    marks: DataFrame,
    delay_seconds: int = 600,
    bounds: dict[str, tuple[float, float]] | None = None,
) -> Judged:
    """Judge the polls that are whole, with the quotes that waited from earlier arrivals.

    A poll is whole when it has `n_quotes` pairs. It is seen or late, and ignored, if its time
    is not after its source's mark when its first quote arrives. A whole poll with a rate out
    of bounds is refused as a whole; the others are accepted. A source's mark is the time of
    its latest accepted poll. What isn't whole waits until it is `delay_seconds` older than
    the newest quote of its source.
    """
    begun = pending.select(*POLL).distinct().withColumn("__begun", F.lit(True))
    placed = arrived.select(*POLL_COLUMNS).join(begun, POLL, "left").join(marks, "source", "left")
    late = F.coalesce(F.col("mark") >= F.col("polled_at"), F.lit(False)) & F.col("__begun").isNull()
    timely = placed.where(~late).select(*POLL_COLUMNS)
    # A pair quoted twice in one poll counts once.
    quotes = joins.dedupe(timely.unionByName(pending.select(*POLL_COLUMNS)), [*POLL, "base_cncy", "quote_cncy"], ["polled_at", "n_quotes"])
    quotes = materialize(quality.flag_rate_bounds(quotes, bounds), "quotes")
    polls = quotes.groupBy(*POLL).agg(
        F.count(F.lit(1)).alias("__held"),
        F.max("n_quotes").alias("__asked"),
        F.max("polled_at").alias("__at"),
        F.count_if(~F.coalesce("in_bounds", F.lit(False))).alias("__bad"),
    )
    newest = quotes.groupBy("source").agg(F.max("polled_at").alias("__newest"))
    whole, sound = F.col("__held") >= F.col("__asked"), F.col("__bad") == 0
    expired = F.col("__at") < F.col("__newest") - F.make_dt_interval(secs=F.lit(delay_seconds))
    verdict = (
        F.when(whole & sound, "accepted").when(whole, "refused").when(expired, "expired").otherwise("pending").alias("__verdict")
    )
    judged = materialize(polls.join(newest, "source").select(*POLL, "__at", verdict), "judged")
    shown = quotes.drop("in_bounds").join(judged.drop("__at"), POLL)
    best = judged.where("__verdict = 'accepted'").groupBy("source").agg(F.max("__at").alias("mark"))
    return Judged(
        shown.where("__verdict = 'accepted'").select(*POLL_COLUMNS),
        shown.where("__verdict = 'refused'").select(*POLL_COLUMNS),
        shown.where("__verdict = 'pending'").select(*POLL_COLUMNS),
        best.unionByName(marks).groupBy("source").agg(F.max("mark").alias("mark")),
    )


def stream_polls(
    polls: DataFrame,
    store: TableStore,
    checkpoint: str,
    delay_seconds: int = 600,
    bounds: dict[str, tuple[float, float]] | None = None,
    on_batch: Callable[[int, landing.Loaded], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Land a stream of polls (source, poll_id, polled_at, n_quotes, base_cncy, quote_cncy, rate).

    Marks and waiting quotes are tables of the store, published after the ticks of a
    micro-batch have landed, so a replay lands the same ticks again, which adds nothing.
    """

    def land(batch: DataFrame, epoch: int) -> None:
        judged = judge_polls(
            batch, store.read("state.poll_pending"), store.read("state.poll_mark"), delay_seconds, bounds
        )
        ticks = judged.accepted.withColumnRenamed("polled_at", "fx_timestamp")
        loaded = landing.append_fx_rates(store, ticks)
        store.replace("state.poll_pending", judged.pending)
        store.replace("state.poll_mark", judged.marks)
        if on_batch:
            on_batch(epoch, loaded)

    writer = polls.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# --- latest rates ------------------------------------------------------------


def latest_rates(ticks: DataFrame) -> DataFrame:
    """Newest tick per pair over a stream: one state row per pair, for `update` or
    `complete` output."""
    newest = timekeys.newest_rate(F.col("fx_timestamp"), F.col("rate")).alias("t")
    at, rate = timekeys.newest_parts("t")
    return ticks.groupBy("base_cncy", "quote_cncy").agg(newest).select(
        "base_cncy", "quote_cncy", F.round(rate, 6).cast("decimal(14,6)").alias("rate"), at.alias("fx_timestamp")
    )


def keep_latest_rates(ticks: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Publish a version of a small table with the latest rates after every micro-batch."""

    def publish(batch: DataFrame, epoch: int) -> None:
        versions.publish(batch, path)

    writer = latest_rates(ticks).writeStream.outputMode("complete").foreachBatch(publish)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def read_latest_rates(spark: SparkSession, path: str) -> DataFrame:
    """The latest rates as last published."""
    return versions.read(spark, path, LATEST)
