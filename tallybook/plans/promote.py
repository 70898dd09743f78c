"""The incremental transform from raw tables to the star schema, and the ingestion batch.

A run handles what has arrived since the last one. The raw tables are file streams, so the mark of
each source table, which files have been promoted, is kept in the store with the commit of each
run; a run that died is replayed with the same files. What a run needs besides the arrivals is read
by partition: facts and times of the days that arrived, rates of those days, the last rate of each
pair and earlier day (a small table of its own), and the transactions still waiting for a rate.

Steps append only rows whose key is missing in the partitions they go to, and the two carried
tables change by whole versions or in ways that a replay repeats. So a replay adds nothing twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallybook.functions import parsing, timekeys
from tallybook.operators import asof, industry, joins, normalize, quality, star
from tallybook.session import RowCounter, materialize
from tallybook.sources import dimensions, fx_feed, landing
from tallybook.sources.tables import TableStore

SOURCES = ["raw.fx_rate", "raw.transaction_event", "raw.expense_event"]
_STEPS = ("fx_rates", "raw_expenses", "d_time", "transactions", "conversions", "expenses", "industry_rows")
Counts = dict[str, int]


def _append(store: TableStore, name: str, rows: DataFrame) -> int:
    counter = RowCounter()
    store.append(name, counter.watch(rows))
    return counter.rows


def _days_in(rows: DataFrame, column: str) -> set[date]:
    """Calendar days of a timestamp column: one value for each."""
    days = rows.select(F.to_date(column).alias("day")).where("day is not null").distinct()
    return {r.day for r in days.collect()}


def start_transform(
    store: TableStore,
    checkpoint: str | None = None,
    window_days: int | None = None,
    growth: str = "chained",
    on_run: Callable[[Counts], None] | None = None,
    **trigger,
) -> StreamingQuery:
    """Promote what arrives in the raw tables, run by run.

    The marks of one store belong to one checkpoint; without a name it is the store's own.
    """

    def promote(batch: DataFrame, epoch: int) -> None:
        arrived = store.split_arrivals(batch, SOURCES)
        counts = promote_arrivals(store, *(arrived[n] for n in SOURCES), window_days, growth)
        if on_run:
            on_run(counts)

    writer = store.arrivals(SOURCES).writeStream.foreachBatch(promote)
    writer = writer.option("checkpointLocation", checkpoint or f"{store.root}/marks/transform")
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def run_transform(
    store: TableStore,
    expenses: DataFrame | None = None,
    window_days: int | None = None,
    growth: str = "chained",
) -> Counts:
    """Promote everything new; returns the rows added per table.

    `expenses` are landed first. `window_days` promotes the transactions in consecutive time
    windows, each committed on its own.
    """
    total = dict.fromkeys(_STEPS, 0)
    if expenses is not None:
        total["raw_expenses"] = landing.append_expenses(store, expenses).inserted

    def add(counts: Counts) -> None:
        for step, n in counts.items():
            total[step] += n

    start_transform(store, None, window_days, growth, add).awaitTermination()
    return total


def promote_arrivals(
    store: TableStore,
    ticks: DataFrame,
    transactions: DataFrame,
    costs: DataFrame,
    window_days: int | None = None,
    growth: str = "chained",
) -> Counts:
    """One run over arrived ticks, transactions and expenses."""
    counts: Counts = {}
    tx_days, cost_days = _days_in(transactions, "tx_timestamp"), _days_in(costs, "expense_timestamp")

    # Phase 1: rates, times and the midnights of their days.
    counts["fx_rates"] = _append(store, "analytics.f_fx_rate", _new_rates(store, ticks))
    known = store.read("analytics.d_time", days=tx_days | cost_days)
    counts["d_time"] = _append(store, "analytics.d_time", star.promote_times_and_midnights(transactions, costs, known))

    # Phase 2: transactions.
    if window_days is None:
        facts = store.read("analytics.f_transaction", days=tx_days)
        counts["transactions"] = _append(store, "analytics.f_transaction", star.promote_transactions(transactions, facts))
    else:
        counts["transactions"] = promote_windows(store, transactions, window_days)

    # Phase 3: conversions, expenses, daily aggregates.
    counts["conversions"] = _convert(store, ticks, transactions, tx_days)
    facts = store.read("analytics.f_expense", days=cost_days)
    counts["expenses"] = _append(store, "analytics.f_expense", star.promote_expenses(costs, facts))
    counts["industry_rows"] = _refresh_industry(store, growth)
    return counts


def _new_rates(store: TableStore, ticks: DataFrame) -> DataFrame:
    """Rates that aren't stored; only the arrived currencies and their range of rates are searched."""
    found = materialize(star.promote_fx_rates(ticks), "rates")
    # One row for each currency.
    ranges = found.groupBy("base_cncy").agg(F.min("rate").alias("low"), F.max("rate").alias("high")).collect()
    stored = store.read("analytics.f_fx_rate", values=[r.base_cncy for r in ranges])
    if ranges:
        lowest, highest = min(r.low for r in ranges), max(r.high for r in ranges)
        stored = stored.where(F.col("rate").between(F.lit(lowest), F.lit(highest)))
    return joins.not_in(found, stored, ["rate", "base_cncy", "quote_cncy"])


def promote_windows(store: TableStore, transactions: DataFrame, window_days: int = 60) -> int:
    """Promote in windows of `window_days` from the first time on, committing each.

    The transactions are read once, into a staged table partitioned by window; each window then
    reads its own partition, and the stored facts of the days it covers.
    """
    first = transactions.agg(F.min("tx_timestamp")).first()[0]
    if first is None:
        return 0
    staged = star.staged_windows(transactions, first, window_days)
    added = 0
    # One row for each window and day.
    days: dict[int, set[date]] = {}
    for r in staged.select("window", F.to_date("tx_timestamp").alias("day")).distinct().collect():
        days.setdefault(r.window, set()).add(r.day)
    for window in sorted(days):
        rows = staged.where(F.col("window") == window)
        facts = store.read("analytics.f_transaction", days=days[window])
        added += _append(store, "analytics.f_transaction", star.promote_transactions(rows, facts))
    return added


def _convert(store: TableStore, ticks: DataFrame, transactions: DataFrame, tx_days: set[date]) -> int:
    """Convert arrived transactions with any stored tick, and waiting ones with an arrived tick.

    A transaction waits if no tick was stored at or before its time, so of all stored ticks only
    new ones can end its wait.
    """
    closes = _keep_closes(store, ticks)
    waiting = store.read("state.waiting_conversion")
    columns = waiting.columns
    wanted = transactions.where("quote_cncy is not null and tx_timestamp is not null")
    # A replayed run finds its own transactions among the waiting ones.
    arrived = joins.not_in(wanted.select(*columns), waiting, ["tx_id"])
    supply = store.read("raw.fx_rate", days=tx_days).select(*closes.columns)
    if tx_days:
        supply = supply.unionByName(closes.where(F.col("fx_timestamp") < F.lit(max(tx_days))))
    found = asof.match_fx_rates(arrived, supply).unionByName(asof.match_fx_rates(waiting, ticks.select(*closes.columns)))
    matched = materialize(found, "matched")

    conversions = star.conversion_rows(matched.where("rate is not null")).withColumn("day", F.to_date("tx_timestamp"))
    conversions = materialize(conversions, "conversions")
    days = {r.day for r in conversions.select("day").distinct().collect()}
    facts = store.read("analytics.f_transaction", days=days)
    bases = {r.base_cncy for r in matched.where("rate is not null").select(F.trim("base_cncy").alias("base_cncy")).distinct().collect()}
    quality.require_conversion_currency(conversions, facts, store.read("analytics.f_fx_rate", values=bases))
    stored = store.read("analytics.f_conversion", days=days)
    added = _append(store, "analytics.f_conversion", joins.not_in(conversions, stored, ["tx_id"]))

    # Rewritten only if somebody came or went.
    left = matched.where("rate is null").select(*columns)
    if days or left.count() != waiting.count():
        store.replace("state.waiting_conversion", left)
    return added


def _keep_closes(store: TableStore, ticks: DataFrame) -> DataFrame:
    """Last tick of each pair and day, with the arrived ticks; one row for each is stored."""
    stored = store.read("state.fx_close")
    if not ticks.isEmpty():
        store.replace("state.fx_close", star.last_ticks(ticks.select(*stored.columns).unionByName(stored)))
    return store.read("state.fx_close")


def _refresh_industry(store: TableStore, growth: str) -> int:
    """Aggregate the days without a daily row; only their partitions are read."""
    history = store.read("analytics.f_industry")
    day = F.to_date(timekeys.t_stamp(F.col("time_id")))
    done = {r[0] for r in history.select(day).distinct().collect()}
    open_days = store.days("analytics.f_transaction") - done
    if not open_days:
        return 0
    daily = industry.refresh_industry_daily(
        store.read("analytics.f_transaction", days=open_days),
        store.read("analytics.f_expense", days=open_days),
        store.read("analytics.d_company"),
        store.read("analytics.f_industry", until=max(open_days)),
        growth,
    )
    return _append(store, "analytics.f_industry", daily)


def backfill_growth(store: TableStore, days: Iterable[date] | None = None, clamped: bool = False) -> set[date]:
    """Recompute stored growth, of all days or of some, rewriting only partitions that change.

    Rows are compared with the day before them among the stored rows, over the edges of
    partitions. Returns the first days of the partitions that were rewritten.
    """
    stored = store.read("analytics.f_industry", until=None if days is None else max(days))
    filled = (industry.backfill_growth_clamped if clamped else industry.backfill_growth_null_only)(stored)
    if days is not None:
        filled = filled.where(F.to_date(timekeys.t_stamp(F.col("time_id"))).isin(sorted(days)))
    before = stored.select("industry_id", "time_id", F.col("revenue_growth_rate").alias("__old"))
    changed = filled.join(before, ["industry_id", "time_id"]).where(~F.col("revenue_growth_rate").eqNullSafe(F.col("__old")))
    return store.merge("analytics.f_industry", changed.drop("__old"))


def run_batch(
    store: TableStore,
    feed: DataFrame,
    ticks: DataFrame,
    batch_id: str,
    window_start: datetime,
    window_end: datetime,
    noise_level: str = "medium",
    expenses: DataFrame | None = None,
    transform: bool = True,
    mapping: dict[str, str] | None = None,
    fx_source: str | None = None,
    rules: list[normalize.Rule] | None = None,
    names: DataFrame | None = None,
    valid_id=parsing.uuid_text,
) -> dict[str, int | str]:
    """Normalize one feed, load it with its quarantine, log the run, and transform.

    `mapping` names the canonical column of each feed column. With the source `live` only the
    newest of `ticks` for each pair is loaded, with `synthetic` those of the window, without a
    source all of them. `names` and `valid_id` resolve companies, by default the store's.
    """
    begun = time.monotonic()
    dimensions.seed_dimensions(store)
    rates = ticks if fx_source is None else fx_feed.get_fx_rates(fx_source, ticks, window_start, window_end)
    names = dimensions.known_company_names(store) if names is None else names
    result = normalize.normalize_receipts(
        feed, names, rules, valid_id, stage=lambda parsed: materialize(parsed, "parsed"), mapping=mapping
    )
    loaded = landing.load_all(
        store, rates, result.clean, violating=result.quarantine, batch_id=batch_id, ingested_at=window_end
    )
    received = result.annotated.count()
    landing.log_batch(
        store, batch_id, window_start, window_end, received, loaded["transactions"],
        loaded["quarantine"], noise_level, window_end,
    )
    counts: dict[str, int | str] = {"batch_id": batch_id, **loaded}
    if transform:
        counts.update(run_transform(store, expenses))
    landing.log_pipeline_run(
        store,
        {
            "batch_id": batch_id, "noise_level": noise_level, "n_transactions": received, "fx_source": fx_source or "synthetic",
            "run_timestamp": window_end, "duration_seconds": Decimal(str(round(time.monotonic() - begun, 2))),
            "clean_count": loaded["transactions"], "quarantine_count": loaded["quarantine"],
        },
    )
    return counts
