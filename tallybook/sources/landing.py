"""Loading into the raw tables: rows whose key is already stored are skipped."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import ids
from tallybook.operators import joins, quarantine
from tallybook.schemas import TABLES
from tallybook.session import RowCounter, materialize
from tallybook.sources.tables import TableStore, period_of

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Loaded:
    """Rows handed in and rows that were new."""

    received: int
    inserted: int


def _now() -> datetime:
    return datetime.now(timezone.utc)


def append_new(store: TableStore, name: str, rows: DataFrame, prefer: list[str] | None = None) -> Loaded:
    """Append the rows whose key is new, one per key. Running it again adds nothing.

    The batch is evaluated once, into the scratch folder. Stored keys are then looked up where
    the batch's keys can be: in the day partitions of the batch if the table is partitioned by
    the day of a key column, else in the buckets of its key index. Keys with nulls are equal to
    keys with the same nulls.
    """
    spec = TABLES[name]
    keys = list(spec.indexed or spec.key)
    received, distinct, added = RowCounter(), RowCounter(), RowCounter()
    conformed = store.conform(name, rows)
    once = joins.dedupe(received.watch(conformed), keys, prefer).select(*conformed.columns)
    staged = materialize(distinct.watch(once), "batch")
    if spec.indexed and not store.has_keys(name):
        # Nothing is stored, so all of the batch is new.
        if distinct.rows:
            store.append_indexed(name, staged, _days(name, staged))
        return Loaded(received.rows, distinct.rows)
    if spec.indexed:
        buckets = store.buckets_of(name, staged)
        stored = store.known_keys(name, buckets)
    elif spec.day_of in keys:
        stored = store.read(name, days=_days(name, staged))
    else:
        stored = store.read(name)
    stored = joins.restrict(stored, staged, keys, null_safe=True)
    new = joins.not_in(staged, stored, keys, null_safe=True)
    if spec.indexed:
        # Read twice, by the table and its index.
        new = materialize(added.watch(new), "new")
        if added.rows:
            store.append_indexed(name, new, _days(name, new))
    else:
        store.append(name, added.watch(new))
    return Loaded(received.rows, added.rows)


def _days(name: str, rows: DataFrame) -> set[date]:
    """Partitions that rows belong to: one value for each calendar day."""
    days = rows.select(period_of(name, rows).alias("day")).distinct()
    return {r.day for r in days.collect() if r.day is not None}


def append_fx_rates(store: TableStore, ticks: DataFrame, ingested_at: datetime | None = None) -> Loaded:
    """Ticks with an unseen (base, quote, timestamp); `source` is `api` unless given."""
    source = F.coalesce("source", F.lit("api")) if "source" in ticks.columns else F.lit("api")
    rows = ticks.withColumns(
        {
            "source": source,
            "fx_rate_id": ids.surrogate_id("tick", F.col("base_cncy"), F.col("quote_cncy"), F.col("fx_timestamp")),
            "ingestion_timestamp": F.lit(ingested_at or _now()),
        }
    )
    return append_new(store, "raw.fx_rate", rows, prefer=["rate"])


def append_transactions(
    store: TableStore, rows: DataFrame, batch_id: str | None = None, ingested_at: datetime | None = None
) -> Loaded:
    stamped = rows.withColumns(
        {"batch_id": F.lit(batch_id).cast("string"), "ingestion_timestamp": F.lit(ingested_at or _now())}
    )
    return append_new(store, "raw.transaction_event", stamped, prefer=["tx_timestamp"])


def append_expenses(store: TableStore, rows: DataFrame, ingested_at: datetime | None = None) -> Loaded:
    stamped = rows.withColumn("ingestion_timestamp", F.lit(ingested_at or _now()))
    return append_new(store, "raw.expense_event", stamped, prefer=["expense_timestamp"])


def append_quarantine(
    store: TableStore, violating: DataFrame, batch_id: str | None, ingested_at: datetime | None = None
) -> Loaded:
    """Violations as quarantine records; (batch, transaction, code) is unique with nulls equal."""
    records = quarantine.quarantine_records(
        violating, F.lit(batch_id).cast("string"), F.lit(ingested_at or _now())
    )
    return append_new(store, "raw.quarantine_event", records, prefer=["quarantine_id"])


def load_all(
    store: TableStore,
    ticks: DataFrame,
    transactions: DataFrame,
    expenses: DataFrame | None = None,
    violating: DataFrame | None = None,
    batch_id: str | None = None,
    ingested_at: datetime | None = None,
) -> dict[str, int]:
    """Load in dependency order; returns the rows handed in per table, 0 for absent ones."""
    nothing = Loaded(0, 0)
    return {
        "fx_rates": append_fx_rates(store, ticks, ingested_at).received,
        "transactions": append_transactions(store, transactions, batch_id, ingested_at).received,
        "expenses": (append_expenses(store, expenses, ingested_at) if expenses is not None else nothing).received,
        "quarantine": (
            append_quarantine(store, violating, batch_id, ingested_at) if violating is not None else nothing
        ).received,
    }


def _one_row(store: TableStore, name: str, record: dict) -> Loaded:
    schema = TABLES[name].schema
    row = tuple(record.get(f.name) for f in schema)
    return append_new(store, name, store.spark.createDataFrame([row], schema))


def log_batch(
    store: TableStore,
    batch_id: str,
    window_start: datetime,
    window_end: datetime,
    rows_received: int,
    rows_loaded: int,
    rows_quarantined: int,
    noise_level: str,
    run_timestamp: datetime | None = None,
) -> bool:
    """Record one run. A failure is logged, never raised: the load itself has succeeded."""
    record = {
        "batch_id": batch_id, "run_timestamp": run_timestamp or _now(), "window_start": window_start,
        "window_end": window_end, "rows_received": rows_received, "rows_loaded": rows_loaded,
        "rows_quarantined": rows_quarantined, "noise_level": noise_level,
    }
    try:
        return _one_row(store, "raw.batch_log", record).inserted == 1
    except Exception:
        logger.warning("batch log entry for %s was not written", batch_id, exc_info=True)
        return False


def log_pipeline_run(store: TableStore, record: dict) -> bool:
    """Header row of a batch; a bad record raises."""
    missing = [c for c in TABLES["raw.pipeline_run"].required if record.get(c) is None]
    if missing:
        raise ValueError(f"pipeline run record lacks {missing}")
    if record["noise_level"] not in refdata.NOISE_LEVELS:
        raise ValueError(f"noise_level must be one of {list(refdata.NOISE_LEVELS)}")
    filled = {**record, "run_timestamp": record.get("run_timestamp") or _now()}
    return _one_row(store, "raw.pipeline_run", filled).inserted == 1


def apply_resolution(store: TableStore, resolution: quarantine.Resolution) -> dict[str, int]:
    """Append requeued rows to the raw transactions and the audit rows.

    A transaction already stored is not inserted a second time. Corrected rows that still break
    a rule are quarantined again with their corrections, one new record per broken rule, and
    records without a transaction stay unresolved, so nothing selected is lost. The audit rows
    come last: a run that died before is repaired by running again.
    """
    requeued = append_new(store, "raw.transaction_event", resolution.requeued)
    again = append_quarantine(store, resolution.still_bad.drop("batch_id", "ingestion_timestamp"), resolution.batch_id)
    fit = joins.not_in(resolution.audit, resolution.unfit, ["quarantine_id"])
    audit = append_new(store, "raw.quarantine_resolution", fit)
    return {"resolved": audit.received, "requeued": requeued.inserted, "quarantined": again.inserted}


def write_report_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
