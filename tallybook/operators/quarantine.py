"""Quarantine records, the unified quarantine log, and the resolve/requeue workflow."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import ids, timekeys
from tallybook.operators import joins
from tallybook.operators.normalize import RULES, Rule, explode_flags, flag_rules, n_broken

EVENT_COLUMNS = [
    "quarantine_id", "tx_id", "c_id", "base_cncy", "quote_cncy", "amount", "fee_amount",
    "tx_timestamp", "failure_code", "failure_reason", "batch_id", "dirty_value",
    "failure_count", "ingestion_timestamp",
]
LOG_COLUMNS = [
    "tx_id", "c_id", "base_cncy", "tx_timestamp", "amount", "fee_amount", "quote_cncy",
    "ingestion_timestamp", "batch_id", "failure_code", "failure_reason", "source",
]

# Rules over rows that reached the raw table. A null currency breaks none of them.
# Codes and reasons must equal those of stored records.
RAW_RULES = [
    Rule("NULL_COMPANY_ID", "c_id is null", "c_id is null"),
    Rule("INVALID_AMOUNT", "amount is null or non-positive", "amount is null or amount <= 0"),
    Rule(
        "UNKNOWN_COMPANY",
        "c_id not found in analytics.d_company",
        "c_id is not null and __company is null",
    ),
    Rule(
        "INVALID_BASE_CURRENCY",
        "base_cncy not found in analytics.d_currency",
        "base_cncy is not null and __currency is null",
    ),
    Rule(
        "DUPLICATE_TX_ID",
        "tx_id appears more than once in raw.transaction_event",
        "__copies > 1",
    ),
    Rule("NULL_TIMESTAMP", "tx_timestamp is null", "tx_timestamp is null"),
]


def quarantine_records(
    violating: DataFrame, batch_id: Column, ingestion_timestamp: Column
) -> DataFrame:
    """Rows of the quarantine table from one row per violation.

    Ids are hashes of (batch, transaction, code), so loading a batch again gives the same
    ids. `failure_count` is the number of records of the transaction within the batch.
    """
    missing = [c for c in ("failure_code", "failure_reason") if c not in violating.columns]
    if missing:
        raise ValueError(f"quarantine rows are missing required columns: {missing}")
    optional = ["tx_id", "c_id", "base_cncy", "quote_cncy", "amount", "fee_amount", "tx_timestamp", "dirty_value"]
    rows = violating.withColumns(
        {c: F.lit(None).cast("string") for c in optional if c not in violating.columns}
    ).withColumns({"batch_id": batch_id, "ingestion_timestamp": ingestion_timestamp})
    counted = joins.attach_group_size(rows, ["batch_id", "tx_id"], "failure_count", null_group=False)
    return counted.withColumn(
        "quarantine_id", ids.quarantine_id(F.col("batch_id"), F.col("tx_id"), F.col("failure_code"))
    ).select(*EVENT_COLUMNS)


def new_records(records: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Records to append: one per (batch, tx, code) with nulls equal, none stored before."""
    once = joins.dedupe(records, ["batch_id", "tx_id", "failure_code"], prefer=["quarantine_id"])
    once = once.select(*records.columns)
    if existing is None:
        return once
    return joins.not_in(once, existing, ["batch_id", "tx_id", "failure_code"], null_safe=True)


def raw_violations(
    raw: DataFrame, companies: DataFrame, currencies: DataFrame, rules: list[Rule] | None = None
) -> DataFrame:
    """One row per broken rule over raw transactions, in one scan."""
    known = companies.select("c_id", F.lit(True).alias("__company"))
    codes = currencies.select("cncy_code", F.lit(True).alias("__currency"))
    checked = joins.attach(raw, known, [("c_id", "c_id")], ["__company"])
    checked = joins.attach(checked, codes, [("base_cncy", "cncy_code")], ["__currency"])
    checked = joins.attach_group_size(checked, ["tx_id"], "__copies")
    rules = RAW_RULES if rules is None else rules
    exploded = explode_flags(flag_rules(checked, rules), raw.columns, rules)
    return exploded.drop("dirty_value").withColumn("source", F.lit("sql_layer"))


def quarantine_log(
    events: DataFrame, raw: DataFrame, companies: DataFrame, currencies: DataFrame
) -> DataFrame:
    """Quarantined feed rows and rule violations of raw rows in one shape."""
    stored = events.withColumn("source", F.lit("python_layer"))
    return stored.select(*LOG_COLUMNS).unionByName(
        raw_violations(raw, companies, currencies).select(*LOG_COLUMNS)
    )


# --- reading ---------------------------------------------------------------


def unresolved(
    events: DataFrame, resolutions: DataFrame, companies: DataFrame, codes: list[str] | str,
    iso: bool = False,
) -> DataFrame:
    """Records with one of `codes` and no resolution, with the company name, newest first.

    `codes` may be one text with commas between the codes; blanks around them and empty ones
    don't count. With `iso`, times are ISO text.
    """
    wanted = codes.split(",") if isinstance(codes, str) else codes
    open_rows = joins.not_in(
        events.where(F.col("failure_code").isin([c.strip() for c in wanted if c.strip()])),
        resolutions,
        ["quarantine_id"],
    )
    named = joins.attach(open_rows, companies, [("c_id", "c_id")], ["c_name"])
    newest_first = named.orderBy(F.desc("ingestion_timestamp"), "quarantine_id")
    if not iso:
        return newest_first
    return newest_first.withColumns({c: timekeys.iso_text(F.col(c)) for c in ("tx_timestamp", "ingestion_timestamp")})


def rows_page(
    log: DataFrame,
    companies: DataFrame,
    page: int = 1,
    page_size: int = 20,
    failure_code: str | None = None,
    source: str | None = None,
    since: datetime | None = None,
    order: tuple[str, ...] = ("quarantine_id",),
    after: tuple | None = None,
) -> DataFrame:
    """One page, newest first, each row with the total number of matching rows.

    Deep pages are reached with `after`, the (ingestion_timestamp, *order) values of the
    last row seen, which filters instead of skipping rows.
    """
    if page < 1 or not 1 <= page_size <= 100:
        raise ValueError("page must be at least 1 and page_size between 1 and 100")
    if source not in (None, "python_layer", "sql_layer"):
        raise ValueError(f"unknown source {source!r}")
    rows = log
    if failure_code is not None:
        rows = rows.where(F.col("failure_code") == failure_code)
    if source is not None:
        rows = rows.where(F.col("source") == source)
    if since is not None:
        rows = rows.where(F.col("ingestion_timestamp") >= F.lit(since))
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    if after is not None:
        stamp, *rest = after
        rows = rows.where(
            (F.col("ingestion_timestamp") < F.lit(stamp))
            | (
                (F.col("ingestion_timestamp") == F.lit(stamp))
                & (F.struct(*order) > F.struct(*map(F.lit, rest)))
            )
        )
    paged = rows.orderBy(F.desc("ingestion_timestamp"), *order)
    if after is None:
        paged = paged.offset((page - 1) * page_size)
    named = joins.attach(paged.limit(page_size), companies, [("c_id", "c_id")], ["c_name"])
    return named.withColumn("total", total.scalar())


def summary(events: DataFrame) -> DataFrame:
    """Violations per code, most frequent first."""
    return (
        events.groupBy("failure_code")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.lit("python_layer").alias("source"), "failure_code", "count")
        .withColumn("cross_layer_contamination", F.lit(0))
        .orderBy(F.desc("count"), "failure_code")
    )


def health(events: DataFrame, raw: DataFrame, now: datetime, recent_hours: int = 2) -> DataFrame:
    """Totals, share of raw rows without a record, and records of the last hours."""
    since = F.lit(now) - F.make_dt_interval(F.lit(0), F.lit(recent_hours))
    of_events = events.agg(
        F.count(F.lit(1)).alias("total_quarantined"),
        F.count_if(F.col("ingestion_timestamp") >= since).alias("new_since_last_run"),
    )
    of_raw = raw.agg(
        F.count(F.lit(1)).alias("total_raw"), F.max("ingestion_timestamp").alias("latest_ingestion")
    )
    both = joins.side_by_side(of_events, of_raw)
    clean = F.col("total_raw") - F.col("total_quarantined")
    rate = F.round(clean.cast("decimal(20,0)") * 100 / F.nullif("total_raw", F.lit(0)), 2)
    return both.select(
        "total_quarantined",
        "total_raw",
        clean.alias("clean_rows"),
        F.coalesce(rate, F.lit(100)).cast("decimal(20,2)").alias("pass_rate"),
        "new_since_last_run",
        "latest_ingestion",
    )


def resolution_stats(resolutions: DataFrame) -> DataFrame:
    return resolutions.agg(
        F.count(F.lit(1)).alias("total_resolved"),
        F.count_if(F.col("action") == "requeued").alias("requeued"),
        F.count_if(F.col("action") == "deleted").alias("deleted"),
    )


def by_code(events: DataFrame) -> DataFrame:
    """Violations and distinct transactions per code.

    The distinct count is taken in two grouped steps, so one frequent code is not counted
    in one task.
    """
    per_tx = events.groupBy("failure_code", "tx_id").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_tx.groupBy("failure_code")
        .agg(F.sum("n").alias("violations"), F.count("tx_id").alias("unique_transactions"))
        .orderBy(F.desc("violations"), "failure_code")
    )


def multiple_failures(events: DataFrame, limit: int | None = 10) -> DataFrame:
    """Transactions with more than one record and the codes of all their records, sorted.

    Codes are counted before they are listed, and spelled out for the returned rows only.
    """
    per_code = events.groupBy("tx_id", "failure_code").agg(F.count(F.lit(1)).alias("n"))
    found = (
        per_code.groupBy("tx_id")
        .agg(
            F.sum("n").alias("failure_count"),
            F.sort_array(F.collect_list(F.struct("failure_code", "n"))).alias("parts"),
        )
        .where("failure_count > 1")
        .orderBy(F.desc("failure_count"), "tx_id")
    )
    top = found if limit is None else found.limit(limit)
    repeated = F.transform("parts", lambda p: F.array_repeat(p["failure_code"], p["n"].cast("int")))
    return top.select("tx_id", "failure_count", F.flatten(repeated).alias("codes"))


def latest_batches(events: DataFrame, limit: int = 5) -> DataFrame:
    return (
        events.groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("ingestion_timestamp").alias("run_time"))
        .orderBy(F.desc("run_time"), "batch_id")
        .limit(limit)
    )


# --- resolving -------------------------------------------------------------


@dataclass(frozen=True)
class Resolution:
    """`requeued`: corrected raw rows; `still_bad`: corrections that break a rule again;
    `audit`: one row per selected record, whatever became of it; `unfit`: ids of records without
    a transaction, which can't be requeued; `batch_id`: the batch of what is quarantined again."""

    requeued: DataFrame
    still_bad: DataFrame
    audit: DataFrame
    unfit: DataFrame
    batch_id: str


def resolve(
    events: DataFrame,
    selected: DataFrame,
    action: str,
    resolved_by: str,
    resolved_at: datetime,
    new_c_id: str | None = None,
    new_amount=None,
    new_timestamp: datetime | None = None,
    rules: list[Rule] | None = None,
) -> Resolution:
    """Delete or requeue the records whose `quarantine_id` is in `selected`.

    A requeue needs at least one corrected value, which replaces the stored one. Several
    records of one transaction give one raw row, and corrected rows pass the rules again.
    """
    if action not in refdata.RESOLUTION_ACTIONS:
        raise ValueError(f"action must be one of {refdata.RESOLUTION_ACTIONS}")
    corrections = {"c_id": new_c_id, "amount": new_amount, "tx_timestamp": new_timestamp}
    if action == "requeued" and all(v is None for v in corrections.values()):
        raise ValueError("at least one corrected value is required for a requeue")
    wanted = selected.select("quarantine_id").distinct()
    now = F.lit(resolved_at).cast("timestamp")
    audit = wanted.select(
        ids.surrogate_id("resolution", F.col("quarantine_id"), F.lit(action), now).alias("resolution_id"),
        "quarantine_id",
        F.lit(action).alias("action"),
        F.lit(new_c_id).cast("string").alias("new_c_id"),
        F.lit(resolved_by).alias("resolved_by"),
        now.alias("resolved_at"),
    )
    columns = ["tx_id", "c_id", "base_cncy", "quote_cncy", "amount", "fee_amount", "tx_timestamp", "batch_id"]
    chosen = events.join(wanted, "quarantine_id", "left_semi")
    rows = chosen.where("tx_id is not null").select(*columns)
    unfit = chosen.where("tx_id is null").select("quarantine_id")
    if action == "deleted":
        rows, unfit = rows.limit(0), unfit.limit(0)
    types = {f.name: f.dataType for f in rows.schema}
    for name, value in corrections.items():
        if value is not None:
            rows = rows.withColumn(name, F.lit(value).cast(types[name]))
    once = joins.dedupe(rows, ["tx_id"]).withColumn("ingestion_timestamp", now)
    rules = RULES if rules is None else rules
    flagged = flag_rules(once, rules)
    good = flagged.where(n_broken() == 0).select(*once.columns)
    bad = explode_flags(flagged, once.columns, rules).drop("dirty_value")
    again = refdata._uuid5(refdata.SURROGATE_NAMESPACE, f"requeue:{resolved_by}:{resolved_at.isoformat()}")
    return Resolution(good, bad, audit, unfit, again)
