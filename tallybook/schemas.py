"""Table schemas, keys and storage layout."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

AMOUNT = T.DecimalType(18, 4)
FEE = T.DecimalType(16, 4)
RATE = T.DecimalType(14, 7)
GROWTH = T.DecimalType(7, 4)


@dataclass(frozen=True)
class TableSpec:
    ddl: str
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    # Column whose calendar day partitions the files, if any. It need not be stored itself.
    day_of: str | None = None
    # Calendar period of a partition, where a day would hold too few rows.
    period: str = "day"
    # Column whose values partition the files, if any.
    value_of: str | None = None
    # Columns of the key index beside the table, if it has one.
    indexed: tuple[str, ...] = ()
    # Columns files are sorted by inside a partition, so row-group statistics prune.
    sort: tuple[str, ...] = field(default_factory=tuple)

    @property
    def schema(self) -> T.StructType:
        return T._parse_datatype_string(self.ddl)


TABLES: dict[str, TableSpec] = {
    "raw.fx_rate": TableSpec(
        "fx_rate_id string, base_cncy string, quote_cncy string, fx_timestamp timestamp, "
        "rate decimal(14,7), ingestion_timestamp timestamp, source string",
        key=("base_cncy", "quote_cncy", "fx_timestamp"),
        required=("base_cncy", "quote_cncy", "fx_timestamp", "rate"),
        day_of="fx_timestamp",
        sort=("base_cncy", "quote_cncy", "fx_timestamp"),
    ),
    "raw.transaction_event": TableSpec(
        "tx_id string, c_id string, base_cncy string, tx_timestamp timestamp, "
        "amount decimal(18,4), ingestion_timestamp timestamp, quote_cncy string, "
        "fee_amount decimal(16,4), batch_id string",
        key=("tx_id",),
        required=(
            "tx_id", "c_id", "base_cncy", "quote_cncy", "amount", "fee_amount", "tx_timestamp",
        ),
        day_of="ingestion_timestamp",
        sort=("tx_timestamp",),
        indexed=("tx_id",),
    ),
    "raw.expense_event": TableSpec(
        "expense_id string, c_id string, cncy string, expense_timestamp timestamp, "
        "amount decimal(18,4), category_id string, ingestion_timestamp timestamp",
        key=("expense_id",),
        required=("expense_id", "c_id", "cncy", "expense_timestamp", "amount", "category_id"),
        day_of="ingestion_timestamp",
        sort=("expense_timestamp",),
        indexed=("expense_id",),
    ),
    "raw.quarantine_event": TableSpec(
        "quarantine_id string, tx_id string, c_id string, base_cncy string, quote_cncy string, "
        "amount decimal(18,4), fee_amount decimal(16,4), tx_timestamp timestamp, "
        "failure_code string, failure_reason string, batch_id string, dirty_value string, "
        "failure_count int, ingestion_timestamp timestamp",
        key=("quarantine_id",),
        required=("failure_code", "failure_reason"),
        day_of="ingestion_timestamp",
        indexed=("batch_id", "tx_id", "failure_code"),
    ),
    "raw.quarantine_resolution": TableSpec(
        "resolution_id string, quarantine_id string, action string, new_c_id string, "
        "resolved_by string, resolved_at timestamp",
        key=("resolution_id",),
        required=("quarantine_id", "action"),
    ),
    "raw.batch_log": TableSpec(
        "batch_id string, run_timestamp timestamp, window_start timestamp, window_end timestamp, "
        "rows_received bigint, rows_loaded bigint, rows_quarantined bigint, noise_level string",
        key=("batch_id",),
    ),
    "raw.pipeline_run": TableSpec(
        "batch_id string, noise_level string, n_transactions bigint, fx_source string, "
        "run_timestamp timestamp, duration_seconds decimal(8,2), clean_count bigint, "
        "quarantine_count bigint, notes string",
        key=("batch_id",),
        required=("batch_id", "noise_level", "n_transactions", "fx_source"),
    ),
    "analytics.d_currency": TableSpec("cncy_code string, cncy_name string", key=("cncy_code",)),
    "analytics.d_industry": TableSpec(
        "industry_id string, name string, display_cncy string", key=("industry_id",)
    ),
    "analytics.d_company": TableSpec(
        "c_id string, c_name string, hq_country string, default_cncy string, industry_id string",
        key=("c_id",),
    ),
    "analytics.d_expense_category": TableSpec(
        "category_id string, category_name string", key=("category_id",)
    ),
    "analytics.d_time": TableSpec(
        "time_id bigint, t_stamp timestamp, fisc_quarter smallint, day_of_week smallint",
        key=("time_id",),
        day_of="t_stamp",
        sort=("time_id",),
    ),
    "analytics.f_fx_rate": TableSpec(
        "fx_id string, rate decimal(14,7), base_cncy string, quote_cncy string",
        key=("fx_id",),
        value_of="base_cncy",
        sort=("quote_cncy", "rate"),
    ),
    "analytics.f_transaction": TableSpec(
        "tx_id string, amount decimal(18,4), c_id string, time_id bigint, cncy string",
        key=("tx_id",),
        day_of="time_id",
        sort=("time_id",),
    ),
    "analytics.f_conversion": TableSpec(
        "cx_id string, base_amount decimal(18,4), fee_amount decimal(16,4), fx_id string, "
        "tx_id string",
        key=("tx_id",),
        # The transaction's time, which appended rows carry.
        day_of="tx_timestamp",
    ),
    "analytics.f_expense": TableSpec(
        "expense_id string, amount decimal(18,4), cncy string, c_id string, time_id bigint, "
        "category_id string",
        key=("expense_id",),
        day_of="time_id",
        sort=("time_id",),
    ),
    "analytics.f_industry": TableSpec(
        "industry_id string, time_id bigint, total_revenue decimal(18,4), "
        "total_expenses decimal(18,4), net_profit decimal(18,4), transaction_count bigint, "
        "avg_revenue_per_co decimal(18,4), revenue_growth_rate decimal(7,4), company_count int",
        key=("industry_id", "time_id"),
        day_of="time_id",
        period="month",
    ),
    # All company keys ever given.
    "state.company_key": TableSpec(
        "company_key string, c_id string, c_name string, hq_country string, default_cncy string, industry_id string, weight double",
        key=("company_key",),
    ),
    # Per source of polls: the time of its last accepted poll, and the polls not yet whole.
    "state.poll_mark": TableSpec("source string, mark timestamp", key=("source",)),
    "state.poll_pending": TableSpec(
        "source string, poll_id string, polled_at timestamp, n_quotes int, base_cncy string, quote_cncy string, rate decimal(14,7)",
        key=("source", "poll_id", "base_cncy", "quote_cncy"),
    ),
    # Carried from one transform to the next.
    "state.waiting_conversion": TableSpec(
        "tx_id string, base_cncy string, quote_cncy string, amount decimal(18,4), fee_amount decimal(16,4), tx_timestamp timestamp",
        key=("tx_id",),
    ),
    # The last tick of each pair and day.
    "state.fx_close": TableSpec(
        "base_cncy string, quote_cncy string, fx_timestamp timestamp, rate decimal(14,7)",
        key=("base_cncy", "quote_cncy", "fx_timestamp"),
    ),
}
