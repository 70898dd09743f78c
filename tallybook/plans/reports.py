"""Reporting, KPI and exposure queries over the star schema.

Facts are aggregated by their own keys before a dimension is joined wherever the result
allows it, so dimension joins see one row per group instead of one per fact.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions import numbers, timekeys
from tallybook.operators import joins

_COMPANY = [("c_id", "c_id")]
_INDUSTRY = [("industry_id", "industry_id")]


def with_time(facts: DataFrame) -> DataFrame:
    """Time attributes of each fact, computed from its key (equal to joining the dimension)."""
    stamp = timekeys.t_stamp(F.col("time_id"))
    return facts.withColumns(
        {
            "t_stamp": stamp,
            "fisc_quarter": timekeys.fisc_quarter(stamp),
            "day_of_week": timekeys.day_of_week(stamp),
        }
    )


def _money(column: str, name: str):
    return F.round(F.sum(column), 2).alias(name)


# --- performance set -------------------------------------------------------


def volume_by_company(tx: DataFrame, companies: DataFrame, industries: DataFrame) -> DataFrame:
    totals = tx.groupBy("c_id").agg(
        F.count("tx_id").alias("tx_count"),
        _money("amount", "total_volume_usd"),
        numbers.exact_avg(F.col("amount"), 2).alias("avg_tx_usd"),
    )
    named = joins.lookup(totals, companies, _COMPANY, ["c_name", "hq_country", "industry_id"], "inner")
    named = joins.lookup(named, industries, _INDUSTRY, ["name"], "inner")
    return named.select(
        "c_id", "c_name", F.col("name").alias("industry"), "hq_country", "tx_count", "total_volume_usd", "avg_tx_usd"
    ).orderBy(F.desc("total_volume_usd"), "c_id")


def volume_by_quarter_currency(tx: DataFrame) -> DataFrame:
    return (
        with_time(tx)
        .groupBy("fisc_quarter", "cncy")
        .agg(
            F.count("tx_id").alias("tx_count"),
            _money("amount", "total_volume_usd"),
            numbers.exact_avg(F.col("amount"), 2).alias("avg_tx_usd"),
        )
        .orderBy("fisc_quarter", F.desc("total_volume_usd"), "cncy")
    )


def conversion_rate_by_pair(tx: DataFrame, conversions: DataFrame, fx: DataFrame) -> DataFrame:
    linked = tx.select("tx_id").join(conversions.select("tx_id", "cx_id", "fx_id"), "tx_id", "left")
    # Rates are distinct values; per-rate counts are joined instead of per-transaction rows.
    per_rate = linked.groupBy("fx_id").agg(F.count("tx_id").alias("t"), F.count("cx_id").alias("c"))
    paired = joins.lookup(per_rate, fx, [("fx_id", "fx_id")], ["base_cncy", "quote_cncy"], "left")
    totals = paired.groupBy("base_cncy", "quote_cncy").agg(
        F.sum("t").alias("total_tx"), F.sum("c").alias("converted_tx")
    )
    share = F.round(F.col("converted_tx").cast("decimal(20,0)") / F.col("total_tx"), 4)
    return totals.withColumn("conversion_rate", share).orderBy(
        F.desc("converted_tx"), "base_cncy", "quote_cncy"
    )


def _converted_company(tx: DataFrame, conversions: DataFrame) -> DataFrame:
    return conversions.join(tx.select("tx_id", "c_id"), "tx_id")


def fee_burden_by_company(tx: DataFrame, conversions: DataFrame, companies: DataFrame) -> DataFrame:
    share = F.col("fee_amount") * 100 / numbers.null_if_zero(F.col("base_amount"))
    totals = _converted_company(tx, conversions).groupBy("c_id").agg(
        F.count("cx_id").alias("conversion_count"),
        numbers.exact_avg(F.col("fee_amount"), 4).alias("avg_fee_usd"),
        numbers.exact_avg(share.cast("decimal(28,14)"), 4).alias("avg_fee_pct"),
    )
    named = joins.lookup(totals, companies, _COMPANY, ["c_name"], "inner")
    return named.select("c_id", "c_name", "conversion_count", "avg_fee_usd", "avg_fee_pct").orderBy(
        F.desc("avg_fee_pct"), "c_id"
    )


def _running(tx: DataFrame, companies: DataFrame, bucket, name: str) -> DataFrame:
    # Stated here, the filter reaches both readers of the buckets, which then run once.
    known = tx.where("c_id is not null")
    per_bucket = known.groupBy("c_id", bucket.alias(name)).agg(F.sum("amount").alias("revenue"))
    total = joins.running_total(
        per_bucket, ["c_id"], name, "revenue", "running", F.date_trunc("month", F.col(name))
    )
    named = joins.attach(total, companies, _COMPANY, ["c_name"], "inner")
    return named.select(
        "c_id",
        "c_name",
        name,
        F.round("revenue", 2).alias("bucket_revenue_usd"),
        F.round("running", 2).alias("running_revenue_usd"),
    )


def running_revenue_by_minute(tx: DataFrame, companies: DataFrame) -> DataFrame:
    return _running(tx, companies, timekeys.minute_of(F.col("time_id")), "minute_bucket")


def running_revenue_by_day(tx: DataFrame, companies: DataFrame) -> DataFrame:
    return _running(tx, companies, timekeys.day_of(F.col("time_id")), "day_bucket")


# --- dashboard datasets ----------------------------------------------------


def industry_benchmark(
    tx: DataFrame, companies: DataFrame, industry_days: DataFrame, grain: str = "exact"
) -> DataFrame:
    """Company revenue next to its industry's average revenue per company.

    `exact` joins on the transaction's own time, so only midnight transactions find a row of
    the daily aggregate; `day` compares whole days.
    """
    key = F.col("time_id") if grain == "exact" else timekeys.day_key(F.col("time_id"))
    revenue = tx.groupBy("c_id", key.alias("time_id")).agg(F.sum("amount").alias("company_revenue"))
    placed = joins.attach(revenue, companies, _COMPANY, ["c_name", "industry_id"], "inner")
    average = industry_days.select("industry_id", "time_id", F.col("avg_revenue_per_co").alias("industry_avg"))
    return placed.join(average, ["industry_id", "time_id"]).select(
        timekeys.t_stamp(F.col("time_id")).alias("t_stamp"), "c_id", "c_name", "company_revenue", "industry_avg"
    )


def expense_detail(
    expenses: DataFrame, companies: DataFrame, industries: DataFrame, categories: DataFrame
) -> DataFrame:
    rows = joins.attach(with_time(expenses), companies, _COMPANY, ["c_name", "industry_id"], "inner")
    rows = joins.attach(rows, industries, _INDUSTRY, ["name"], "inner")
    rows = joins.attach(rows, categories, [("category_id", "category_id")], ["category_name"], "inner")
    return rows.select(
        "expense_id", F.col("amount").alias("expense_amount"), "cncy", "category_name", "c_id", "c_name",
        F.col("name").alias("industry_name"), "t_stamp", "fisc_quarter",
    )


def tx_detail(tx: DataFrame, companies: DataFrame, industries: DataFrame) -> DataFrame:
    columns = ["c_name", "hq_country", "default_cncy", "industry_id"]
    rows = joins.attach(with_time(tx), companies, _COMPANY, columns, "inner")
    rows = joins.attach(rows, industries, _INDUSTRY, ["name", "display_cncy"], "inner")
    return rows.select(
        "tx_id", F.col("amount").alias("revenue"), "cncy", "c_id", "c_name", "hq_country", "default_cncy",
        F.col("name").alias("industry_name"), F.col("display_cncy").alias("industry_display_cncy"),
        "t_stamp", "fisc_quarter", "day_of_week",
    )


def revenue_vs_expenses(tx: DataFrame, expenses: DataFrame) -> DataFrame:
    def series(facts: DataFrame, label: str) -> DataFrame:
        return facts.select(
            timekeys.t_stamp(F.col("time_id")).alias("t_stamp"), "amount", F.lit(label).alias("series")
        )

    return series(tx, "Revenue").unionByName(series(expenses, "Expenses"))


def tx_company(tx: DataFrame, companies: DataFrame) -> DataFrame:
    rows = joins.attach(with_time(tx), companies, _COMPANY, ["c_name"], "inner")
    return rows.select("tx_id", "amount", "c_id", "cncy", "t_stamp", "fisc_quarter", "day_of_week", "c_name")


def industry_detail(tx: DataFrame, companies: DataFrame, industries: DataFrame) -> DataFrame:
    # One row per company and time, so that counting rows below counts companies.
    per_company = tx.groupBy("c_id", "time_id").agg(
        F.sum("amount").alias("amount"), F.count("tx_id").alias("n")
    )
    placed = joins.attach(per_company, companies, _COMPANY, ["hq_country", "industry_id"], "inner")
    totals = placed.groupBy("industry_id", "hq_country", "time_id").agg(
        F.sum("amount").alias("revenue"),
        F.sum("n").alias("transaction_count"),
        F.count("c_id").alias("company_count"),
    )
    named = joins.attach(with_time(totals), industries, _INDUSTRY, ["name"], "inner")
    return named.select(
        "industry_id", F.col("name").alias("industry_name"), "hq_country", "t_stamp", "fisc_quarter",
        F.round("revenue", 2).alias("total_revenue"), "transaction_count", "company_count",
        F.round(F.col("revenue") / numbers.null_if_zero(F.col("company_count")), 2).alias("avg_revenue_per_co"),
    )


def industry_snapshot(industry_days: DataFrame, industries: DataFrame) -> DataFrame:
    rows = joins.attach(with_time(industry_days), industries, _INDUSTRY, ["name"], "inner")
    return rows.select(
        "industry_id", "total_revenue", "total_expenses", "net_profit", "transaction_count",
        "avg_revenue_per_co", "revenue_growth_rate", "company_count", "t_stamp", "fisc_quarter",
        F.col("name").alias("industry_name"),
    )


def currency_mix(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy(F.col("cncy").alias("currency"))
        .agg(F.count("tx_id").alias("transaction_count"), _money("amount", "total_amount"))
        .orderBy(F.desc("transaction_count"), "currency")
    )


def total_fees_by_company(tx: DataFrame, conversions: DataFrame, companies: DataFrame) -> DataFrame:
    totals = _converted_company(tx, conversions).groupBy("c_id").agg(
        F.count("cx_id").alias("conversion_count"), _money("fee_amount", "total_fees_usd")
    )
    named = joins.lookup(totals, companies, _COMPANY, ["c_name"], "inner")
    return named.select("c_id", "c_name", "conversion_count", "total_fees_usd").orderBy(
        F.desc("total_fees_usd"), "c_id"
    )


# --- KPIs and exposure -----------------------------------------------------


def kpis(industry_days: DataFrame, companies: DataFrame) -> DataFrame:
    """Headline numbers from the daily aggregate only."""
    revenue, count = F.sum("total_revenue"), F.sum("transaction_count")
    companies_total = companies.agg(F.count(F.lit(1)).alias("n"))
    return industry_days.agg(
        revenue.alias("total_revenue"),
        count.alias("transaction_count"),
        F.round(revenue / F.nullif(count, F.lit(0)), 2).alias("avg_transaction"),
    ).withColumn("company_count", companies_total.scalar())


def latest_rates(ticks: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Newest tick per pair, optionally none after `as_of`."""
    rows = ticks if as_of is None else ticks.where(F.col("fx_timestamp") <= F.lit(as_of))
    newest = timekeys.newest_rate(F.col("fx_timestamp"), F.col("rate")).alias("t")
    at, rate = timekeys.newest_parts("t")
    return rows.groupBy("base_cncy", "quote_cncy").agg(newest).select(
        "base_cncy", "quote_cncy", F.round(rate, 6).alias("rate"), at.alias("fx_timestamp")
    )


def currency_value_in_usd(tx: DataFrame, ticks: DataFrame, currency: str = "EUR", as_of: datetime | None = None) -> DataFrame:
    """All revenue in one currency at that currency's latest USD rate; 0 without either."""
    pair = ticks.where((F.col("base_cncy") == currency) & (F.col("quote_cncy") == "USD"))
    if as_of is not None:
        pair = pair.where(F.col("fx_timestamp") <= F.lit(as_of))
    rate = pair.agg(F.max_by("rate", F.struct("fx_timestamp", "rate")).alias("rate"))
    total = tx.where(F.col("cncy") == currency).agg(F.sum("amount").alias("total"))
    value = F.round(F.col("total") * rate.scalar(), 2)
    return total.select(F.coalesce(value, F.lit(0)).alias("value"))


def company_revenue_by_currency(tx: DataFrame, companies: DataFrame) -> DataFrame:
    totals = tx.groupBy("c_id", "cncy").agg(_money("amount", "total_revenue"))
    named = joins.lookup(totals, companies, _COMPANY, ["c_name"], "inner")
    return named.select("c_id", "c_name", "cncy", "total_revenue").orderBy("c_name", "cncy")


def usd_rates(ticks: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """(currency, latest USD rate). One row per currency."""
    return latest_rates(ticks, as_of).where("quote_cncy = 'USD'").select(
        F.col("base_cncy").alias("currency"), F.col("rate").alias("usd_rate")
    )


def convert_to_usd(df: DataFrame, ticks: DataFrame, amount: str, currency: str, name: str = "amount_usd") -> DataFrame:
    """Add the amount at the latest USD rate; USD and currencies without a rate count as 1."""
    rated = joins.attach(df, usd_rates(ticks), [(currency, "currency")], ["usd_rate"])
    # A zero rate counts as missing, and USD itself is never converted.
    rate = F.when(F.col(currency) == "USD", F.lit(1)).when(F.col("usd_rate") != 0, F.col("usd_rate")).otherwise(F.lit(1))
    return rated.withColumn(name, F.col(amount) * rate.cast("decimal(14,6)")).drop("usd_rate")


def company_usd_valuation(tx: DataFrame, companies: DataFrame, ticks: DataFrame) -> DataFrame:
    valued = convert_to_usd(
        company_revenue_by_currency(tx, companies), ticks, "total_revenue", "cncy", "usd"
    )
    return (
        valued.groupBy("c_name").agg(F.sum("usd").alias("usd_value")).orderBy(F.desc("usd_value"), "c_name")
    )


def company_list(companies: DataFrame) -> DataFrame:
    return companies.select("c_id", "c_name").orderBy("c_name", "c_id")


def expense_ratio(industry_days: DataFrame) -> DataFrame:
    """Average daily expenses as a percentage of revenue."""
    share = F.col("total_expenses") * 100 / numbers.null_if_zero(F.col("total_revenue"))
    return industry_days.agg(numbers.exact_avg(share.cast("decimal(28,14)"), 2).alias("avg_expense_pct"))


def growth_completeness(industry_days: DataFrame) -> DataFrame:
    return (
        industry_days.groupBy("industry_id")
        .agg(F.count(F.lit(1)).alias("total_rows"), F.count("revenue_growth_rate").alias("non_null_rows"))
        .orderBy("industry_id")
    )


# --- pipeline status -------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part)
    return counts


def ingestion_timeline(raw: DataFrame, column: str) -> DataFrame:
    """Rows per calendar day."""
    return (
        raw.groupBy(F.date_trunc("day", F.col(column)).alias("day"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy("day")
    )


def cumulative_pass_rate(batches: DataFrame) -> DataFrame:
    """Running share of received rows that were loaded, over the batch log in run order."""
    from pyspark.sql import Window

    # The log has one row per run; months are accumulated first, then runs inside a month.
    month = F.date_trunc("month", "run_timestamp").alias("month")
    monthly = batches.groupBy(month).agg(F.sum("rows_loaded").alias("l"), F.sum("rows_received").alias("r"))
    before = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    opening = monthly.select(
        "month",
        F.coalesce(F.sum("l").over(before), F.lit(0)).alias("l0"),
        F.coalesce(F.sum("r").over(before), F.lit(0)).alias("r0"),
    )
    inside = Window.partitionBy("month").orderBy("run_timestamp", "batch_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    rows = batches.withColumn("month", F.date_trunc("month", "run_timestamp")).join(opening, "month")
    loaded = F.sum("rows_loaded").over(inside) + F.col("l0")
    received = F.sum("rows_received").over(inside) + F.col("r0")
    return rows.select(
        "batch_id",
        "run_timestamp",
        "rows_loaded",
        "rows_quarantined",
        F.round(loaded.cast("decimal(20,0)") * 100 / F.nullif(received, F.lit(0)), 2).alias("cumulative_pass_rate"),
    ).orderBy("run_timestamp", "batch_id")


def batch_sweep_summary(runs: DataFrame) -> DataFrame:
    """One line per batch and a TOTAL line with the overall quarantine rate."""
    lines = runs.select(
        "batch_id", "noise_level", "clean_count", "quarantine_count", "duration_seconds",
        F.lit(None).cast("decimal(20,2)").alias("quarantine_rate_pct"),
    )
    clean, bad = F.sum("clean_count"), F.sum("quarantine_count")
    total = runs.agg(
        F.lit("TOTAL").alias("batch_id"),
        F.lit(None).cast("string").alias("noise_level"),
        clean.alias("clean_count"),
        bad.alias("quarantine_count"),
        F.sum(F.coalesce("duration_seconds", F.lit(0))).alias("duration_seconds"),
        F.round(bad.cast("decimal(20,0)") * 100 / F.nullif(clean + bad, F.lit(0)), 2)
        .cast("decimal(20,2)").alias("quarantine_rate_pct"),
    )
    return lines.unionByName(total)
