"""Daily aggregates per industry with revenue growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions import numbers, timekeys
from tallybook.operators import asof, joins

_MONEY = "decimal(18,4)"


def _by_company_day(facts: DataFrame) -> DataFrame:
    """Partial aggregate on the fact side: at most one row per company and day leaves it."""
    return facts.groupBy("c_id", timekeys.day_key(F.col("time_id")).alias("time_id")).agg(
        F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n")
    )


def _of_new_days(facts: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Facts of days without a stored row. The stored days, one value per calendar day, are
    broadcast after a check, so finished days leave before anything is shuffled."""
    if existing is None:
        return facts
    done = existing.select(F.col("time_id").alias("__done")).distinct()
    if joins.is_bounded(done):
        done = F.broadcast(done)
    return facts.join(done, timekeys.day_key(facts["time_id"]) == F.col("__done"), "left_anti")


def refresh_industry_daily(
    transactions: DataFrame,
    expenses: DataFrame,
    companies: DataFrame,
    existing: DataFrame | None = None,
    growth: str = "chained",
) -> DataFrame:
    """Rows for days that no industry has a row for yet.

    `growth='chained'` compares each day with the day before it among stored and new rows;
    `growth='stored'` compares with the latest stored day only, so new days of one run do
    not see each other. Days already stored are never aggregated again.
    """
    if growth not in ("chained", "stored"):
        raise ValueError(f"growth must be 'chained' or 'stored', not {growth!r}")
    tx_days = _by_company_day(_of_new_days(transactions, existing))
    cost_days = _by_company_day(_of_new_days(expenses, existing))
    key = ["industry_id", "time_id"]
    bounded = joins.is_bounded(companies)

    def placed(days: DataFrame) -> DataFrame:
        return joins.attach(days, companies, [("c_id", "c_id")], ["industry_id"], "inner", bounded=bounded)

    revenue = (
        placed(tx_days)
        .groupBy(*key)
        .agg(
            F.sum("amount").cast(_MONEY).alias("total_revenue"),
            F.sum("n").alias("transaction_count"),
            # One input row per company and day: counting them counts companies.
            F.count("c_id").cast("int").alias("company_count"),
        )
    )
    costs = (
        placed(cost_days)
        .groupBy(*key)
        .agg(F.sum("amount").cast(_MONEY).alias("total_expenses"))
    )
    zero = F.lit(0).cast(_MONEY)
    daily = revenue.join(costs, key, "left").select(
        *key,
        "total_revenue",
        F.coalesce("total_expenses", zero).alias("total_expenses"),
        (F.col("total_revenue") - F.coalesce("total_expenses", zero)).cast(_MONEY).alias("net_profit"),
        "transaction_count",
        F.round(F.col("total_revenue") / numbers.null_if_zero(F.col("company_count")), 4)
        .cast(_MONEY)
        .alias("avg_revenue_per_co"),
        "company_count",
    )
    columns = [
        *key, "total_revenue", "total_expenses", "net_profit", "transaction_count",
        "avg_revenue_per_co", "revenue_growth_rate", "company_count",
    ]
    rate = numbers.growth_rate(F.col("total_revenue"), F.col("prior"))
    if existing is not None and growth == "stored":
        history = existing.select(
            "industry_id",
            timekeys.t_stamp(F.col("time_id")).alias("prior_day"),
            F.col("total_revenue").alias("prior"),
        )
        timed = daily.withColumn("day", timekeys.t_stamp(F.col("time_id")))
        compared = asof.asof_join(
            timed, history, ["industry_id"], "day", "prior_day", ["prior"], allow_equal=False
        )
    elif growth == "stored":
        compared = daily.withColumn("prior", F.lit(None).cast(_MONEY))
    else:
        by_day = Window.partitionBy("industry_id").orderBy("time_id")
        chain = daily.withColumn("new", F.lit(True))
        if existing is not None:
            past = existing.select("industry_id", "time_id", "total_revenue", F.lit(False).alias("new"))
            chain = chain.unionByName(past, allowMissingColumns=True)
        compared = chain.withColumn("prior", F.lag("total_revenue").over(by_day)).where("new")
    return compared.withColumn("revenue_growth_rate", rate).select(*columns)


def _with_computed_growth(industry: DataFrame, out_of_range: str) -> DataFrame:
    # One row per industry and day: a window's group is as long as the calendar.
    prior = F.lag("total_revenue").over(Window.partitionBy("industry_id").orderBy("time_id"))
    rate = numbers.growth_rate(F.col("total_revenue"), F.col("__prior"), out_of_range)
    return industry.withColumn("__prior", prior).withColumn("__growth", rate).drop("__prior")


def backfill_growth_null_only(industry: DataFrame) -> DataFrame:
    """Fill missing growth; growth of 1000 percent or more stays missing."""
    filled = F.coalesce("revenue_growth_rate", "__growth")
    return _with_computed_growth(industry, "null").withColumn("revenue_growth_rate", filled).drop("__growth")


def backfill_growth_clamped(industry: DataFrame) -> DataFrame:
    """Overwrite growth wherever it can be computed, limited to +-999.9999."""
    clamped = F.coalesce("__growth", "revenue_growth_rate")
    return _with_computed_growth(industry, "clamp").withColumn("revenue_growth_rate", clamped).drop("__growth")
