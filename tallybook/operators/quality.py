"""Statistics and integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import numbers
from tallybook.operators import joins
from tallybook.operators.normalize import Normalized
from tallybook.operators.quantile import exact_median
from tallybook.session import materialize


def _scaled(df: DataFrame, column: str, digits: int) -> DataFrame:
    """The decimal column as an integer of its last stored digit."""
    return df.select((F.col(column) * 10**digits).cast("bigint").alias("v"))


# --- normalization ---------------------------------------------------------


def normalization_stats(result: Normalized) -> DataFrame:
    """One row of volumes, amount and fee statistics, and values rescued per field.

    A field counts as rescued in a clean row when its text was not already canonical.
    """
    # Read several times below, so stored once: the feed is parsed a single time.
    needed = [
        "tx_id", "c_id", "base_cncy", "quote_cncy", "amount", "fee_amount", "tx_timestamp", "broken",
        "_raw_c_id", "_raw_amount", "_raw_base_cncy", "_raw_tx_timestamp",
    ]
    rows = materialize(result.annotated.select(*needed), "stats")
    broken = F.col("broken") > 0
    volume = rows.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~broken).alias("clean_rows"),
        F.sum("broken").alias("violation_records"),
    )
    # Distinct transactions: grouped first, so a repeated id is one row per map task.
    quarantined = (
        rows.where(broken & F.col("tx_id").isNotNull())
        .groupBy("tx_id").agg(F.lit(1).alias("one"))
        .agg(F.count(F.lit(1)).alias("quarantined_tx"))
    )
    fee_share = F.when(F.col("fee_amount") > 0, F.col("fee_amount") * 100 / F.col("amount"))
    fee = F.when(F.col("fee_amount") > 0, F.col("fee_amount"))
    clean = rows.where(~broken)
    money = clean.agg(
        F.round(F.min("amount"), 2).alias("amount_min"),
        numbers.exact_avg(F.col("amount"), 2).alias("amount_mean"),
        F.round(F.max("amount"), 2).alias("amount_max"),
        F.count(fee).alias("rows_with_fee"),
        F.coalesce(numbers.exact_avg(fee, 4), F.lit(0)).alias("mean_fee"),
        F.coalesce(numbers.exact_avg(fee_share.cast("decimal(28,14)"), 4), F.lit(0)).alias("mean_fee_pct"),
        F.count("quote_cncy").alias("conversion_count"),
        F.count_if(~F.coalesce(F.date_format("tx_timestamp", "yyyy-MM-dd HH:mm:ss") == F.col("_raw_tx_timestamp"), F.lit(False))).alias("timestamps_absorbed"),
        F.count_if(F.col("base_cncy") != F.col("_raw_base_cncy")).alias("currencies_absorbed"),
        F.count_if(~F.coalesce(F.col("_raw_amount").try_cast("decimal(18,4)") == F.col("amount"), F.lit(False))).alias("amounts_absorbed"),
        F.count_if(F.col("c_id").cast("string") != F.col("_raw_c_id")).alias("companies_absorbed"),
    )
    middle = exact_median(_scaled(clean, "amount", 4), "v").select(
        F.round((F.col("median") / 10000).cast("decimal(20,6)"), 2).alias("amount_median")
    )
    return joins.side_by_side(volume, quarantined, money, middle).withColumn(
        "quarantine_rate_pct",
        F.coalesce(
            F.round(F.col("quarantined_tx").cast("decimal(20,0)") * 100 / F.nullif("input_rows", F.lit(0)), 2),
            F.lit(0),
        ),
    )


def code_breakdown(result: Normalized) -> DataFrame:
    """Violations per failure code with their share of input rows."""
    total = result.annotated.agg(F.count(F.lit(1)).alias("n"))
    counted = result.quarantine.groupBy("failure_code").agg(F.count(F.lit(1)).alias("violations"))
    share = F.col("violations").cast("decimal(20,0)") * 100 / total.scalar()
    return counted.withColumn("pct_of_input", F.round(share, 2)).orderBy(F.desc("violations"), "failure_code")


def currency_distribution(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("base_cncy")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "base_cncy")
    )


# --- FX matching and conversion --------------------------------------------


def fx_coverage(matched: DataFrame) -> DataFrame:
    """Matched and missing rates, and the age of the matched tick in seconds."""
    foreign = F.col("base_cncy") != "USD"
    lag = F.when(
        foreign & F.col("rate").isNotNull(),
        F.unix_micros(F.col("tx_timestamp").cast("timestamp")) - F.unix_micros(F.col("fx_timestamp").cast("timestamp")),
    )
    # Read several times below, so stored once: the as-of join runs a single time.
    timed = materialize(matched.select("base_cncy", "rate", lag.alias("lag_us")), "coverage")
    totals = timed.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~foreign).alias("usd_rows"),
        F.count_if(foreign).alias("non_usd_rows"),
        F.count("rate").alias("with_rate"),
        F.count_if(F.col("rate").isNull()).alias("without_rate"),
        (F.sum("lag_us").cast("double") / F.count("lag_us") / 1e6).alias("mean_lag_s"),
        (F.max("lag_us") / 1e6).alias("max_lag_s"),
    )
    middle = exact_median(timed, "lag_us").select((F.col("median") / 1e6).alias("median_lag_s"))
    return joins.side_by_side(totals, middle)


def missing_rates_by_pair(matched: DataFrame) -> DataFrame:
    return (
        matched.where("rate is null and base_cncy is not null and quote_cncy is not null")
        .groupBy("base_cncy", "quote_cncy")
        .agg(F.count(F.lit(1)).alias("missing_count"))
        .orderBy("base_cncy", "quote_cncy")
    )


def matched_sample(matched: DataFrame, n: int = 5) -> DataFrame:
    """The first non-USD rows by time."""
    columns = ["tx_id", "tx_timestamp", "base_cncy", "quote_cncy", "amount", "rate", "fx_timestamp"]
    return matched.where("base_cncy <> 'USD'").select(*columns).orderBy("tx_timestamp", "tx_id").limit(n)


def conversion_checks(converted: DataFrame) -> DataFrame:
    """Counts by flag, re-computed amounts, and the range of converted amounts."""
    # Read several times below, so stored once: the as-of join runs a single time.
    converted = materialize(
        converted.select("conversion_flag", "normalized_amount_usd", "amount", "rate"), "conversions"
    )
    flag, usd = F.col("conversion_flag"), F.col("normalized_amount_usd")
    is_converted = flag == "converted"
    again = F.round(F.col("amount") * F.col("rate"), 4)
    value = F.when(is_converted, usd)
    totals = converted.agg(
        F.count_if(flag == "usd_passthrough").alias("usd_passthrough"),
        F.count_if(is_converted).alias("converted"),
        F.count_if(flag == "missing_rate").alias("missing_rate"),
        F.coalesce(F.bool_and(F.when(is_converted, again == usd)), F.lit(True)).alias("converted_ok"),
        F.coalesce(F.bool_and(F.when(flag == "usd_passthrough", usd == F.col("amount"))), F.lit(True)).alias("passthrough_ok"),
        F.min(value).alias("converted_min"),
        numbers.exact_avg(value, 4).alias("converted_mean"),
        F.max(value).alias("converted_max"),
    )
    middle = exact_median(_scaled(converted.where(is_converted), "normalized_amount_usd", 4), "v").select(
        (F.col("median") / 10000).alias("converted_median")
    )
    return joins.side_by_side(totals, middle)


def orphan_conversions(conversions: DataFrame, transactions: DataFrame) -> DataFrame:
    """Conversions whose transaction is absent."""
    return joins.not_in(conversions, transactions, ["tx_id"])


def conversion_currency_mismatches(
    conversions: DataFrame, transactions: DataFrame, fx: DataFrame
) -> DataFrame:
    """Conversions whose transaction currency differs from their rate's base currency."""
    cncy = transactions.select("tx_id", "cncy")
    linked = conversions.join(cncy, "tx_id", "left")
    linked = joins.attach(linked, fx, [("fx_id", "fx_id")], ["base_cncy"])
    return linked.where(~F.col("cncy").eqNullSafe(F.col("base_cncy")))


def require_conversion_currency(
    conversions: DataFrame, transactions: DataFrame, fx: DataFrame
) -> None:
    """Raise if any conversion links a rate of another currency."""
    bad = conversion_currency_mismatches(conversions, transactions, fx).limit(1).collect()
    if bad:
        raise ValueError(f"conversion currency mismatch, for example {bad[0].asDict()}")


def conversion_arithmetic(conversions: DataFrame, transactions: DataFrame, fx: DataFrame) -> DataFrame:
    """Per conversion: the converted net amount, the stored amount, and whether they agree.

    Stored amounts stay in native currency, so disagreement is normal.
    """
    actual = transactions.select("tx_id", F.col("amount").alias("actual_amount"))
    linked = joins.attach(conversions.join(actual, "tx_id"), fx, [("fx_id", "fx_id")], ["rate"], "inner")
    expected = F.round(F.col("base_amount") * F.col("rate") - F.col("fee_amount"), 4)
    return linked.select(
        "tx_id", "base_amount", "fee_amount", "rate", expected.alias("expected_amount"), "actual_amount",
        (expected == F.round("actual_amount", 4)).alias("match"),
    )


def legacy_mismatches(conversions: DataFrame, transactions: DataFrame, fx: DataFrame) -> DataFrame:
    """Count of conversions whose converted net amount differs from the stored amount."""
    checked = conversion_arithmetic(conversions, transactions, fx)
    return checked.agg(F.count_if(~F.col("match")).alias("mismatches"))


# --- generic checks --------------------------------------------------------


def foreign_key_orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows with a key value the parent lacks; a null key refers to nothing."""
    present = parent.select(F.col(key).alias(column))
    return joins.not_in(child.where(F.col(column).isNotNull()), present, [column])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the number of nulls per column, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def outside_domain(df: DataFrame, column: str, allowed: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(allowed))


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a text value above its column's length limit."""
    tests = [F.length(F.col(c)) > n for c, n in limits.items()]
    return df.where(F.coalesce(F.greatest(*tests), F.lit(False)))


def currency_rule_warnings(companies: DataFrame, industries: DataFrame) -> DataFrame:
    """Companies whose currency is not their industry's display currency, unless that is USD."""
    known = joins.attach(companies, industries, [("industry_id", "industry_id")], ["display_cncy"], "inner")
    return known.where("display_cncy <> 'USD' and default_cncy <> display_cncy").select(
        "c_id", "c_name", "default_cncy", "display_cncy"
    )


def bounds_map(bounds: dict[str, tuple[float, float]]) -> Column:
    entries = [
        x for code, (low, high) in bounds.items()
        for x in (F.lit(code), F.struct(F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high")))
    ]
    return F.create_map(*entries)


def flag_rate_bounds(ticks: DataFrame, bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Add `in_bounds`; a currency without bounds passes."""
    bounds = refdata.RATE_BOUNDS if bounds is None else bounds
    if not bounds:
        return ticks.withColumn("in_bounds", F.lit(True))
    limit = F.try_element_at(bounds_map(bounds), F.col("base_cncy"))
    inside = F.col("rate").cast("double").between(limit["low"], limit["high"])
    return ticks.withColumn("in_bounds", F.when(limit.isNull(), True).otherwise(F.coalesce(inside, F.lit(False))))


def validate_rate_bounds(
    ticks: DataFrame, poll: str, bounds: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """Ticks of polls without any out-of-bounds rate: one bad rate rejects its whole poll."""
    flagged = flag_rate_bounds(ticks, bounds)
    bad_polls = flagged.where(~F.col("in_bounds")).select(F.col(poll)).distinct()
    return joins.not_in(flagged, bad_polls, [poll]).drop("in_bounds")


def reconcile(counts: dict[str, DataFrame]) -> DataFrame:
    """One row with the row count of each table."""
    return joins.side_by_side(*[df.agg(F.count(F.lit(1)).alias(name)) for name, df in counts.items()])
