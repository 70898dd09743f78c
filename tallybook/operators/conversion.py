"""USD amounts from matched rates, and the split into fact shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalize_amounts(matched: DataFrame) -> DataFrame:
    """USD passes through, other currencies are multiplied by their rate (half-up, 4 digits).

    The rate is USD per unit of the base currency. Without a rate the value is NULL.
    """
    usd = F.trim("base_cncy") == "USD"
    product = F.round(F.col("amount") * F.col("rate"), 4)
    has_rate = F.col("rate").isNotNull()
    return matched.withColumn(
        "normalized_amount_usd", F.when(usd, F.col("amount")).when(has_rate, product).cast("decimal(18,4)")
    ).withColumn(
        "conversion_flag",
        F.when(usd, "usd_passthrough").when(has_rate, "converted").otherwise("missing_rate"),
    )


def split_to_analytics(converted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(transactions, conversions) in fact shape."""
    transactions = converted.select(
        "tx_id", "c_id", "base_cncy", "amount", "normalized_amount_usd", "tx_timestamp", "conversion_flag"
    )
    conversions = converted.where("conversion_flag = 'converted'").select(
        "tx_id", F.col("amount").alias("base_amount"), "fee_amount", "rate", "fx_timestamp", "base_cncy"
    )
    return transactions, conversions
