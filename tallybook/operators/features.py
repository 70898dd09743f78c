"""Feature matrix over quarantine records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.operators import joins

TEMPORAL = ["failure_count", "tx_ingestion_lag", "tx_timestamp_missing", "hour_of_day", "day_of_week"]
BATCH = ["noise_level", "batch_quarantine_rate"]
COMPANY = ["currency_mismatch", "amount", "amount_is_valid", "company_known"]
SCALED = [
    "failure_count", "tx_ingestion_lag", "hour_of_day", "day_of_week", "noise_level",
    "batch_quarantine_rate", "amount",
]


def quarantine_features(
    events: DataFrame, runs: DataFrame, companies: DataFrame, industries: DataFrame
) -> DataFrame:
    """One row per quarantine record with its run, company and industry where known."""
    rows = events.select(
        "quarantine_id", "failure_code", "failure_count", "tx_timestamp", "ingestion_timestamp",
        "amount", "base_cncy", "c_id", "batch_id",
    )
    rows = joins.attach(rows, runs, [("batch_id", "batch_id")], ["noise_level", "clean_count", "quarantine_count"])
    rows = joins.attach(rows, companies, [("c_id", "c_id")], ["default_cncy", "hq_country", "industry_id"])
    rows = joins.attach(rows, industries, [("industry_id", "industry_id")], [F.col("name").alias("industry_name")])
    return rows.drop("batch_id", "industry_id")


def slug(prefix: str, value: str) -> str:
    return f"{prefix}_{value}".lower().replace(" ", "_")


def categories(dim: DataFrame, column: str) -> list[str]:
    """Sorted distinct values of a dimension column: each becomes a column of the feature matrix."""
    values = dim.where(F.col(column).isNotNull()).select(column).distinct().collect()
    return sorted(r[0] for r in values)


def derive(rows: DataFrame) -> DataFrame:
    """Flags and continuous features before filling and scaling."""
    tx, at = F.col("tx_timestamp").cast("timestamp"), F.col("ingestion_timestamp").cast("timestamp")
    levels = F.expr("map(" + ", ".join(f"'{k}', {v}" for k, v in refdata.NOISE_LEVELS.items()) + ")")
    total = F.col("clean_count") + F.col("quarantine_count")
    mismatch = F.coalesce(F.col("base_cncy") != F.col("default_cncy"), F.lit(False))
    return rows.withColumns(
        {
            "tx_timestamp_missing": tx.isNull().cast("int"),
            "amount_is_valid": F.coalesce(F.col("amount") > 0, F.lit(False)).cast("int"),
            "company_known": F.col("c_id").isNotNull().cast("int"),
            "currency_mismatch": mismatch.cast("int"),
            "tx_ingestion_lag": (F.unix_micros(at) - F.unix_micros(tx)) / F.lit(1e6),
            "hour_of_day": F.hour(tx),
            "day_of_week": F.weekday(tx),
            "batch_quarantine_rate": F.col("quarantine_count").cast("double") / F.nullif(total, F.lit(0)),
            "noise_level": F.try_element_at(levels, F.col("noise_level")),
        }
    )


@dataclass(frozen=True)
class FeatureModel:
    """Fill values, ranges and categories learned from one set of records."""

    fills: dict[str, float]
    ranges: dict[str, tuple[float, float]]
    industries: list[str]
    countries: list[str]

    @property
    def columns(self) -> list[str]:
        return (
            TEMPORAL
            + BATCH
            + [slug("industry", v) for v in self.industries]
            + [slug("country", v) for v in self.countries]
            + COMPANY
        )

    def transform(self, derived: DataFrame) -> DataFrame:
        """(quarantine_id, failure_code, features): a constant feature scales to 0."""
        columns: dict[str, Column] = {}
        for name in TEMPORAL + BATCH + COMPANY:
            value = F.col(name).cast("double")
            if name in SCALED:
                low, high = self.ranges[name]
                filled = F.coalesce(value, F.lit(self.fills[name]))
                value = (filled - F.lit(low)) / F.lit(high - low) if high > low else F.lit(0.0)
            columns[name] = value
        for prefix, source, values in (
            ("industry", "industry_name", self.industries),
            ("country", "hq_country", self.countries),
        ):
            # A value that was not learned would become all zeros, so it stops the job.
            message = F.concat(F.lit(f"unknown {prefix}: "), F.col(source))
            known = F.when(F.col(source).isNull() | F.col(source).isin(values), F.col(source)).otherwise(F.raise_error(message))
            for v in values:
                columns[slug(prefix, v)] = F.coalesce(known == v, F.lit(False)).cast("double")
        return derived.select(
            "quarantine_id", "failure_code", *[columns[c].alias(c) for c in self.columns]
        )


def fit(derived: DataFrame, industries: list[str], countries: list[str]) -> FeatureModel:
    """Learn fills and ranges in one aggregate.

    Hours, weekdays and noise levels have at most 24 values, so their exact medians need
    only as many counters. Filling with a median or mean does not widen a range; filling
    with 0 may.
    """
    medians, zeros = ("hour_of_day", "day_of_week", "noise_level"), ("tx_ingestion_lag", "amount")
    measures = []
    for name in SCALED:
        value = F.col(name).cast("double")
        measures += [F.min(value).alias(f"{name}__min"), F.max(value).alias(f"{name}__max")]
    measures += [F.median(name).alias(f"{name}__fill") for name in medians]
    measures += [F.avg("batch_quarantine_rate").alias("batch_quarantine_rate__fill")]
    measures += [F.count_if(F.col(name).isNull()).alias(f"{name}__nulls") for name in zeros]
    found = derived.agg(*measures).first().asDict()
    fills = {n: float(found.get(f"{n}__fill") or 0.0) for n in SCALED}
    ranges = {}
    for name in SCALED:
        low, high = found[f"{name}__min"], found[f"{name}__max"]
        low, high = (fills[name],) * 2 if low is None else (low, high)
        if name in zeros and found[f"{name}__nulls"]:
            low, high = min(low, 0.0), max(high, 0.0)
        ranges[name] = (float(low), float(high))
    return FeatureModel(fills, ranges, industries, countries)


def as_vector(matrix: DataFrame, columns: list[str], output: str = "components") -> DataFrame:
    """The matrix with its features as one vector column."""
    return VectorAssembler(inputCols=columns, outputCol=output).transform(matrix).drop(*columns)


def split_by_company(matrix: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with a known company, records without)."""
    return matrix.where("company_known = 1"), matrix.where("company_known = 0")
