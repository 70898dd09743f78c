"""Seeding the dimension tables and registering companies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import ids
from tallybook.operators import joins
from tallybook.schemas import TABLES
from tallybook.session import materialize
from tallybook.sources.tables import TableStore


def dimension_rows(spark: SparkSession) -> dict[str, DataFrame]:
    """The fixed dimension rows, in the order their references require."""
    rows = {
        "analytics.d_currency": list(refdata.CURRENCIES.items()),
        "analytics.d_industry": [
            (refdata.industry_id(name), name, code) for name, code in refdata.INDUSTRIES.items()
        ],
        "analytics.d_company": [
            (refdata.company_id(key), name, country, code, refdata.industry_id(industry))
            for key, name, industry, country, code in refdata.COMPANIES
        ],
        "analytics.d_expense_category": [
            (refdata.category_id(name), name) for name in refdata.EXPENSE_CATEGORIES
        ],
    }
    return {name: spark.createDataFrame(r, TABLES[name].schema) for name, r in rows.items()}


def seed_dimensions(store: TableStore) -> dict[str, bool]:
    """Fill each dimension unless it has rows; says which ones were filled."""
    seeded = {}
    for name, rows in dimension_rows(store.spark).items():
        seeded[name] = store.is_empty(name)
        if seeded[name]:
            store.append(name, rows)
    return seeded


def known_company_names(store: TableStore) -> DataFrame:
    """(name, id) lookup of full and short company names."""
    shorts = [(name, refdata.company_id(key)) for name, key in refdata.COMPANY_SHORT_NAMES]
    full = store.read("analytics.d_company").select(F.upper(F.trim("c_name")).alias("name"), F.col("c_id").alias("id"))
    extra = store.spark.createDataFrame(shorts, "name string, id string")
    return joins.dedupe(full.unionByName(extra), ["name"])


def check_companies(requests: DataFrame, industries: list[str] | None = None) -> DataFrame:
    """The requests with trimmed names and the `reason` for which one is refused, if any."""
    industries = list(refdata.INDUSTRIES) if industries is None else industries
    low, high = refdata.COMPANY_WEIGHT_RANGE
    name = F.trim("name")
    reason = (
        F.when(F.coalesce(name, F.lit("")) == "", "name is required")
        .when(~F.coalesce(F.col("industry").isin(industries), F.lit(False)), "unknown industry")
        .when(~F.coalesce(F.col("default_cncy").isin(list(refdata.CURRENCIES)), F.lit(False)), "unknown currency")
        .when(~F.coalesce(F.col("weight").between(low, high), F.lit(False)), f"weight must be between {low} and {high}")
    )
    return requests.withColumns({"name": name, "reason": reason})


def key_number(column: str = "company_key") -> Column:
    return F.regexp_extract(column, r"^COMP(\d+)$", 1).try_cast("bigint")


def key_text(number: Column) -> Column:
    """COMP001, COMP002, ... with more digits where three don't suffice."""
    width = F.greatest(F.lit(3), F.length(number.cast("string")))
    return F.concat(F.lit("COMP"), F.lpad(number.cast("string"), width, F.lit("0")))


def register_companies(
    requests: DataFrame, known_keys: DataFrame, industries: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) for requests with name, industry, hq_country, default_cncy, weight.

    Accepted rows continue the keys `COMP001, COMP002, ...` found in `known_keys.company_key`
    in name order, and get the id that belongs to their key. Any number of requests is numbered
    by ranges.
    """
    checked = materialize(check_companies(requests, industries), "requests")
    rejected = checked.where("reason is not null")
    accepted = checked.where("reason is null").drop("reason")
    highest = known_keys.agg(F.max(key_number()).alias("n")).first().n or len(refdata.COMPANIES)
    order = ["name", "hq_country", "default_cncy", "industry", "weight"]
    numbered = joins.numbered(accepted, [F.col(c).asc_nulls_first() for c in order], "number")
    numbered = numbered.withColumn("company_key", key_text(F.col("number") + F.lit(highest)))
    return (
        numbered.select(
            "company_key",
            ids.uuid5(refdata.COMPANY_NAMESPACE, F.col("company_key")).alias("c_id"),
            F.col("name").alias("c_name"),
            "hq_country",
            "default_cncy",
            ids.uuid5(refdata.INDUSTRY_NAMESPACE, F.col("industry")).alias("industry_id"),
            "weight",
        ),
        rejected,
    )


def register(store: TableStore, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Register companies in the store; returns what was accepted and what was refused.

    Keys are kept in a table of their own, which is written first. A run that dies before the
    dimension has its rows is completed by the next one, so no key is given twice or lost.
    """
    seed_dimensions(store)
    if store.is_empty("state.company_key"):
        first = [(key, refdata.company_id(key), name, country, code, refdata.industry_id(industry), None) for key, name, industry, country, code in refdata.COMPANIES]
        store.append("state.company_key", store.spark.createDataFrame(first, TABLES["state.company_key"].schema))
    accepted, rejected = register_companies(requests, store.read("state.company_key"))
    accepted = materialize(accepted, "accepted")
    store.append("state.company_key", accepted)
    keyed = store.read("state.company_key").drop("company_key", "weight")
    store.append("analytics.d_company", materialize(joins.not_in(keyed, store.read("analytics.d_company"), ["c_id"]), "registered"))
    return accepted, rejected
