"""Feed normalization: dirty text columns to canonical typed rows plus a quarantine."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import refdata
from tallybook.functions import parsing
from tallybook.operators import joins

CANONICAL = ["tx_id", "c_id", "base_cncy", "quote_cncy", "amount", "fee_amount", "tx_timestamp"]


@dataclass(frozen=True)
class Rule:
    """A quarantine rule. A row violates it if `broken` is true, unknown, or can't be computed:
    a division by zero, a cast of unfit text, an overflow, or an element that isn't there."""

    code: str
    reason: str
    broken: str

    @property
    def dirty_column(self) -> str | None:
        return refdata.DIRTY_COLUMN.get(self.code)


# Codes and reasons must equal those of stored records.
RULES = [
    Rule("NULL_COMPANY_ID", "c_id is null after normalization", "c_id is null"),
    Rule(
        "INVALID_AMOUNT",
        "amount is null or non-positive after normalization",
        "amount is null or isnan(double(amount)) or amount <= 0",
    ),
    Rule("NULL_TIMESTAMP", "tx_timestamp is null after normalization", "tx_timestamp is null"),
    Rule(
        "INVALID_BASE_CURRENCY",
        "base_cncy is null or unresolvable after normalization",
        "base_cncy is null",
    ),
]


@dataclass(frozen=True)
class Normalized:
    """`annotated` has every input row, its text before parsing and its number of broken
    rules; `clean` has the rows without any, `quarantine` one row per violation."""

    annotated: DataFrame
    clean: DataFrame
    quarantine: DataFrame


def rename_columns(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Known feed column names to canonical ones; other columns stay as they are."""
    mapping = refdata.FEED_COLUMNS if mapping is None else mapping
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in any floating-point column to NULL."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def company_names(companies: DataFrame) -> DataFrame:
    """(name, id) lookup over full names; of companies sharing a name the last id wins."""
    return companies.groupBy(F.upper(parsing.strip(F.col("c_name"))).alias("name")).agg(
        F.max("c_id").cast("string").alias("id")
    )


def resolve_company_ids(
    df: DataFrame, names: DataFrame, valid_id=parsing.uuid_text, column: str = "c_id"
) -> DataFrame:
    """Valid ids pass, names are looked up in `names` (name in upper case, id), else NULL."""
    named = df.withColumn("__valid", valid_id(column)).withColumn(
        "__name", F.when(F.col("__valid").isNull(), F.upper(parsing.strip(F.col(column))))
    )
    found = joins.attach(named, names, [("__name", "name")], ["id"])
    return found.withColumn(column, F.coalesce("__valid", "id")).drop("__valid", "__name", "id")


def coerce_types(df: DataFrame) -> DataFrame:
    """Landing types; a non-numeric amount that got this far raises. A missing fee is 0."""
    amount = F.col("amount").cast("double").cast("decimal(18,4)")
    fee = F.coalesce(F.col("fee_amount").cast("decimal(16,4)"), F.lit(0).cast("decimal(16,4)"))
    return df.withColumns({"amount": amount, "fee_amount": fee})


@contextmanager
def _errors_as_null(spark: SparkSession):
    """Expressions analyzed inside give NULL where they would raise; plans made before or after
    keep raising, as each expression keeps the mode it was analyzed in."""
    held = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.ansi.enabled", held)


_FLAGS = "__broken"


def flag_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add an array with one flag for each rule: whether the row violates it."""
    if not rules:
        return df.withColumn(_FLAGS, F.array().cast("array<boolean>"))
    flags = ", ".join(f"coalesce(cast(({r.broken}) as boolean), true)" for r in rules)
    with _errors_as_null(df.sparkSession):
        return df.withColumn(_FLAGS, F.expr(f"array({flags})"))


def n_broken() -> Column:
    """How many rules a row with flags violates."""
    return F.size(F.filter(_FLAGS, lambda broken: broken))


def explode_flags(df: DataFrame, kept: list[str], rules: list[Rule], dirty: dict[str, str] | None = None) -> DataFrame:
    """One row per flag set: the `kept` columns plus code, reason and dirty value.

    `dirty` names, per canonical column, the column holding its text before parsing.
    """
    entries = []
    for at, rule in enumerate(rules):
        source = (dirty or {}).get(rule.dirty_column) if rule.dirty_column else None
        entries.append(
            F.when(
                F.col(_FLAGS)[at],
                F.struct(
                    F.lit(rule.code).alias("failure_code"),
                    F.lit(rule.reason).alias("failure_reason"),
                    (F.col(source) if source else F.lit(None)).cast("string").alias("dirty_value"),
                ),
            )
        )
    if not entries:
        none = F.lit(None).cast("string")
        return df.limit(0).select(*kept, *[none.alias(c) for c in ("failure_code", "failure_reason", "dirty_value")])
    exploded = df.select(*kept, F.explode(F.array(*entries)).alias("__v"))
    return exploded.where("__v is not null").select(*kept, "__v.*")


def split_quarantine(
    df: DataFrame, rules: list[Rule] | None = None, dirty: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantine): quarantine has one row per violation, clean no violating row."""
    rules = RULES if rules is None else rules
    kept = [c for c in df.columns if c not in (dirty or {}).values()]
    flagged = flag_rules(df, rules)
    return flagged.where(n_broken() == 0).select(*kept), explode_flags(flagged, kept, rules, dirty)


_DIRTY = {c: f"_raw_{c}" for c in ("c_id", "amount", "base_cncy", "tx_timestamp")}


def parse_feed(
    df: DataFrame, names: DataFrame, valid_id=parsing.uuid_text, mapping: dict[str, str] | None = None
) -> DataFrame:
    """All parsers in one chain of projections; the text before parsing stays in `_raw_*`.

    `mapping` adds feed column names to the known ones. A feed names its company in `c_id` or,
    after renaming, in `company_id`.
    """
    df = rename_columns(df, {**refdata.FEED_COLUMNS, **(mapping or {})})
    if "c_id" not in df.columns:
        df = df.withColumnRenamed("company_id", "c_id")
    if "quote_cncy" not in df.columns:
        df = df.withColumn("quote_cncy", F.lit(None).cast("string"))
    df = df.withColumns({raw: F.col(c) for c, raw in _DIRTY.items()})
    df = parsing.parse_timestamps(df)
    df = parsing.resolve_currencies(df, ["base_cncy", "quote_cncy"])
    df = parsing.parse_fees(parsing.parse_amounts(df))
    return resolve_company_ids(df, names, valid_id)


def normalize_receipts(
    df: DataFrame,
    names: DataFrame,
    rules: list[Rule] | None = None,
    valid_id=parsing.uuid_text,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    mapping: dict[str, str] | None = None,
) -> Normalized:
    """Rename, parse, coerce and split one feed. Columns beyond the canonical ones pass.

    `mapping` names the canonical column of feed columns, besides the known names.

    Clean rows and quarantine are two reads of the parsed rows. `stage`, for example
    `session.materialize`, stores those once so that the feed is parsed once.
    """
    rules = RULES if rules is None else rules
    # Rules see the parsed double, so an amount below the stored precision still counts as
    # positive. The parsed values stay apart from the coerced ones until the rules have run.
    parsed = flag_rules(parse_feed(df, names, valid_id, mapping), rules).withColumn("broken", n_broken())
    if stage is not None:
        parsed = stage(parsed)
    extra = [c for c in df.columns if c in parsed.columns and c not in (*CANONICAL, "broken", _FLAGS)]
    kept = CANONICAL + extra
    annotated = coerce_types(parsed.drop(_FLAGS))
    clean = annotated.where("broken = 0").select(*kept)
    violating = explode_flags(parsed.where("broken > 0"), kept, rules, _DIRTY)
    return Normalized(annotated, clean, coerce_types(violating))
