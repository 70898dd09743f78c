"""Domain tables derived from the benchmark's generic tables.

Orders act as transactions without conversion, `view` events as FX ticks, `click` and
`purchase` events as transactions with conversion, lineitems as expenses, and the other
events as a dirty feed. Ids are integers here; all operators take ids of any type.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import parsing
from tallybook.operators import industry, normalize, quarantine, star
from tallybook.session import configure, materialize

CODES = list(refdata.CURRENCIES)

SOURCE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def code_of(number: Column) -> Column:
    codes = ", ".join(f"'{c}'" for c in CODES)
    return F.try_element_at(F.expr(f"array({codes})"), (F.pmod(number, F.lit(len(CODES))) + 1).cast("int"))


def foreign_code(number: Column) -> Column:
    """One of the 13 currencies other than USD."""
    return code_of(F.pmod(number, F.lit(len(CODES) - 1)) + 1)


class Domain:
    """Lazily built tables of one data folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = configure(spark)
        self.path = path.rstrip("/")

    def read(self, name: str) -> DataFrame:
        # A given schema spares the job that reads file footers to infer one.
        return self.spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{self.path}/{name}.parquet")

    # --- dimensions --------------------------------------------------------

    @cached_property
    def companies(self) -> DataFrame:
        supplier, nation = self.read("supplier"), self.read("nation")
        # There is a fixed number of nations, far below any broadcast limit.
        return supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey).select(
            F.col("s_suppkey").alias("c_id"),
            F.col("s_name").alias("c_name"),
            F.col("n_name").alias("hq_country"),
            code_of(F.col("s_suppkey")).alias("default_cncy"),
            F.col("n_regionkey").alias("industry_id"),
        )

    @cached_property
    def n_companies(self) -> Column:
        # Read from file footers. As a literal it lets equal parts of a plan be recognized and
        # run once, which a subquery would not.
        return F.lit(self.read("supplier").count())

    @cached_property
    def industries(self) -> DataFrame:
        return self.read("region").select(
            F.col("r_regionkey").alias("industry_id"),
            F.col("r_name").alias("name"),
            F.when(F.col("r_regionkey") % 2 == 1, "EUR").otherwise("USD").alias("display_cncy"),
        )

    @cached_property
    def currencies(self) -> DataFrame:
        return self.spark.createDataFrame(list(refdata.CURRENCIES.items()), "cncy_code string, cncy_name string")

    @cached_property
    def categories(self) -> DataFrame:
        rows = list(enumerate(refdata.EXPENSE_CATEGORIES))
        return self.spark.createDataFrame(rows, "category_id int, category_name string")

    # --- raw tables --------------------------------------------------------

    @cached_property
    def ledger(self) -> DataFrame:
        total = F.col("o_totalprice").cast("decimal(18,2)")
        fee = (total * F.lit("0.0025").cast("decimal(6,4)")).cast("decimal(16,4)")
        c_id = F.col("o_custkey") % self.n_companies
        return self.read("orders").select(
            F.col("o_orderkey").alias("tx_id"),
            c_id.alias("c_id"),
            F.col("o_orderdate").cast("timestamp").alias("tx_timestamp"),
            F.col("o_totalprice").cast("decimal(18,4)").alias("amount"),
            F.when(F.col("o_orderkey") % 7 != 0, fee).alias("fee_amount"),
            F.lit(None).cast("string").alias("quote_cncy"),
        ).withColumn("base_cncy", code_of(F.col("c_id")))

    @cached_property
    def fx_ticks(self) -> DataFrame:
        return self.read("events").where("event_type = 'view'").select(
            F.col("event_id").alias("fx_rate_id"),
            foreign_code(F.col("user_id")).alias("base_cncy"),
            F.lit("USD").alias("quote_cncy"),
            F.col("ts").cast("timestamp").alias("fx_timestamp"),
            (F.lit(0.5) + F.col("value") / 100).cast("decimal(14,7)").alias("rate"),
        )

    @cached_property
    def intraday(self) -> DataFrame:
        events = self.read("events").where("event_type in ('purchase', 'click')")
        fee = F.col("value").cast("decimal(18,2)") * F.lit("0.005").cast("decimal(5,3)")
        return events.select(
            F.col("event_id").alias("tx_id"),
            (F.col("user_id") % self.n_companies).alias("c_id"),
            foreign_code(F.col("user_id")).alias("base_cncy"),
            F.when(F.col("event_id") % 3 == 0, "USD").alias("quote_cncy"),
            F.col("ts").cast("timestamp").alias("tx_timestamp"),
            F.col("value").cast("decimal(18,4)").alias("amount"),
            fee.cast("decimal(16,4)").alias("fee_amount"),
        )

    @cached_property
    def expenses(self) -> DataFrame:
        # The first of the rows sharing a line key, as an aggregate that combines map-side.
        columns = ["l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_tax"]
        lines = self.read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(
            F.min(F.struct(*columns)).alias("line")
        )
        amount = F.col("line.l_extendedprice").cast("decimal(18,2)") * F.col("line.l_tax").cast("decimal(4,2)")
        return lines.select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("expense_id"),
            F.col("line.l_suppkey").alias("c_id"),
            F.lit("USD").alias("cncy"),
            F.col("line.l_shipdate").cast("timestamp").alias("expense_timestamp"),
            amount.cast("decimal(18,4)").alias("amount"),
            (F.col("l_linenumber") % 6).alias("category_id"),
        )

    @cached_property
    def recent_expenses(self) -> DataFrame:
        """The expenses moved into the month of the events."""
        hours = F.pmod(F.col("expense_id"), F.lit(30)) * 24 + F.pmod(F.col("expense_id"), F.lit(24))
        at = F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=hours.cast("int"))
        return self.expenses.withColumn("expense_timestamp", at.cast("timestamp"))

    @cached_property
    def polls(self) -> DataFrame:
        """One poll for each hour with ticks: the lowest rate of each currency."""
        hour = F.date_trunc("hour", "fx_timestamp").alias("polled_at")
        quotes = self.fx_ticks.groupBy(hour, "base_cncy", "quote_cncy").agg(F.min("rate").alias("rate"))
        n = quotes.groupBy("polled_at").agg(F.count(F.lit(1)).cast("int").alias("n_quotes"))
        return quotes.join(n, "polled_at").select(
            F.lit("api").alias("source"), F.col("polled_at").cast("string").alias("poll_id"), "polled_at", "n_quotes",
            "base_cncy", "quote_cncy", "rate",
        )

    @cached_property
    def company_requests(self) -> DataFrame:
        """A request for each customer, some of them with an unknown industry or currency, or no fit weight."""
        names = ", ".join(f"'{n}'" for n in [*refdata.INDUSTRIES, "Mining"])
        codes = ", ".join(f"'{c}'" for c in [*CODES, "XXX"])
        key = F.col("c_custkey")
        return self.read("customer").select(
            key,
            F.concat(F.lit(" "), F.col("c_name")).alias("name"),
            F.try_element_at(F.expr(f"array({names})"), (F.pmod(key, F.lit(len(refdata.INDUSTRIES) + 1)) + 1).cast("int")).alias("industry"),
            F.col("c_nationkey").cast("string").alias("hq_country"),
            F.try_element_at(F.expr(f"array({codes})"), (F.pmod(key, F.lit(len(CODES) + 1)) + 1).cast("int")).alias("default_cncy"),
            (F.pmod(key, F.lit(110)) / 100).cast("double").alias("weight"),
        )

    @cached_property
    def raw_bad(self) -> DataFrame:
        part = F.col("l_partkey")
        amount = F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.col("l_extendedprice"))
        currency = F.when(part % 20 == 0, "XXX").when(part % 20 != 1, "USD")
        return self.read("lineitem").select(
            (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("tx_id"),
            F.when(part % 50 != 0, part % (self.n_companies + 5)).alias("c_id"),
            currency.alias("base_cncy"),
            F.when(part % 37 != 0, F.col("l_shipdate").cast("timestamp")).alias("tx_timestamp"),
            amount.cast("decimal(18,4)").alias("amount"),
            F.lit(None).cast("decimal(16,4)").alias("fee_amount"),
            F.lit(None).cast("string").alias("quote_cncy"),
            F.col("l_shipdate").cast("timestamp").alias("ingestion_timestamp"),
            F.lit(None).cast("string").alias("batch_id"),
        )

    @cached_property
    def dirty_feed(self) -> DataFrame:
        event, ts = F.col("event_id"), F.col("ts")
        money = F.col("value").cast("decimal(18,2)").cast("string")
        wide = F.lpad(money, 6, "0")
        comma = F.replace(money, F.lit("."), F.lit(","))
        wide_comma = F.replace(wide, F.lit("."), F.lit(","))

        def cycle(n: int, values: dict[int, Column | None], default: Column) -> Column:
            chosen = None
            for k, v in values.items():
                v = F.lit(None).cast("string") if v is None else v
                chosen = F.when(event % n == k, v) if chosen is None else chosen.when(event % n == k, v)
            return chosen.otherwise(default)

        amount = cycle(
            10,
            {
                0: None, 1: F.concat(F.lit("$"), money), 2: F.concat(F.lit("("), money, F.lit(")")),
                3: F.concat(F.lit("-"), money), 4: comma, 5: F.concat(F.lit("1,"), wide),
                6: F.concat(F.lit("1."), wide_comma), 7: F.concat(F.lit("1 "), wide),
            },
            money,
        )
        stamp = cycle(
            8,
            {
                0: F.date_format(ts, "MM/dd/yyyy HH:mm"), 1: F.date_format(ts, "dd-MM-yyyy HH:mm"),
                2: F.concat((F.lit(45291) + F.dayofmonth(ts)).cast("string"), F.lit(".5")),
                3: None, 4: F.lit("14-32-2026"),
            },
            F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
        )
        currency = cycle(
            6, {0: F.lit("euro"), 1: F.lit(" usd "), 2: F.lit("$"), 3: F.lit("XXX")}, F.lit("GBP")
        )
        number = F.col("user_id") % self.n_companies
        name = F.concat(F.lit("Supplier#"), F.lpad(number.cast("string"), 9, "0"))
        company = cycle(
            12,
            {
                0: None, 1: F.lower(name), 2: F.concat(F.lit(" "), F.upper(name), F.lit(" ")),
                3: F.lit("not_a_company"),
            },
            number.cast("string"),
        )
        fee = (F.col("value").cast("decimal(18,2)") * F.lit("0.002").cast("decimal(5,3)")).cast("decimal(18,4)")
        fees = cycle(9, {0: None, 1: F.lit("2.5%"), 2: F.lit("99999"), 3: F.lit("n/a")}, fee.cast("string"))
        return self.read("events").where("event_type in ('signup', 'error')").select(
            event.alias("tx_id"),
            amount.alias("amount"),
            stamp.alias("tx_timestamp"),
            currency.alias("base_cncy"),
            company.alias("c_id"),
            fees.alias("fee_amount"),
            F.when(event % 5 == 0, "USD").alias("quote_cncy"),
            F.to_date(ts).alias("batch_day"),
        )

    # --- normalization results ---------------------------------------------

    def _normalize(self, stage=None) -> normalize.Normalized:
        names = normalize.company_names(self.companies)
        result = normalize.normalize_receipts(self.dirty_feed, names, valid_id=parsing.integer_text, stage=stage)

        def keyed(df: DataFrame) -> DataFrame:
            return df.withColumn("c_id", F.col("c_id").cast("bigint"))

        return normalize.Normalized(
            keyed(result.annotated).withColumn("_raw_c_id", F.trim("_raw_c_id")),
            keyed(result.clean),
            keyed(result.quarantine),
        )

    @cached_property
    def normalized(self) -> normalize.Normalized:
        """For plans that read the parsed feed once."""
        return self._normalize()

    @cached_property
    def stored(self) -> normalize.Normalized:
        """For plans that read it several times: parsed once and written."""
        return self._normalize(lambda parsed: materialize(parsed, "parsed"))

    @cached_property
    def loaded(self) -> DataFrame:
        """Clean rows as stored, ingested at the end of their day."""
        return self.stored.clean.withColumns(
            {"ingestion_timestamp": _day_end(), "batch_id": F.col("batch_day").cast("string")}
        )

    @cached_property
    def quarantine_events(self) -> DataFrame:
        rows = self.stored.quarantine
        return quarantine.quarantine_records(rows, F.col("batch_day").cast("string"), _day_end())

    @cached_property
    def resolutions(self) -> DataFrame:
        action = F.when(F.col("tx_id") % 8 == 0, "deleted").otherwise("requeued")
        return self.quarantine_events.where("tx_id % 4 = 0").select("quarantine_id", action.alias("action"))

    @cached_property
    def pipeline_runs(self) -> DataFrame:
        level = F.array(F.lit("low"), F.lit("medium"), F.lit("high"))
        day = F.col("batch_day")
        return (
            self.stored.annotated.groupBy("batch_day")
            .agg(
                F.count(F.lit(1)).alias("n_transactions"),
                F.count_if(F.col("broken") == 0).alias("clean_count"),
                F.sum("broken").alias("quarantine_count"),
            )
            .select(
                day.cast("string").alias("batch_id"),
                F.try_element_at(level, F.dayofmonth(day) % 3 + 1).alias("noise_level"),
                "n_transactions",
                F.lit("synthetic").alias("fx_source"),
                _day_end().alias("run_timestamp"),
                (F.col("n_transactions").cast("decimal(10,0)") / 100).cast("decimal(8,2)").alias("duration_seconds"),
                "clean_count",
                "quarantine_count",
            )
        )

    @cached_property
    def batch_log(self) -> DataFrame:
        return self.pipeline_runs.select(
            "batch_id",
            "run_timestamp",
            F.col("n_transactions").alias("rows_received"),
            F.col("clean_count").alias("rows_loaded"),
            F.col("quarantine_count").alias("rows_quarantined"),
            "noise_level",
        )

    # --- star schema -------------------------------------------------------

    @cached_property
    def f_transaction(self) -> DataFrame:
        return star.promote_transactions(self.ledger)

    @cached_property
    def f_intraday(self) -> DataFrame:
        return star.promote_transactions(self.intraday)

    @cached_property
    def f_fx_rate(self) -> DataFrame:
        return star.promote_fx_rates(self.fx_ticks)

    @cached_property
    def f_conversion(self) -> DataFrame:
        return star.promote_conversions(self.intraday, self.fx_ticks)

    @cached_property
    def f_expense(self) -> DataFrame:
        return star.promote_expenses(self.expenses)

    @cached_property
    def f_industry(self) -> DataFrame:
        return industry.refresh_industry_daily(self.f_transaction, self.f_expense, self.companies)


def _day_end() -> Column:
    return F.date_add("batch_day", 1).cast("timestamp")
