"""All registered queries: the Spark plan, its output columns, and reference SQL if any."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import ids, parsing
from tallybook.operators import (
    asof,
    clustering,
    conversion,
    features,
    industry,
    normalize,
    quality,
    quarantine,
    star,
)
from tallybook.plans import promote, reports
from tallybook.plans.domain import Domain
from tallybook.plans.oracle import avg_money, growth, ratio, statement, surrogate_sql, uuid5_sql
from tallybook.session import materialize, scratch_path
from tallybook.sources import dimensions, fx_feed, landing
from tallybook.sources.tables import TableStore
from tallybook.streaming import batches, metrics, ticks

_SPARK_TYPES = {"l": "bigint", "s": "string", "d": "double", "t": "timestamp_ntz", "b": "boolean"}


@dataclass(frozen=True)
class Query:
    plan: Callable[[Domain], DataFrame]
    # Output columns as "name:type ..."; types are l(ong) s(tring) d(ouble) t(imestamp) b(oolean).
    columns: str
    sql: str | None = None

    def run(self, spark, path: str) -> DataFrame:
        df = self.plan(Domain(spark, path))
        pairs = [item.split(":") for item in self.columns.split()]
        return df.select(*[F.col(c).cast(_SPARK_TYPES[t]).alias(c) for c, t in pairs])

    def oracle(self) -> str | None:
        return None if self.sql is None else statement(self.sql, self.columns)


NOW = datetime(2024, 1, 31, 1, 0)
MIDWAY = datetime(2024, 1, 16)
SPLIT = datetime(1998, 1, 1)
MIDDLE = datetime(1995, 7, 1)
_SPLIT_US = "epoch_us(timestamp '1998-01-01')"
QUERIES: dict[str, Query] = {}


def _add(name: str, plan: Callable[[Domain], DataFrame], columns: str, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = Query(plan, columns, sql)


# --- feed normalization ----------------------------------------------------

_add(
    "parse_timestamp",
    lambda d: parsing.parse_timestamps(d.dirty_feed).withColumnRenamed("tx_timestamp", "parsed"),
    "tx_id:l parsed:t",
    "select tx_id, tx_timestamp as parsed from parsed",
)
_add(
    "parse_amount",
    lambda d: parsing.parse_amounts(d.dirty_feed).withColumnRenamed("amount", "parsed"),
    "tx_id:l parsed:d",
    "select tx_id, amount as parsed from parsed",
)
_add(
    "resolve_currency",
    lambda d: parsing.resolve_currencies(d.dirty_feed, ["base_cncy", "quote_cncy"]).withColumnsRenamed(
        {"base_cncy": "base", "quote_cncy": "quote"}
    ),
    "tx_id:l base:s quote:s",
    "select tx_id, base_cncy as base, quote_cncy as quote from parsed",
)
_add(
    "resolve_company",
    lambda d: normalize.resolve_company_ids(
        d.dirty_feed, normalize.company_names(d.companies), parsing.integer_text
    ),
    "tx_id:l c_id:l",
    "select tx_id, c_id from parsed",
)
_add(
    "parse_fee",
    lambda d: parsing.parse_fees(parsing.parse_amounts(d.dirty_feed)).withColumnRenamed("fee_amount", "fee"),
    "tx_id:l fee:d",
    """select tx_id, case when fee_value > cast(amount as decimal(18,4)) then null else fee_value end as fee from fees""",
)
_add(
    "coerce_types",
    lambda d: d.normalized.annotated,
    "tx_id:l amount:d fee_amount:d",
    "select tx_id, amount, fee_amount from checked",
)
_add(
    "rename_columns",
    lambda d: normalize.rename_columns(
        d.dirty_feed.withColumnsRenamed(
            {"tx_timestamp": "data_hora", "amount": "valor", "base_cncy": "moeda", "fee_amount": "taxa"}
        )
    ),
    "tx_id:l tx_timestamp:s amount:s base_cncy:s fee_amount:s c_id:s",
    "select tx_id, tx_timestamp, amount, base_cncy, fee_amount, c_id from dirty",
)
_add(
    "nan_to_null",
    lambda d: normalize.nan_to_null(
        d.read("events").select(
            "event_id", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value")
        )
    ),
    "event_id:l value:d",
    "select event_id, case when event_id % 7 <> 0 then value end as value from events",
)
_add(
    "uuid5",
    lambda d: d.read("orders").select(
        "o_orderkey", ids.uuid5(refdata.COMPANY_NAMESPACE, F.col("o_orderkey").cast("string")).alias("id")
    ),
    "o_orderkey:l id:s",
    f"select o_orderkey, {uuid5_sql(refdata.COMPANY_NAMESPACE, 'cast(o_orderkey as varchar)')} as id from orders",
)
_CLEAN = "tx_id:l c_id:l base_cncy:s quote_cncy:s amount:d fee_amount:d tx_timestamp:t"
_add(
    "normalize_clean",
    lambda d: d.normalized.clean,
    _CLEAN,
    "select tx_id, c_id, base_cncy, quote_cncy, amount, fee_amount, tx_timestamp from clean",
)
_add(
    "quarantine_split",
    lambda d: d.normalized.quarantine.withColumn("dirty_value", F.trim("dirty_value")),
    _CLEAN + " failure_code:s failure_reason:s dirty_value:s",
    """select tx_id, c_id, base_cncy, quote_cncy, amount, fee_amount, tx_timestamp,
        failure_code, failure_reason, trim(dirty_value) as dirty_value from violation""",
)
_add(
    "normalization_stats",
    lambda d: quality.normalization_stats(d.normalized),
    "input_rows:l clean_rows:l violation_records:l quarantined_tx:l quarantine_rate_pct:d amount_min:d "
    "amount_median:d amount_mean:d amount_max:d rows_with_fee:l mean_fee:d mean_fee_pct:d conversion_count:l "
    "timestamps_absorbed:l currencies_absorbed:l amounts_absorbed:l companies_absorbed:l",
    f"""select v.*, m.* from
        (select count(*) as input_rows, sum(case when bad = 0 then 1 else 0 end) as clean_rows,
           sum(bad) as violation_records, count(distinct case when bad > 0 then tx_id end) as quarantined_tx,
           {ratio('count(distinct case when bad > 0 then tx_id end) * 100', 'count(*)', 2)} as quarantine_rate_pct
         from (select *, bad_company + bad_amount + bad_time + bad_currency as bad from checked) c) v,
        (select round(min(amount), 2) as amount_min,
           {ratio('cast(median(amount) * 1000000 as bigint)', '1000000', 2)} as amount_median,
           {avg_money('amount', 2)} as amount_mean, round(max(amount), 2) as amount_max,
           count(*) filter (where fee_amount > 0) as rows_with_fee,
           {ratio('sum(cast(fee_amount * 10000 as hugeint))', '(count(*) filter (where fee_amount > 0)) * 10000', 4)} as mean_fee,
           round(avg(fee_amount * 100 / amount) filter (where fee_amount > 0), 4) as mean_fee_pct,
           count(quote_cncy) as conversion_count,
           count(*) filter (where not coalesce(strftime(tx_timestamp, '%Y-%m-%d %H:%M:%S') = raw_ts, false)) as timestamps_absorbed,
           count(*) filter (where base_cncy <> raw_cncy) as currencies_absorbed,
           count(*) filter (where not coalesce(try_cast(raw_amount as decimal(18,4)) = amount, false)) as amounts_absorbed,
           count(*) filter (where cast(c_id as varchar) <> raw_c_id) as companies_absorbed
         from clean) m""",
)
_add(
    "normalization_codes",
    lambda d: quality.code_breakdown(d.stored),
    "failure_code:s violations:l pct_of_input:d",
    f"""select failure_code, count(*) as violations,
        {ratio('count(*) * 100', '(select count(*) from dirty)', 2)} as pct_of_input from violation group by 1""",
)
_add(
    "normalization_currencies",
    lambda d: quality.currency_distribution(d.normalized.clean),
    "base_cncy:s rows:l",
    "select base_cncy, count(*) as rows from clean group by 1",
)

# --- quarantine ------------------------------------------------------------

_EVENT = (
    "quarantine_id:s tx_id:l c_id:l base_cncy:s quote_cncy:s amount:d fee_amount:d tx_timestamp:t failure_code:s "
    "failure_reason:s batch_id:s dirty_value:s failure_count:l ingestion_timestamp:t"
)
_add(
    "quarantine_append",
    lambda d: quarantine.new_records(
        d.quarantine_events, d.quarantine_events.where(F.col("ingestion_timestamp") < F.lit(MIDWAY))
    ).withColumn("dirty_value", F.trim("dirty_value")),
    _EVENT,
    """select * exclude (dirty_value), trim(dirty_value) as dirty_value from quarantine_event
       where ingestion_timestamp >= timestamp '2024-01-16'""",
)
_LOG = (
    "tx_id:l c_id:l base_cncy:s tx_timestamp:t amount:d fee_amount:d quote_cncy:s ingestion_timestamp:t "
    "batch_id:s failure_code:s failure_reason:s source:s"
)
_add(
    "quarantine_log",
    lambda d: quarantine.quarantine_log(d.quarantine_events, d.raw_bad, d.companies, d.currencies),
    _LOG,
    "select * from q_log",
)
_add(
    "quarantine_summary",
    lambda d: quarantine.summary(d.quarantine_events),
    "source:s failure_code:s count:l cross_layer_contamination:l",
    """select 'python_layer' as source, failure_code, count(*) as count, 0 as cross_layer_contamination
       from quarantine_event group by failure_code""",
)
_add(
    "quarantine_health",
    lambda d: quarantine.health(d.quarantine_events, d.loaded, NOW),
    "total_quarantined:l total_raw:l clean_rows:l pass_rate:d new_since_last_run:l latest_ingestion:t",
    f"""select q.n as total_quarantined, r.n as total_raw, r.n - q.n as clean_rows,
        coalesce({ratio('(r.n - q.n) * 100', 'r.n', 2)}, 100) as pass_rate, q.recent as new_since_last_run, r.latest as latest_ingestion
        from (select count(*) as n, count(*) filter (where ingestion_timestamp >= timestamp '2024-01-31 01:00:00' - interval 2 hours) as recent
              from quarantine_event) q,
             (select count(*) as n, max(cast(batch_day as timestamp) + interval 1 day) as latest from clean) r""",
)
_add(
    "quarantine_rows_page",
    lambda d: quarantine.rows_page(
        d.quarantine_events.withColumn("source", F.lit("python_layer")), d.companies, page=3, page_size=20,
        failure_code="INVALID_AMOUNT", source="python_layer", since=datetime(2024, 1, 10),
    ),
    "quarantine_id:s tx_id:l c_id:l c_name:s failure_code:s ingestion_timestamp:t source:s total:l",
    """select q.quarantine_id, q.tx_id, q.c_id, c.c_name, q.failure_code, q.ingestion_timestamp, 'python_layer' as source, q.total
       from (select *, count(*) over () as total from quarantine_event
             where failure_code = 'INVALID_AMOUNT' and ingestion_timestamp >= timestamp '2024-01-10'
             order by ingestion_timestamp desc, quarantine_id limit 20 offset 40) q
       left join d_company c on c.c_id = q.c_id""",
)
_add(
    "quarantine_log_page",
    lambda d: quarantine.rows_page(
        quarantine.quarantine_log(d.quarantine_events, d.raw_bad, d.companies, d.currencies),
        d.companies, page=2, page_size=50, source="sql_layer", failure_code="UNKNOWN_COMPANY",
        order=("tx_id", "amount", "c_id"),
    ),
    "tx_id:l c_id:l c_name:s amount:d failure_code:s ingestion_timestamp:t source:s total:l",
    """select q.tx_id, q.c_id, c.c_name, q.amount, q.failure_code, q.ingestion_timestamp, q.source, q.total
       from (select *, count(*) over () as total from q_log
             where source = 'sql_layer' and failure_code = 'UNKNOWN_COMPANY'
             order by ingestion_timestamp desc, tx_id nulls first, amount nulls first, c_id nulls first limit 50 offset 50) q
       left join d_company c on c.c_id = q.c_id""",
)
_add(
    "quarantine_unresolved",
    lambda d: quarantine.unresolved(
        d.quarantine_events, d.resolutions, d.companies, ["INVALID_AMOUNT", " NULL_TIMESTAMP"]
    ),
    "quarantine_id:s tx_id:l c_id:l c_name:s failure_code:s ingestion_timestamp:t",
    """select q.quarantine_id, q.tx_id, q.c_id, c.c_name, q.failure_code, q.ingestion_timestamp
       from quarantine_event q left join d_company c on c.c_id = q.c_id
       where failure_code in ('INVALID_AMOUNT', 'NULL_TIMESTAMP')
         and quarantine_id not in (select quarantine_id from resolution)""",
)


def _requeue(d: Domain) -> quarantine.Resolution:
    chosen = d.quarantine_events.where("failure_code in ('NULL_TIMESTAMP', 'NULL_COMPANY_ID')")
    return quarantine.resolve(
        d.quarantine_events, chosen, "requeued", "admin", NOW, new_c_id="7", new_timestamp=datetime(2024, 1, 15, 12)
    )


_REQUEUE_SQL = """select tx_id, 7 as c_id, base_cncy, quote_cncy, amount, fee_amount,
    timestamp '2024-01-15 12:00:00' as tx_timestamp, batch_id
    from quarantine_event where failure_code in ('NULL_TIMESTAMP', 'NULL_COMPANY_ID')
    qualify row_number() over (partition by tx_id order by failure_code) = 1"""
_add(
    "quarantine_requeue",
    lambda d: _requeue(d).requeued,
    _CLEAN + " batch_id:s",
    f"select * from ({_REQUEUE_SQL}) r where amount > 0 and base_cncy is not null",
)
_add(
    "quarantine_requeue_rejected",
    lambda d: _requeue(d).still_bad,
    "tx_id:l failure_code:s failure_reason:s",
    f"""select tx_id, 'INVALID_AMOUNT' as failure_code, 'amount is null or non-positive after normalization' as failure_reason
        from ({_REQUEUE_SQL}) r where amount is null or amount <= 0
        union all select tx_id, 'INVALID_BASE_CURRENCY', 'base_cncy is null or unresolvable after normalization'
        from ({_REQUEUE_SQL}) r where base_cncy is null""",
)
_add(
    "quarantine_audit",
    lambda d: _requeue(d).audit,
    "resolution_id:s quarantine_id:s action:s new_c_id:s resolved_by:s resolved_at:t",
    f"""select {surrogate_sql('resolution', 'quarantine_id', "'requeued'", "'2024-01-31 01:00:00'")} as resolution_id,
        quarantine_id, 'requeued' as action, '7' as new_c_id, 'admin' as resolved_by, timestamp '2024-01-31 01:00:00' as resolved_at
        from quarantine_event where failure_code in ('NULL_TIMESTAMP', 'NULL_COMPANY_ID')""",
)
_add(
    "resolution_stats",
    lambda d: quarantine.resolution_stats(d.resolutions),
    "total_resolved:l requeued:l deleted:l",
    """select count(*) as total_resolved, count(*) filter (where action = 'requeued') as requeued,
       count(*) filter (where action = 'deleted') as deleted from resolution""",
)
_add(
    "quarantine_by_code",
    lambda d: quarantine.by_code(d.quarantine_events),
    "failure_code:s violations:l unique_transactions:l",
    """select failure_code, count(*) as violations, count(distinct tx_id) as unique_transactions
       from quarantine_event group by 1""",
)
_add(
    "quarantine_multi",
    lambda d: quarantine.multiple_failures(d.quarantine_events, limit=None).withColumn(
        "codes", F.concat_ws(",", "codes")
    ),
    "tx_id:l failure_count:l codes:s",
    """select tx_id, count(*) as failure_count, string_agg(failure_code, ',' order by failure_code) as codes
       from quarantine_event group by tx_id having count(*) > 1""",
)
_add(
    "quarantine_batches",
    lambda d: quarantine.latest_batches(d.quarantine_events),
    "batch_id:s rows:l run_time:t",
    """select batch_id, count(*) as rows, min(ingestion_timestamp) as run_time from quarantine_event
       group by 1 order by run_time desc, batch_id limit 5""",
)

# --- as-of joins and conversion --------------------------------------------

_MATCHED = "tx_id:l base_cncy:s quote_cncy:s tx_timestamp:t amount:d fx_timestamp:t rate:d"
_add(
    "asof_fx",
    lambda d: asof.match_fx_rates(d.intraday, d.fx_ticks),
    _MATCHED,
    "select * from matched",
)
_add(
    "asof_fx_inner",
    lambda d: asof.match_fx_rates(d.intraday, d.fx_ticks, how="inner").withColumn("fx_id", star.fx_key()),
    _MATCHED + " fx_id:s",
    f"""select *, {surrogate_sql('fx', 'rate', 'base_cncy', 'quote_cncy')} as fx_id
        from matched where rate is not null""",
)


def _converted(d: Domain) -> DataFrame:
    return conversion.normalize_amounts(asof.match_fx_rates(d.intraday, d.fx_ticks))


_add(
    "normalize_amounts",
    _converted,
    "tx_id:l amount:d rate:d normalized_amount_usd:d conversion_flag:s",
    "select *, usd as normalized_amount_usd from converted",
)
_add(
    "split_transactions",
    lambda d: conversion.split_to_analytics(_converted(d))[0],
    "tx_id:l c_id:l base_cncy:s amount:d normalized_amount_usd:d tx_timestamp:t conversion_flag:s",
    "select *, usd as normalized_amount_usd from converted",
)
_add(
    "split_conversions",
    lambda d: conversion.split_to_analytics(_converted(d))[1],
    "tx_id:l base_amount:d fee_amount:d rate:d fx_timestamp:t base_cncy:s",
    "select *, amount as base_amount from converted where rate is not null",
)
_add(
    "fx_coverage",
    lambda d: quality.fx_coverage(asof.match_fx_rates(d.intraday, d.fx_ticks)),
    "total_rows:l usd_rows:l non_usd_rows:l with_rate:l without_rate:l mean_lag_s:d median_lag_s:d max_lag_s:d",
    """select count(*) as total_rows, count(*) filter (where base_cncy = 'USD') as usd_rows,
       count(*) filter (where base_cncy <> 'USD') as non_usd_rows, count(rate) as with_rate,
       count(*) - count(rate) as without_rate, cast(sum(lag) as double) / count(lag) / 1e6 as mean_lag_s,
       median(lag) / 1e6 as median_lag_s, max(lag) / 1e6 as max_lag_s
       from (select *, case when rate is not null and base_cncy <> 'USD'
             then epoch_us(tx_timestamp) - epoch_us(fx_timestamp) end as lag from matched) m""",
)
_add(
    "fx_missing_pairs",
    lambda d: quality.missing_rates_by_pair(asof.match_fx_rates(d.intraday, d.fx_ticks)),
    "base_cncy:s quote_cncy:s missing_count:l",
    """select base_cncy, quote_cncy, count(*) as missing_count from matched
       where rate is null and quote_cncy is not null group by 1, 2""",
)
_add(
    "fx_sample",
    lambda d: quality.matched_sample(asof.match_fx_rates(d.intraday, d.fx_ticks)),
    _MATCHED,
    "select * from matched where base_cncy <> 'USD' order by tx_timestamp, tx_id limit 5",
)
_add(
    "conversion_checks",
    lambda d: quality.conversion_checks(_converted(d)),
    "usd_passthrough:l converted:l missing_rate:l converted_ok:b passthrough_ok:b converted_min:d "
    "converted_median:d converted_mean:d converted_max:d",
    f"""select count(*) filter (where base_cncy = 'USD') as usd_passthrough, count(usd) as converted,
        count(*) - count(usd) as missing_rate, coalesce(bool_and(usd = round(amount * rate, 4)), true) as converted_ok,
        true as passthrough_ok, min(usd) as converted_min,
        median(cast(usd * 10000 as bigint)) / 10000 as converted_median,
        {avg_money('usd', 4)} as converted_mean, max(usd) as converted_max from converted""",
)

# --- promotion -------------------------------------------------------------

_add(
    "promote_fx",
    lambda d: star.promote_fx_rates(d.fx_ticks, star.promote_fx_rates(d.fx_ticks.where(F.col("fx_timestamp") < F.lit(MIDWAY)))),
    "fx_id:s rate:d base_cncy:s quote_cncy:s",
    """select * from fx_dim d where not exists (select 1 from fx_rate f
       where f.fx_timestamp < timestamp '2024-01-16' and f.rate = d.rate and f.base_cncy = d.base_cncy and f.quote_cncy = d.quote_cncy)""",
)
_TIME = "time_id:l t_stamp:t fisc_quarter:l day_of_week:l"


def _time_sql(source: str) -> str:
    return f"""select epoch_us(ts) as time_id, ts as t_stamp, ceil(month(ts) / 3.0) as fisc_quarter,
        isodow(ts) - 1 as day_of_week from ({source}) s"""


_add(
    "promote_time",
    lambda d: star.promote_time(
        d.ledger.unionByName(d.intraday), d.expenses,
        star.promote_time(d.ledger.where(F.col("tx_timestamp") < F.lit(SPLIT)), d.expenses.where(F.col("expense_timestamp") < F.lit(MIDDLE))),
    ),
    _TIME,
    _time_sql(
        """(select tx_timestamp as ts from ledger union select tx_timestamp from intraday union select expense_timestamp from expense)
           except (select tx_timestamp from ledger where tx_timestamp < timestamp '1998-01-01'
                   union select expense_timestamp from expense where expense_timestamp < timestamp '1995-07-01')"""
    ),
)
_add(
    "ensure_midnights",
    lambda d: star.ensure_midnights(star.promote_time(d.ledger.unionByName(d.intraday), d.expenses)),
    _TIME,
    _time_sql(
        """select cast(date_trunc('day', ts) as timestamp) as ts from (select tx_timestamp as ts from ledger
             union select tx_timestamp from intraday union select expense_timestamp from expense) a
           except (select tx_timestamp from ledger union select tx_timestamp from intraday union select expense_timestamp from expense)"""
    ),
)
_add(
    "dedupe_time",
    lambda d: star.drop_duplicate_times(
        star.promote_time(d.ledger.unionByName(d.intraday), d.expenses).unionByName(
            star.promote_time(d.ledger.unionByName(d.intraday), d.expenses).withColumn("time_id", F.col("time_id") + 1)
        )
    ),
    _TIME,
    _time_sql(
        """select tx_timestamp as ts from ledger union select tx_timestamp from intraday
           union select expense_timestamp from expense"""
    ),
)
_FACT = "tx_id:l amount:d c_id:l time_id:l cncy:s"
_add(
    "promote_transactions",
    lambda d: star.promote_transactions(
        d.ledger, star.promote_transactions(d.ledger.where(F.col("tx_timestamp") < F.lit(SPLIT)))
    ),
    _FACT,
    "select * from tx where t_stamp >= timestamp '1998-01-01'",
)


def _windowed(d: Domain) -> DataFrame:
    """Windows of 60 days, each committed to the store, over one scan."""
    store = _store(d)
    promote.promote_windows(store, d.ledger)
    return store.read("analytics.f_transaction")


_add("promote_transactions_windowed", _windowed, _FACT, "select * from tx")
_CX = "cx_id:s base_amount:d fee_amount:d fx_id:s tx_id:l"
_add(
    "promote_conversions",
    lambda d: star.promote_conversions(
        d.intraday, d.fx_ticks, star.promote_conversions(d.intraday.where(F.col("tx_timestamp") < F.lit(MIDWAY)), d.fx_ticks)
    ),
    _CX,
    "select cx.* from cx join intraday i on i.tx_id = cx.tx_id where i.tx_timestamp >= timestamp '2024-01-16'",
)
_add(
    "promote_expenses",
    lambda d: star.promote_expenses(
        d.expenses, star.promote_expenses(d.expenses.where(F.col("expense_timestamp") < F.lit(SPLIT)))
    ),
    "expense_id:l amount:d cncy:s c_id:l time_id:l category_id:l",
    "select * from ex where t_stamp >= timestamp '1998-01-01'",
)
_INDUSTRY = (
    "industry_id:l time_id:l total_revenue:d total_expenses:d net_profit:d transaction_count:l "
    "avg_revenue_per_co:d revenue_growth_rate:d company_count:l"
)
_add("industry_daily", lambda d: d.f_industry, _INDUSTRY, "select * from f_industry")


def _history(d: Domain) -> DataFrame:
    return d.f_industry.where(F.col("time_id") < F.unix_micros(F.lit(SPLIT)))


_add(
    "industry_daily_chained",
    lambda d: industry.refresh_industry_daily(d.f_transaction, d.f_expense, d.companies, _history(d), "chained"),
    _INDUSTRY,
    f"select * from f_industry where time_id >= {_SPLIT_US}",
)
_add(
    "industry_daily_stored",
    lambda d: industry.refresh_industry_daily(d.f_transaction, d.f_expense, d.companies, _history(d), "stored"),
    _INDUSTRY,
    f"""select f.* replace (case when abs({growth('f.total_revenue', 'h.total_revenue')}) < 1000
           then {growth('f.total_revenue', 'h.total_revenue')} end as revenue_growth_rate)
        from f_industry f left join (select industry_id, total_revenue from f_industry where time_id < {_SPLIT_US}
          qualify row_number() over (partition by industry_id order by time_id desc) = 1) h on h.industry_id = f.industry_id
        where f.time_id >= {_SPLIT_US}""",
)


def _partly_filled(d: Domain) -> DataFrame:
    kept = F.when(F.col("time_id") < F.unix_micros(F.lit(SPLIT)), F.col("revenue_growth_rate") + 1)
    return d.f_industry.withColumn("revenue_growth_rate", kept.cast("decimal(7,4)"))


_add(
    "industry_growth_null",
    lambda d: industry.backfill_growth_null_only(_partly_filled(d)),
    "industry_id:l time_id:l revenue_growth_rate:d",
    f"""select industry_id, time_id, case when time_id < {_SPLIT_US} and revenue_growth_rate is not null
          then case when revenue_growth_rate + 1 >= 1000 then null else cast(revenue_growth_rate as decimal(12,4)) + 1 end
          else revenue_growth_rate end as revenue_growth_rate from f_industry""",
)
_add(
    "industry_growth_clamped",
    lambda d: industry.backfill_growth_clamped(d.f_industry),
    "industry_id:l time_id:l revenue_growth_rate:d",
    f"""select industry_id, time_id, least(999.9999::double, greatest(-999.9999::double, {growth('total_revenue', 'prior')})) as revenue_growth_rate
        from f_industry where prior <> 0
        union all select industry_id, time_id, null from f_industry where prior is null or prior = 0""",
)

# --- integrity checks ------------------------------------------------------

_add(
    "orphan_conversions",
    lambda d: quality.orphan_conversions(d.f_conversion, d.f_intraday.where("tx_id % 5 <> 0")),
    _CX,
    "select * from cx where tx_id % 5 = 0",
)
_add(
    "conversion_currency_check",
    lambda d: quality.conversion_currency_mismatches(
        d.f_conversion,
        d.f_intraday.withColumn("cncy", F.when(F.col("tx_id") % 6 == 0, F.lit("USD")).when(F.col("tx_id") % 9 != 0, F.col("cncy"))),
        d.f_fx_rate,
    ),
    "cx_id:s tx_id:l cncy:s base_cncy:s",
    """select cx_id, tx_id, case when tx_id % 6 = 0 then 'USD' when tx_id % 9 <> 0 then base_cncy end as cncy, base_cncy
       from cx where tx_id % 6 = 0 or tx_id % 9 = 0""",
)
_add(
    "fk_checks",
    lambda d: quality.foreign_key_orphans(d.raw_bad, "c_id", d.companies, "c_id"),
    "tx_id:l c_id:l",
    "select tx_id, c_id from raw_bad where c_id is not null and c_id not in (select c_id from d_company)",
)
_add(
    "duplicate_keys",
    lambda d: quality.duplicate_keys(d.raw_bad, ["tx_id"]),
    "tx_id:l copies:l",
    "select tx_id, count(*) as copies from raw_bad group by 1 having count(*) > 1",
)
_add(
    "null_counts",
    lambda d: quality.null_counts(d.raw_bad, ["c_id", "base_cncy", "tx_timestamp", "amount"]),
    "c_id:l base_cncy:l tx_timestamp:l amount:l",
    """select count(*) - count(c_id) as c_id, count(*) - count(base_cncy) as base_cncy,
       count(*) - count(tx_timestamp) as tx_timestamp, count(*) - count(amount) as amount from raw_bad""",
)
_add(
    "domain_check",
    lambda d: quality.outside_domain(d.raw_bad, "base_cncy", list(refdata.CURRENCIES)),
    "tx_id:l base_cncy:s",
    "select tx_id, base_cncy from raw_bad where base_cncy not in (select cncy_code from d_currency)",
)
_add(
    "length_check",
    lambda d: quality.too_long(d.dirty_feed, {"c_id": 10, "amount": 8}),
    "tx_id:l c_id:s amount:s",
    "select tx_id, c_id, amount from dirty where length(c_id) > 10 or length(amount) > 8",
)
_add(
    "currency_rule",
    lambda d: quality.currency_rule_warnings(d.companies, d.industries),
    "c_id:l c_name:s default_cncy:s display_cncy:s",
    """select c_id, c_name, default_cncy, display_cncy from d_company join d_industry using (industry_id)
       where display_cncy <> 'USD' and default_cncy <> display_cncy""",
)
_BOUNDS = {c: (0.5, 3.3) for c in list(refdata.CURRENCIES)[1:8]}
_add(
    "rate_bounds",
    lambda d: quality.validate_rate_bounds(
        d.fx_ticks.withColumn("poll", F.date_trunc("hour", "fx_timestamp")), "poll", _BOUNDS
    ),
    "fx_rate_id:l base_cncy:s fx_timestamp:t rate:d",
    f"""select * from fx_rate where date_trunc('hour', fx_timestamp) not in (
        select date_trunc('hour', fx_timestamp) from fx_rate
        where base_cncy in ({', '.join(repr(c) for c in _BOUNDS)}) and (rate < 0.5 or rate > 3.3))""",
)
_add(
    "reconcile_counts",
    lambda d: quality.reconcile(
        {
            "raw_tx": d.ledger, "f_tx": d.f_transaction, "f_expense": d.f_expense, "f_industry": d.f_industry,
            "quarantine": d.quarantine_events, "batch_log": d.batch_log, "companies": d.companies,
            "currencies": d.currencies, "industries": d.industries, "categories": d.categories,
        }
    ),
    "raw_tx:l f_tx:l f_expense:l f_industry:l quarantine:l batch_log:l companies:l currencies:l industries:l categories:l",
    """select (select count(*) from ledger) as raw_tx, (select count(*) from tx) as f_tx, (select count(*) from ex) as f_expense,
       (select count(*) from f_industry) as f_industry, (select count(*) from quarantine_event) as quarantine,
       (select count(*) from pipeline_run) as batch_log, (select count(*) from d_company) as companies,
       (select count(*) from d_currency) as currencies, (select count(*) from d_industry) as industries,
       (select count(*) from d_category) as categories""",
)
_add(
    "legacy_mismatch",
    lambda d: quality.legacy_mismatches(d.f_conversion, d.f_intraday, d.f_fx_rate),
    "mismatches:l",
    """select count(*) as mismatches from cx join itx using (tx_id)
       where round(base_amount * rate - fee_amount, 4) <> round(itx.amount, 4)""",
)

_add(
    "legacy_match",
    lambda d: quality.conversion_arithmetic(d.f_conversion, d.f_intraday, d.f_fx_rate),
    "tx_id:l base_amount:d fee_amount:d rate:d expected_amount:d actual_amount:d match:b",
    """select tx_id, base_amount, fee_amount, rate, round(base_amount * rate - fee_amount, 4) as expected_amount,
       itx.amount as actual_amount, round(base_amount * rate - fee_amount, 4) = round(itx.amount, 4) as match
       from cx join itx using (tx_id)""",
)
_add(
    "read_table",
    lambda d: d.read("orders"),
    "o_orderkey:l o_custkey:l o_orderstatus:s o_totalprice:d o_orderdate:t o_orderpriority:s",
    "select * from orders",
)

# --- reports ---------------------------------------------------------------

_add(
    "q1",
    lambda d: reports.volume_by_company(d.f_transaction, d.companies, d.industries),
    "c_id:l c_name:s industry:s hq_country:s tx_count:l total_volume_usd:d avg_tx_usd:d",
    f"""select c.c_id, c_name, i.name as industry, hq_country, count(tx_id) as tx_count,
        round(sum(amount), 2) as total_volume_usd, {avg_money('amount', 2)} as avg_tx_usd
        from tx join d_company c on tx.c_id = c.c_id join d_industry i on c.industry_id = i.industry_id group by 1, 2, 3, 4""",
)
_add(
    "q2",
    lambda d: reports.volume_by_quarter_currency(d.f_transaction),
    "fisc_quarter:l cncy:s tx_count:l total_volume_usd:d avg_tx_usd:d",
    f"""select quarter(t_stamp) as fisc_quarter, cncy, count(*) as tx_count, round(sum(amount), 2) as total_volume_usd,
        {avg_money('amount', 2)} as avg_tx_usd from tx group by 1, 2""",
)
_add(
    "q3",
    lambda d: reports.conversion_rate_by_pair(d.f_intraday, d.f_conversion, d.f_fx_rate),
    "base_cncy:s quote_cncy:s total_tx:l converted_tx:l conversion_rate:d",
    f"""select cx.base_cncy, cx.quote_cncy, count(itx.tx_id) as total_tx, count(cx_id) as converted_tx,
        {ratio('count(cx_id)', 'count(itx.tx_id)', 4)} as conversion_rate
        from itx left join cx on itx.tx_id = cx.tx_id group by 1, 2""",
)
_add(
    "q4",
    lambda d: reports.fee_burden_by_company(d.f_intraday, d.f_conversion, d.companies),
    "c_id:l c_name:s conversion_count:l avg_fee_usd:d avg_fee_pct:d",
    f"""select c.c_id, c_name, count(cx_id) as conversion_count, {avg_money('fee_amount', 4)} as avg_fee_usd,
        round(avg(fee_amount * 100 / nullif(base_amount, 0)), 4) as avg_fee_pct
        from cx join itx on cx.tx_id = itx.tx_id join d_company c on c.c_id = itx.c_id group by 1, 2""",
)


def _running_sql(source: str, unit: str, name: str) -> str:
    return f"""select c.c_id, c_name, cast(date_trunc('{unit}', t_stamp) as timestamp) as {name},
        round(sum(amount), 2) as bucket_revenue_usd,
        round(sum(sum(amount)) over (partition by c.c_id order by date_trunc('{unit}', t_stamp)), 2) as running_revenue_usd
        from {source} t join d_company c on t.c_id = c.c_id group by 1, 2, date_trunc('{unit}', t_stamp)"""


_add(
    "q5",
    lambda d: reports.running_revenue_by_minute(d.f_intraday, d.companies),
    "c_id:l c_name:s minute_bucket:t bucket_revenue_usd:d running_revenue_usd:d",
    _running_sql("itx", "minute", "minute_bucket"),
)
_add(
    "tx_running_revenue",
    lambda d: reports.running_revenue_by_day(d.f_transaction, d.companies),
    "c_id:l c_name:s day_bucket:t bucket_revenue_usd:d running_revenue_usd:d",
    _running_sql("tx", "day", "day_bucket"),
)


def _all_transactions(d: Domain) -> DataFrame:
    """Ledger and intraday facts: midnight times and times within the day."""
    shifted = d.f_intraday.withColumn("tx_id", -F.col("tx_id") - 1)
    return d.f_transaction.unionByName(shifted)


_ALL_TX = """(select tx_id, amount, c_id, t_stamp from tx
    union all select -tx_id - 1, amount, c_id, t_stamp from itx)"""


def _benchmark_sql(join_time: str, out_time: str) -> str:
    return f"""select {out_time} as t_stamp, c.c_id, c_name, sum(amount) as company_revenue, max(fi.avg_revenue_per_co) as industry_avg
        from {_ALL_TX} t join d_company c on c.c_id = t.c_id
        join f_industry fi on fi.industry_id = c.industry_id and fi.time_id = epoch_us(cast({join_time} as timestamp))
        group by {out_time}, c.c_id, c_name"""


_add(
    "tx_industry_benchmark",
    lambda d: reports.industry_benchmark(_all_transactions(d), d.companies, d.f_industry),
    "t_stamp:t c_id:l c_name:s company_revenue:d industry_avg:d",
    _benchmark_sql("t_stamp", "t_stamp"),
)
_add(
    "tx_industry_benchmark_daily",
    lambda d: reports.industry_benchmark(_all_transactions(d), d.companies, d.f_industry, grain="day"),
    "t_stamp:t c_id:l c_name:s company_revenue:d industry_avg:d",
    _benchmark_sql("date_trunc('day', t_stamp)", "date_trunc('day', t_stamp)"),
)
_add(
    "expense_detail",
    lambda d: reports.expense_detail(d.f_expense, d.companies, d.industries, d.categories),
    "expense_id:l expense_amount:d cncy:s category_name:s c_id:l c_name:s industry_name:s t_stamp:t fisc_quarter:l",
    """select expense_id, amount as expense_amount, cncy, category_name, c.c_id, c_name, i.name as industry_name, t_stamp,
       quarter(t_stamp) as fisc_quarter from ex join d_company c on ex.c_id = c.c_id
       join d_industry i on i.industry_id = c.industry_id join d_category k on k.category_id = ex.category_id""",
)
_add(
    "tx_detail",
    lambda d: reports.tx_detail(d.f_transaction, d.companies, d.industries),
    "tx_id:l revenue:d cncy:s c_id:l c_name:s hq_country:s default_cncy:s industry_name:s industry_display_cncy:s "
    "t_stamp:t fisc_quarter:l day_of_week:l",
    """select tx_id, amount as revenue, cncy, c.c_id, c_name, hq_country, default_cncy, i.name as industry_name,
       display_cncy as industry_display_cncy, t_stamp, quarter(t_stamp) as fisc_quarter, isodow(t_stamp) - 1 as day_of_week
       from tx join d_company c on tx.c_id = c.c_id join d_industry i on i.industry_id = c.industry_id""",
)
_add(
    "revenue_vs_expenses",
    lambda d: reports.revenue_vs_expenses(d.f_transaction, d.f_expense),
    "t_stamp:t amount:d series:s",
    "select t_stamp, amount, 'Revenue' as series from tx union all select t_stamp, amount, 'Expenses' from ex",
)
_add(
    "tx_company",
    lambda d: reports.tx_company(d.f_transaction, d.companies),
    "tx_id:l amount:d c_id:l cncy:s t_stamp:t fisc_quarter:l day_of_week:l c_name:s",
    """select tx_id, amount, c.c_id, cncy, t_stamp, quarter(t_stamp) as fisc_quarter, isodow(t_stamp) - 1 as day_of_week, c_name
       from tx join d_company c on tx.c_id = c.c_id""",
)
_add(
    "industry_detail",
    lambda d: reports.industry_detail(d.f_transaction, d.companies, d.industries),
    "industry_id:l industry_name:s hq_country:s t_stamp:t fisc_quarter:l total_revenue:d transaction_count:l "
    "company_count:l avg_revenue_per_co:d",
    f"""select i.industry_id, i.name as industry_name, hq_country, t_stamp, quarter(t_stamp) as fisc_quarter,
        round(sum(amount), 2) as total_revenue, count(tx_id) as transaction_count, count(distinct tx.c_id) as company_count,
        {ratio('sum(amount) * 10000', 'count(distinct tx.c_id) * 10000', 2)} as avg_revenue_per_co
        from tx join d_company c on tx.c_id = c.c_id join d_industry i on i.industry_id = c.industry_id group by 1, 2, 3, 4, 5""",
)
_add(
    "industry_snapshot",
    lambda d: reports.industry_snapshot(d.f_industry, d.industries),
    "industry_id:l total_revenue:d total_expenses:d net_profit:d transaction_count:l avg_revenue_per_co:d "
    "revenue_growth_rate:d company_count:l t_stamp:t fisc_quarter:l industry_name:s",
    """select f.*, day as t_stamp, quarter(day) as fisc_quarter, i.name as industry_name
       from f_industry f join d_industry i using (industry_id)""",
)
_add(
    "fx_currency_mix",
    lambda d: reports.currency_mix(d.f_transaction),
    "currency:s transaction_count:l total_amount:d",
    "select cncy as currency, count(*) as transaction_count, round(sum(amount), 2) as total_amount from tx group by 1",
)
_add(
    "fx_fee_burden",
    lambda d: reports.total_fees_by_company(d.f_intraday, d.f_conversion, d.companies),
    "c_id:l c_name:s conversion_count:l total_fees_usd:d",
    """select c.c_id, c_name, count(cx_id) as conversion_count, round(sum(fee_amount), 2) as total_fees_usd
       from cx join itx on cx.tx_id = itx.tx_id join d_company c on c.c_id = itx.c_id group by 1, 2""",
)
_add(
    "kpis",
    lambda d: reports.kpis(d.f_industry, d.companies),
    "total_revenue:d transaction_count:l avg_transaction:d company_count:l",
    f"""select sum(total_revenue) as total_revenue, sum(transaction_count) as transaction_count,
        {ratio('sum(total_revenue) * 10000', 'sum(transaction_count) * 10000', 2)} as avg_transaction,
        (select count(*) from d_company) as company_count from f_industry""",
)
_RATE = "base_cncy:s quote_cncy:s rate:d fx_timestamp:t"
_add("latest_rates", lambda d: reports.latest_rates(d.fx_ticks), _RATE, "select * from latest")
_add(
    "latest_rates_as_of",
    lambda d: reports.latest_rates(d.fx_ticks, MIDWAY),
    _RATE,
    """select base_cncy, quote_cncy, round(rate, 6) as rate, fx_timestamp from fx_rate
       where fx_timestamp <= timestamp '2024-01-16'
       qualify row_number() over (partition by base_cncy, quote_cncy order by fx_timestamp desc) = 1""",
)
_add(
    "eur_value",
    lambda d: reports.currency_value_in_usd(d.f_transaction, d.fx_ticks),
    "value:d",
    """select coalesce(round(sum(amount) * (select rate from fx_rate where base_cncy = 'EUR' order by fx_timestamp desc limit 1), 2), 0)
       as value from tx where cncy = 'EUR'""",
)
_add(
    "company_revenue_by_currency",
    lambda d: reports.company_revenue_by_currency(d.f_transaction, d.companies),
    "c_id:l c_name:s cncy:s total_revenue:d",
    "select * from company_cncy",
)
_add(
    "company_usd_valuation",
    lambda d: reports.company_usd_valuation(d.f_transaction, d.companies, d.fx_ticks),
    "c_name:s usd_value:d",
    """select c_name, sum(total_revenue * cast(coalesce(l.rate, 1) as decimal(14,6))) as usd_value
       from company_cncy left join latest l on l.base_cncy = cncy group by 1""",
)
_add(
    "convert_to_usd",
    lambda d: reports.convert_to_usd(d.f_transaction, d.fx_ticks, "amount", "cncy"),
    "tx_id:l amount:d cncy:s amount_usd:d",
    """select tx_id, amount, cncy, amount * cast(coalesce(l.rate, 1) as decimal(14,6)) as amount_usd
       from tx left join latest l on l.base_cncy = cncy""",
)
_add(
    "company_list",
    lambda d: reports.company_list(d.companies),
    "c_id:l c_name:s",
    "select c_id, c_name from d_company",
)
_add(
    "expense_ratio",
    lambda d: reports.expense_ratio(d.f_industry),
    "avg_expense_pct:d",
    "select round(avg(total_expenses * 100 / nullif(total_revenue, 0)), 2) as avg_expense_pct from f_industry",
)
_add(
    "growth_completeness",
    lambda d: reports.growth_completeness(d.f_industry),
    "industry_id:l total_rows:l non_null_rows:l",
    "select industry_id, count(*) as total_rows, count(revenue_growth_rate) as non_null_rows from f_industry group by 1",
)
_add(
    "pipeline_status",
    lambda d: reports.ingestion_timeline(d.fx_ticks, "fx_timestamp"),
    "day:t rows:l",
    "select cast(date_trunc('day', fx_timestamp) as timestamp) as day, count(*) as rows from fx_rate group by 1",
)
_add(
    "cumulative_pass_rate",
    lambda d: reports.cumulative_pass_rate(d.batch_log),
    "batch_id:s run_timestamp:t rows_loaded:l rows_quarantined:l cumulative_pass_rate:d",
    f"""select batch_id, run_timestamp, clean_count as rows_loaded, quarantine_count as rows_quarantined,
        {ratio('sum(clean_count) over w * 100', 'sum(n_transactions) over w', 2)} as cumulative_pass_rate
        from pipeline_run window w as (order by run_timestamp, batch_id)""",
)
_add(
    "batch_sweep_summary",
    lambda d: reports.batch_sweep_summary(d.pipeline_runs),
    "batch_id:s noise_level:s clean_count:l quarantine_count:l duration_seconds:d quarantine_rate_pct:d",
    f"""select batch_id, noise_level, clean_count, quarantine_count, duration_seconds, null as quarantine_rate_pct from pipeline_run
        union all select 'TOTAL', null, sum(clean_count), sum(quarantine_count), sum(n_transactions) / 100,
        {ratio('sum(quarantine_count) * 100', 'sum(clean_count + quarantine_count)', 2)} from pipeline_run""",
)
_add(
    "table_counts",
    lambda d: reports.table_counts(
        {
            "raw.transaction_event": d.ledger, "raw.fx_rate": d.fx_ticks, "raw.quarantine_event": d.quarantine_events,
            "analytics.f_transaction": d.f_transaction, "analytics.f_expense": d.f_expense,
            "analytics.f_conversion": d.f_conversion, "analytics.f_fx_rate": d.f_fx_rate,
        }
    ),
    "table_name:s row_count:l",
    """select 'raw.transaction_event' as table_name, count(*) as row_count from ledger
       union all select 'raw.fx_rate', count(*) from fx_rate
       union all select 'raw.quarantine_event', count(*) from quarantine_event
       union all select 'analytics.f_transaction', count(*) from tx
       union all select 'analytics.f_expense', count(*) from ex
       union all select 'analytics.f_conversion', count(*) from cx
       union all select 'analytics.f_fx_rate', count(*) from fx_dim""",
)

# --- machine learning on quarantine records --------------------------------

# What the region and nation tables hold; the names of the matrix's columns must be known here.
_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
_NATIONS = sorted(f"NATION_{i}" for i in range(25))
_FEATURES = [
    *features.TEMPORAL, *features.BATCH, *[features.slug("industry", r) for r in _REGIONS],
    *[features.slug("country", n) for n in _NATIONS], *features.COMPANY,
]


def _feature_rows(d: Domain) -> DataFrame:
    return features.quarantine_features(d.quarantine_events, d.pipeline_runs, d.companies, d.industries)


def _matrix(d: Domain) -> DataFrame:
    derived = features.derive(_feature_rows(d))
    industries, countries = features.categories(d.industries, "name"), features.categories(d.read("nation"), "n_name")
    return features.fit(derived, industries, countries).transform(derived)


_FEATURE_ROWS_SQL = """select q.quarantine_id, q.failure_code, q.failure_count, q.tx_timestamp, q.ingestion_timestamp, q.amount,
    q.base_cncy, q.c_id, p.noise_level, p.clean_count, p.quarantine_count, c.default_cncy, c.hq_country, i.name as industry_name
    from quarantine_event q left join pipeline_run p on q.batch_id = p.batch_id
    left join d_company c on q.c_id = c.c_id left join d_industry i on c.industry_id = i.industry_id"""
_add(
    "quarantine_features",
    _feature_rows,
    "quarantine_id:s failure_code:s failure_count:l tx_timestamp:t ingestion_timestamp:t amount:d base_cncy:s c_id:l "
    "noise_level:s clean_count:l quarantine_count:l default_cncy:s hq_country:s industry_name:s",
    _FEATURE_ROWS_SQL,
)


def _scaled_sql(name: str) -> str:
    return f"coalesce(({name} - min({name}) over ()) / nullif(max({name}) over () - min({name}) over (), 0), 0) as {name}"


def _matrix_sql() -> str:
    derived = f"""select quarantine_id, failure_code, cast(failure_count as double) as failure_count,
        coalesce((epoch_us(ingestion_timestamp) - epoch_us(tx_timestamp)) / 1000000.0::double, 0) as tx_ingestion_lag,
        case when tx_timestamp is null then 1 else 0 end as tx_timestamp_missing,
        cast(hour(tx_timestamp) as double) as hour_raw, cast(isodow(tx_timestamp) - 1 as double) as day_raw,
        cast(case noise_level when 'low' then 0 when 'medium' then 1 when 'high' then 2 end as double) as noise_level,
        cast(quarantine_count as double) / nullif(clean_count + quarantine_count, 0) as batch_quarantine_rate,
        case when base_cncy <> default_cncy then 1 else 0 end as currency_mismatch,
        coalesce(cast(amount as double), 0) as amount, case when amount > 0 then 1 else 0 end as amount_is_valid,
        case when c_id is not null then 1 else 0 end as company_known, industry_name, hq_country from ({_FEATURE_ROWS_SQL}) f"""
    filled = f"""select *, coalesce(hour_raw, median(hour_raw) over ()) as hour_of_day,
        coalesce(day_raw, median(day_raw) over ()) as day_of_week from ({derived}) d"""
    onehot = [
        f"case when industry_name = '{r}' then 1 else 0 end as {features.slug('industry', r)}" for r in _REGIONS
    ] + [f"case when hq_country = '{n}' then 1 else 0 end as {features.slug('country', n)}" for n in _NATIONS]
    scaled = [_scaled_sql(n) for n in features.SCALED]
    return f"""select quarantine_id, failure_code, tx_timestamp_missing, currency_mismatch, amount_is_valid, company_known,
        {', '.join(scaled)}, {', '.join(onehot)} from ({filled}) g"""


_MATRIX = "quarantine_id:s failure_code:s " + " ".join(f"{c}:d" for c in _FEATURES)
_add("ml_feature_matrix", _matrix, _MATRIX, _matrix_sql())
_add(
    "ml_split",
    lambda d: features.split_by_company(_matrix(d))[1],
    _MATRIX,
    f"select * from ({_matrix_sql()}) m where company_known = 0",
)


def _known(d: Domain) -> DataFrame:
    """Records of known companies, written once because the fits below read them many times."""
    return materialize(features.split_by_company(_matrix(d))[0], "matrix")


def _projected(d: Domain) -> DataFrame:
    known = _known(d)
    return materialize(clustering.fit_components(known, _FEATURES, k=11).transform(known), "components")


def _clustered(projected: DataFrame) -> DataFrame:
    return clustering.best_kmeans(projected, 3).transform(projected)


def _targeted(projected: DataFrame) -> DataFrame:
    """Clusters on the second and third component only."""
    picked = clustering.pick_components(projected, [1, 2])
    return clustering.best_kmeans(picked, 3, "picked").transform(picked)


_add(
    "ml_pca_variance",
    lambda d: clustering.variance_table(d.spark, clustering.fit_components(_known(d), _FEATURES)),
    "component:l variance_ratio:d cumulative:d",
)
_add(
    "ml_loadings",
    lambda d: clustering.loadings_table(d.spark, clustering.fit_components(_known(d), _FEATURES, k=11)),
    "component:l feature:s loading:d",
)


def _unknown_projected(d: Domain) -> DataFrame:
    known, unknown = features.split_by_company(materialize(_matrix(d), "matrix"))
    projected = clustering.fit_components(known, _FEATURES, k=11).transform(unknown)
    return projected.withColumn("parts", vector_to_array("components")).select(
        "quarantine_id", *[F.col("parts")[i].alias(f"pc{i + 1}") for i in range(11)]
    )


_add(
    "ml_pca_projection",
    _unknown_projected,
    "quarantine_id:s " + " ".join(f"pc{i}:d" for i in range(1, 12)),
)
_CROSSTAB = "failure_code:s cluster_0:l cluster_1:l cluster_2:l total:l share_0:d share_1:d share_2:d"
_add("ml_kmeans_crosstab", lambda d: clustering.crosstab(_clustered(_projected(d)), 3), _CROSSTAB)
_add("ml_kmeans_targeted", lambda d: clustering.crosstab(_targeted(_projected(d)), 3), _CROSSTAB)


def _silhouettes(d: Domain) -> DataFrame:
    projected = _projected(d)
    rows = [
        ("all", clustering.silhouette(_clustered(projected))),
        ("pc2_pc3", clustering.silhouette(_targeted(projected), "picked")),
    ]
    return d.spark.createDataFrame(rows, "components string, silhouette double")


_add("ml_silhouette", _silhouettes, "components:s silhouette:d")
_add(
    "ml_k_selection",
    lambda d: clustering.choose_k(_projected(d)),
    "k:l inertia:d silhouette:d",
)

# --- loading and streaming -------------------------------------------------


def _store(d: Domain) -> TableStore:
    return TableStore(d.spark, scratch_path(d.spark, "store"))


def _append_fx(d: Domain) -> DataFrame:
    store = _store(d)
    landing.append_fx_rates(store, d.fx_ticks.where(F.col("fx_timestamp") < F.lit(MIDWAY)), NOW)
    # Loading everything again adds only what is new.
    landing.append_fx_rates(store, d.fx_ticks.withColumn("source", F.lit("replay")), NOW)
    return store.read("raw.fx_rate")


_add(
    "append_fx_rates",
    _append_fx,
    "base_cncy:s quote_cncy:s fx_timestamp:t rate:d source:s ingestion_timestamp:t",
    """select base_cncy, quote_cncy, fx_timestamp, rate, timestamp '2024-01-31 01:00:00' as ingestion_timestamp,
       case when fx_timestamp < timestamp '2024-01-16' then 'api' else 'replay' end as source from fx_rate""",
)


def _append_transactions(d: Domain) -> DataFrame:
    store = _store(d)
    landing.append_transactions(store, d.intraday.where("tx_id % 2 = 0"), "first", NOW)
    landing.append_transactions(store, d.intraday.unionByName(d.intraday), "second", NOW)
    return store.read("raw.transaction_event")


_add(
    "append_transactions",
    _append_transactions,
    "tx_id:l c_id:l base_cncy:s quote_cncy:s amount:d fee_amount:d tx_timestamp:t batch_id:s",
    "select *, case when tx_id % 2 = 0 then 'first' else 'second' end as batch_id from intraday",
)


def _append_expenses(d: Domain) -> DataFrame:
    store = _store(d)
    landing.append_expenses(store, d.expenses.where("expense_id % 3 = 0"), NOW)
    landing.append_expenses(store, d.expenses, NOW)
    return store.read("raw.expense_event")


_add(
    "append_expenses",
    _append_expenses,
    "expense_id:l c_id:l cncy:s expense_timestamp:t amount:d category_id:l",
    "select * from expense",
)


EARLIER = datetime(2023, 12, 31, 12)
_MADE: dict[tuple[str, str, str], TableStore] = {}


def _made_once(make: Callable[[Domain], TableStore]) -> Callable[[Domain], TableStore]:
    """The queries that show different tables of one store share it within an application."""

    def made(d: Domain) -> TableStore:
        name = (d.spark.sparkContext.applicationId, d.path, make.__name__)
        if name not in _MADE:
            _MADE[name] = make(d)
        return _MADE[name]

    return made


@_made_once
def _transformed(d: Domain) -> TableStore:
    """A store after loading the tables in two halves with a transform after each.

    Half of the expenses was landed on an earlier day, the others come with the first run.
    """
    store = _store(d)
    companies = d.companies.withColumns({c: F.col(c).cast("string") for c in ("c_id", "industry_id")})
    store.append("analytics.d_company", companies)
    landing.append_expenses(store, d.recent_expenses.where("expense_id % 2 = 0"), EARLIER)
    early = F.col("tx_timestamp") < F.lit(MIDWAY)
    for part, costs in ((early, d.recent_expenses.where("expense_id % 2 = 1")), (~early, None)):
        landing.append_fx_rates(store, d.fx_ticks.withColumn("tx_timestamp", F.col("fx_timestamp")).where(part), NOW)
        landing.append_transactions(store, d.intraday.where(part), None, NOW)
        promote.run_transform(store, costs)
    return store


_add(
    "run_transform",
    lambda d: _transformed(d).read("analytics.f_transaction"),
    _FACT,
    "select tx_id, amount, c_id, epoch_us(t_stamp) as time_id, cncy from itx",
)
_add(
    "run_transform_conversions",
    lambda d: _transformed(d).read("analytics.f_conversion"),
    "base_amount:d fee_amount:d fx_id:s tx_id:l",
    "select base_amount, fee_amount, fx_id, tx_id from cx",
)
_add(
    "run_transform_expenses",
    lambda d: _transformed(d).read("analytics.f_expense"),
    "expense_id:l amount:d cncy:s c_id:l time_id:l category_id:l",
    "select * from rex",
)
_add(
    "run_transform_industry",
    lambda d: _transformed(d).read("analytics.f_industry"),
    _INDUSTRY,
    "select * from recent_industry",
)
_add(
    "run_transform_times",
    lambda d: _transformed(d).read("analytics.d_time"),
    _TIME,
    _time_sql(
        """select ts from (select t_stamp as ts from itx union select t_stamp from rex) a
           union select cast(date_trunc('day', ts) as timestamp) from (select t_stamp as ts from itx union select t_stamp from rex) b"""
    ),
)


def _waiting(d: Domain) -> DataFrame:
    """What still waits for a rate."""
    return _transformed(d).read("state.waiting_conversion")


_add(
    "run_transform_waiting",
    _waiting,
    "tx_id:l base_cncy:s quote_cncy:s amount:d tx_timestamp:t",
    "select tx_id, base_cncy, quote_cncy, amount, tx_timestamp from matched where quote_cncy is not null and rate is null",
)


def _streamed(d: Domain, df: DataFrame, label: str) -> DataFrame:
    """The rows of `df` as a file stream."""
    path = scratch_path(d.spark, label)
    df.write.parquet(path)
    return d.spark.readStream.schema(df.schema).parquet(path)


def _stream_ticks(d: Domain) -> DataFrame:
    store = _store(d)
    quotes = d.fx_ticks.select(
        F.concat_ws("/", "base_cncy", "quote_cncy").alias("symbol"), F.col("rate").cast("string").alias("rate"), "fx_timestamp"
    )
    stream = ticks.parse_quotes(_streamed(d, quotes.unionByName(quotes), "quotes"))
    bounds = {code: (0.0, 4.0) for code in refdata.RATE_BOUNDS}
    ticks.stream_fx_ticks(stream, store, scratch_path(d.spark, "checkpoint"), bounds=bounds).awaitTermination()
    return store.read("raw.fx_rate")


_add(
    "stream_fx_ticks",
    _stream_ticks,
    "base_cncy:s quote_cncy:s fx_timestamp:t rate:d",
    "select * from fx_rate where rate between 0 and 4",
)


def _stream_latest(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "latest")
    stream = _streamed(d, d.fx_ticks, "ticks")
    ticks.keep_latest_rates(stream, path, scratch_path(d.spark, "checkpoint")).awaitTermination()
    return ticks.read_latest_rates(d.spark, path)


_add("stream_latest_rates", _stream_latest, _RATE, "select * from latest")


def _stream_normalized(d: Domain) -> TableStore:
    store = _store(d)
    names = normalize.company_names(d.companies)
    batches.stream_normalize(
        _streamed(d, d.dirty_feed, "feed"), names, store, scratch_path(d.spark, "checkpoint"),
        valid_id=parsing.integer_text, now=lambda: NOW,
    ).awaitTermination()
    return store


_add(
    "stream_normalize",
    lambda d: _stream_normalized(d).read("raw.transaction_event"),
    _CLEAN,
    "select tx_id, c_id, base_cncy, quote_cncy, amount, fee_amount, tx_timestamp from clean",
)
_add(
    "stream_quarantine",
    lambda d: _stream_normalized(d).read("raw.quarantine_event"),
    "tx_id:l failure_code:s failure_count:l amount:d",
    "select tx_id, failure_code, failure_count, amount from quarantine_event",
)


@_made_once
def _stream_transform(d: Domain) -> TableStore:
    store = _store(d)
    companies = d.companies.withColumns({c: F.col(c).cast("string") for c in ("c_id", "industry_id")})
    store.append("analytics.d_company", companies)
    checkpoint = scratch_path(d.spark, "checkpoint")
    landing.append_expenses(store, d.recent_expenses, EARLIER)
    landing.append_fx_rates(store, d.fx_ticks, NOW)
    for part in ("tx_id % 2 = 0", "tx_id % 2 = 1"):
        # The second half is late: its days have their aggregate, which stays.
        landing.append_transactions(store, d.intraday.where(part), None, NOW)
        batches.stream_transform(store, checkpoint).awaitTermination()
    return store


def _requeue_store(d: Domain) -> TableStore:
    """A store after the requeue was applied, and applied again."""
    store = _store(d)
    store.append("raw.quarantine_event", d.quarantine_events)
    for _ in range(2):
        landing.apply_resolution(store, _requeue(d))
    return store


_add(
    "requeue_applied",
    lambda d: _requeue_store(d).read("raw.transaction_event"),
    _CLEAN + " batch_id:s",
    f"select * from ({_REQUEUE_SQL}) r where amount > 0 and base_cncy is not null",
)


def _requeue_open(d: Domain) -> DataFrame:
    """What the requeue left in quarantine: its rejected corrections, with their new values."""
    store = _requeue_store(d)
    events, settled = store.read("raw.quarantine_event"), store.read("raw.quarantine_resolution")
    return events.join(settled, "quarantine_id", "left_anti").where("c_id = '7' and tx_timestamp = timestamp '2024-01-15 12:00:00'")


_add(
    "requeue_still_open",
    _requeue_open,
    "tx_id:l c_id:l tx_timestamp:t failure_code:s",
    f"""select tx_id, c_id, tx_timestamp, 'INVALID_AMOUNT' as failure_code from ({_REQUEUE_SQL}) r where amount is null or amount <= 0
        union all select tx_id, c_id, tx_timestamp, 'INVALID_BASE_CURRENCY' from ({_REQUEUE_SQL}) r where base_cncy is null""",
)


_add(
    "stream_transform",
    lambda d: _stream_transform(d).read("analytics.f_industry"),
    _INDUSTRY,
    f"""with r as (select industry_id, date_trunc('day', t_stamp) as day, sum(amount) as total_revenue, count(*) as transaction_count,
          count(distinct itx.c_id) as company_count from itx join d_company on itx.c_id = d_company.c_id where tx_id % 2 = 0 group by 1, 2),
        late as (select industry_id, date_trunc('day', t_stamp) as day, sum(amount) as total_revenue, count(*) as transaction_count,
          count(distinct itx.c_id) as company_count from itx join d_company on itx.c_id = d_company.c_id
          where date_trunc('day', t_stamp) not in (select day from r) group by 1, 2),
        a as (select r.*, coalesce(total_expenses, 0) as total_expenses from (select * from r union all select * from late) r
          left join recent_cost c on r.industry_id = c.industry_id and r.day = c.day),
        b as (select *, lag(total_revenue) over (partition by industry_id order by day) as prior from a)
        select industry_id, epoch_us(cast(day as timestamp)) as time_id, total_revenue, total_expenses,
          total_revenue - total_expenses as net_profit, transaction_count,
          {ratio('total_revenue * 10000', 'company_count * 10000', 4)} as avg_revenue_per_co,
          case when abs({growth('total_revenue', 'prior')}) < 1000 then {growth('total_revenue', 'prior')} end as revenue_growth_rate,
          company_count from b""",
)
_add(
    "stream_transform_conversions",
    lambda d: _stream_transform(d).read("analytics.f_conversion"),
    "base_amount:d fee_amount:d fx_id:s tx_id:l",
    "select base_amount, fee_amount, fx_id, tx_id from cx",
)


# --- polls, metrics, batches, registration -----------------------------------


def _stream_polls(d: Domain) -> DataFrame:
    """Two files: the first with parts of some polls, the second with the rest, replays and late polls."""
    store, path, checkpoint = _store(d), scratch_path(d.spark, "polls"), scratch_path(d.spark, "checkpoint")
    polls = materialize(d.polls.withColumn("hour_no", F.floor(F.unix_timestamp("polled_at") / 3600)), "polls")
    early, part, whole = F.col("polled_at") < F.lit(MIDWAY), F.col("hour_no") % 5 == 0, F.col("hour_no") % 11 != 0
    first = early & whole & (~part | (F.col("base_cncy") < "G"))
    second = ~early | ~whole | (part & (F.col("base_cncy") >= "G")) | (F.col("hour_no") % 7 == 0)
    bounds = {code: (0.0, 4.0) for code in refdata.RATE_BOUNDS}
    for rows in (first, second):
        polls.where(rows).drop("hour_no").write.mode("append").parquet(path)
        stream = d.spark.readStream.schema(d.polls.schema).parquet(path)
        ticks.stream_polls(stream, store, checkpoint, 60 * 86_400, bounds).awaitTermination()
    return store.read("raw.fx_rate")


_add(
    "stream_polls",
    _stream_polls,
    "base_cncy:s quote_cncy:s fx_timestamp:t rate:d",
    f"""with p as (select polled_at, any_value(hour_no) as h, min(base_cncy) as low, max(base_cncy) as high,
          bool_and(base_cncy not in ({', '.join(f"'{c}'" for c in refdata.RATE_BOUNDS)}) or rate between 0 and 4) as sound from poll group by polled_at),
        m as (select max(polled_at) as mark from p
              where polled_at < timestamp '2024-01-16' and h % 11 <> 0 and (h % 5 <> 0 or high < 'G') and sound)
        select base_cncy, quote_cncy, polled_at as fx_timestamp, rate from poll join p using (polled_at), m
        where sound and (polled_at >= timestamp '2024-01-16' or (h % 11 <> 0 and (h % 5 <> 0 or low < 'G')) or mark is null or polled_at > mark)""",
)


def _ingest_metrics(d: Domain) -> DataFrame:
    """Stored metrics of a tick stream: rows read and failures."""
    path, store = scratch_path(d.spark, "metrics"), _store(d)
    log = metrics.IngestMetrics(d.spark, path)
    d.spark.streams.addListener(log)
    try:
        query = ticks.stream_fx_ticks(_streamed(d, d.fx_ticks, "ticks"), store, scratch_path(d.spark, "checkpoint"), bounds={})
        query.awaitTermination()
        log.wait_for(query.runId)
    finally:
        d.spark.streams.removeListener(log)
    own = metrics.read_metrics(d.spark, path).where(F.col("run_id") == str(query.runId))
    return metrics.ingest_summary(own).agg(F.sum("input_rows").alias("input_rows"), F.sum("failed").alias("failed"))


_add("ingest_metrics", _ingest_metrics, "input_rows:l failed:l", "select count(*) as input_rows, 0 as failed from fx_rate")


@_made_once
def _batch(d: Domain) -> TableStore:
    """One whole batch: normalized feed, quarantine, ticks of the window, logs and transform."""
    store = _store(d)
    store.append("analytics.d_company", d.companies.withColumns({c: F.col(c).cast("string") for c in ("c_id", "industry_id")}))
    feed = d.dirty_feed.withColumnsRenamed({"tx_timestamp": "when_paid", "amount": "sum_paid", "c_id": "client_id"})
    promote.run_batch(
        store, feed, d.fx_ticks, "batch", datetime(2024, 1, 5), MIDWAY, "high", d.recent_expenses,
        mapping={"when_paid": "tx_timestamp", "sum_paid": "amount"}, fx_source="synthetic",
        names=normalize.company_names(d.companies), valid_id=parsing.integer_text,
    )
    return store


def _batch_logs(d: Domain) -> DataFrame:
    store = _batch(d)
    run = store.read("raw.pipeline_run").select("batch_id", "n_transactions", "fx_source", "clean_count", "quarantine_count")
    return store.read("raw.batch_log").join(run, "batch_id")


_add(
    "run_batch_logs",
    _batch_logs,
    "batch_id:s run_timestamp:t window_start:t window_end:t rows_received:l rows_loaded:l rows_quarantined:l noise_level:s "
    "n_transactions:l fx_source:s clean_count:l quarantine_count:l",
    """select 'batch' as batch_id, timestamp '2024-01-16' as run_timestamp, timestamp '2024-01-05' as window_start,
       timestamp '2024-01-16' as window_end, a as rows_received, c as rows_loaded, v as rows_quarantined, 'high' as noise_level,
       a as n_transactions, 'synthetic' as fx_source, c as clean_count, v as quarantine_count
       from (select count(*) as a from checked), (select count(*) as c from clean), (select count(*) as v from violation)""",
)
_add(
    "normalize_mapped_feed",
    lambda d: _batch(d).read("raw.transaction_event"),
    _CLEAN,
    "select tx_id, c_id, base_cncy, quote_cncy, amount, fee_amount, tx_timestamp from clean",
)


def _load_all(d: Domain) -> DataFrame:
    """Rows handed in per table, twice, and what is stored after the second time."""
    # The feed is parsed and the expenses are built once, not by each load.
    store, n, expenses = _store(d), d.stored, materialize(d.expenses, "expenses")
    tables = {"fx_rates": "raw.fx_rate", "transactions": "raw.transaction_event", "expenses": "raw.expense_event", "quarantine": "raw.quarantine_event"}
    for _ in range(2):
        counts = landing.load_all(store, d.fx_ticks, n.clean, expenses, n.quarantine, "batch", NOW)
    rows = [(name, counts[name], store.read(table).count()) for name, table in tables.items()]
    return d.spark.createDataFrame(rows, "table_name string, received bigint, stored bigint")


_add(
    "load_all",
    _load_all,
    "table_name:s received:l stored:l",
    """select 'fx_rates' as table_name, count(*) as received, count(*) as stored from fx_rate
       union all select 'transactions', count(*), count(*) from clean
       union all select 'expenses', count(*), count(*) from expense
       union all select 'quarantine', count(*), count(*) from violation""",
)


def _report_csv(d: Domain) -> DataFrame:
    path = scratch_path(d.spark, "report")
    report = reports.company_revenue_by_currency(d.f_transaction, d.companies)
    landing.write_report_csv(report, path)
    return d.spark.read.option("header", True).schema(report.schema).csv(path)


_add(
    "write_report_csv",
    _report_csv,
    "c_id:l c_name:s cncy:s total_revenue:d",
    "select * from company_cncy",
)


def _fx_sources(d: Domain) -> DataFrame:
    live = fx_feed.get_fx_rates("live", d.fx_ticks).withColumn("source", F.lit("live"))
    window = fx_feed.get_fx_rates("synthetic", d.fx_ticks, datetime(2024, 1, 5), MIDWAY)
    return live.unionByName(window.withColumn("source", F.lit("synthetic")))


_add(
    "fx_sources",
    _fx_sources,
    "source:s base_cncy:s quote_cncy:s fx_timestamp:t rate:d",
    """select 'live' as source, base_cncy, quote_cncy, fx_timestamp, rate from fx_rate
       qualify row_number() over (partition by base_cncy, quote_cncy order by fx_timestamp desc, rate desc) = 1
       union all select 'synthetic', base_cncy, quote_cncy, fx_timestamp, rate from fx_rate
       where fx_timestamp between timestamp '2024-01-05' and timestamp '2024-01-16'""",
)
_USER_RULES = [
    normalize.Rule("RATIO", "ratio above 5", "10 / (tx_id % 5) > 5"),
    normalize.Rule("FLAG", "flag is set or absent", "array(0, 1, 0)[tx_id % 4] > 0"),
]
_add(
    "user_rules",
    lambda d: normalize.split_quarantine(d.intraday, _USER_RULES)[1],
    "tx_id:l amount:d failure_code:s failure_reason:s",
    """select tx_id, amount, 'RATIO' as failure_code, 'ratio above 5' as failure_reason from intraday where tx_id % 5 in (0, 1)
       union all select tx_id, amount, 'FLAG', 'flag is set or absent' from intraday where tx_id % 4 in (1, 3)""",
)
_add(
    "quarantine_unresolved_iso",
    lambda d: quarantine.unresolved(d.quarantine_events, d.resolutions, d.companies, "INVALID_AMOUNT, NULL_COMPANY_ID ,", iso=True),
    "quarantine_id:s tx_id:l c_name:s failure_code:s tx_timestamp:s ingestion_timestamp:s",
    """select q.quarantine_id, q.tx_id, c.c_name, q.failure_code, strftime(q.tx_timestamp, '%Y-%m-%dT%H:%M:%S') as tx_timestamp,
       strftime(q.ingestion_timestamp, '%Y-%m-%dT%H:%M:%S') as ingestion_timestamp
       from quarantine_event q left join d_company c on c.c_id = q.c_id
       where failure_code in ('INVALID_AMOUNT', 'NULL_COMPANY_ID') and quarantine_id not in (select quarantine_id from resolution)""",
)


def _registered(d: Domain) -> DataFrame:
    """Two batches of requests, one after the other."""
    store = _store(d)
    for part in ("c_custkey % 2 = 0", "c_custkey % 2 = 1"):
        dimensions.register(store, d.company_requests.where(part).drop("c_custkey"))
    keys = store.read("state.company_key").where("weight is not null")
    names = store.read("analytics.d_company").select("c_id", F.col("c_name").alias("stored_name"))
    return keys.join(names, "c_id")


_NEW_KEY = "'COMP' || lpad((12 + n)::varchar, greatest(3, length((12 + n)::varchar))::int, '0')"
_add(
    "register_companies",
    _registered,
    "company_key:s c_id:s c_name:s stored_name:s hq_country:s default_cncy:s industry_id:s weight:d",
    f"""with ok as (select * from company_request where industry <> 'Mining' and default_cncy <> 'XXX' and weight between 0.01 and 1),
        k as (select *, row_number() over (order by c_custkey % 2, name, hq_country, default_cncy, industry, weight) as n from ok)
        select {_NEW_KEY} as company_key, {uuid5_sql(refdata.COMPANY_NAMESPACE, _NEW_KEY)} as c_id, name as c_name, name as stored_name,
          hq_country, default_cncy, {uuid5_sql(refdata.INDUSTRY_NAMESPACE, 'industry')} as industry_id, weight from k""",
)


def _growth_store(d: Domain) -> DataFrame:
    store = _store(d)
    store.append("analytics.f_industry", _partly_filled(d))
    promote.backfill_growth(store)
    return store.read("analytics.f_industry")


_add("growth_backfill_store", _growth_store, QUERIES["industry_growth_null"].columns, QUERIES["industry_growth_null"].sql)


def _stored_kpis(d: Domain) -> DataFrame:
    """From the maintained aggregate, without the facts."""
    store = _store(d)
    store.append("analytics.f_industry", d.f_industry)
    return reports.kpis(store.read("analytics.f_industry"), d.companies)


_add("kpis_stored", _stored_kpis, QUERIES["kpis"].columns, QUERIES["kpis"].sql)

# --- checks of the fitted models ---------------------------------------------


def _covariances(d: Domain) -> DataFrame:
    """Covariances put together again from all components and their variances."""
    known = _known(d)
    fitted = clustering.fit_components(known, _FEATURES)
    total = sum(known.agg(*[F.var_samp(c) for c in _FEATURES]).first())
    return clustering.covariance_table(d.spark, fitted, total).withColumn("covariance", F.round("covariance", 6) + 0.0)


def _covariance_sql() -> str:
    pairs = [(a, b) for a in _FEATURES for b in _FEATURES if a <= b]
    sums = ", ".join(f"covar_samp({a}, {b}) as v{i}" for i, (a, b) in enumerate(pairs))
    rows = ", ".join(f"{{'feature': '{a}', 'other': '{b}', 'covariance': round(v{i}, 6) + 0.0}}" for i, (a, b) in enumerate(pairs))
    return f"""select r.feature as feature, r.other as other, r.covariance as covariance from (
        select unnest([{rows}]) as r from (select {sums} from ({_matrix_sql()}) m where company_known = 1) s) t"""


_add("ml_covariance_check", _covariances, "feature:s other:s covariance:d", _covariance_sql())


def _projection_norms(d: Domain) -> DataFrame:
    """Squared length of each unseen record's projection on all components: its distance from the centre."""
    known, unknown = features.split_by_company(materialize(_matrix(d), "matrix"))
    projected = clustering.fit_components(known, _FEATURES).transform(unknown)
    parts = F.aggregate(vector_to_array("components"), F.lit(0.0), lambda s, x: s + x * x)
    return projected.select("quarantine_id", F.round(parts, 6).alias("squared"))


def _norms_sql() -> str:
    terms = " + ".join(f"pow(u.{c} - k.{c}, 2)" for c in _FEATURES)
    means = ", ".join(f"avg({c}) as {c}" for c in _FEATURES)
    return f"""with m as ({_matrix_sql()}), k as (select {means} from m where company_known = 1)
        select quarantine_id, round({terms}, 6) as squared from m u, k where u.company_known = 0"""


_add("ml_projection_check", _projection_norms, "quarantine_id:s squared:d", _norms_sql())


def _kmeans_checked(d: Domain) -> DataFrame:
    """For each k: points, clusters, points not with their nearest centre, and error of the inertia."""
    projected = _projected(d)
    return clustering.check_fits(projected, clustering.fit_kmeans(projected, range(2, 9)))


_add(
    "ml_kmeans_check",
    _kmeans_checked,
    "k:l points:l clusters:l misplaced:l inertia_error:d",
    f"""select k.range as k, count(*) as points, k.range as clusters, 0 as misplaced, 0.0 as inertia_error
        from ({_matrix_sql()}) m, range(2, 9) k where company_known = 1 group by k.range""",
)


def _labelled(d: Domain) -> DataFrame:
    """The matrix with clusters by a rule of its own."""
    parts = F.col("amount_is_valid") + 2 * F.col("currency_mismatch")
    return _matrix(d).withColumn("cluster", parts.cast("int"))


_add(
    "ml_crosstab_check",
    lambda d: clustering.crosstab(_labelled(d), 4),
    "failure_code:s cluster_0:l cluster_1:l cluster_2:l cluster_3:l total:l share_0:d share_1:d share_2:d share_3:d",
    f"""select failure_code, {', '.join(f'count(*) filter (where c = {i}) as cluster_{i}' for i in range(4))}, count(*) as total,
        {', '.join(ratio(f'count(*) filter (where c = {i})', 'count(*)', 3) + f' as share_{i}' for i in range(4))}
        from (select failure_code, cast(amount_is_valid + 2 * currency_mismatch as int) as c from ({_matrix_sql()}) m) x group by failure_code""",
)


def _silhouette_of_rule(d: Domain) -> DataFrame:
    rows = features.as_vector(_labelled(d), _FEATURES)
    value = clustering.silhouette(materialize(rows, "labelled"))
    return d.spark.createDataFrame([(round(value, 6),)], "silhouette double")


def _silhouette_sql() -> str:
    """Mean squared distances to clusters from their sums: |x|^2 + mean |y|^2 - 2 x mean y."""
    norm = " + ".join(f"{c} * {c}" for c in _FEATURES)
    sums = ", ".join(f"avg({c}) as {c}" for c in _FEATURES)
    dot = " + ".join(f"p.{c} * q.{c}" for c in _FEATURES)
    return f"""with p as (select *, cast(amount_is_valid + 2 * currency_mismatch as int) as c, {norm} as norm,
          row_number() over () as row from ({_matrix_sql()}) m),
        q as (select c, count(*) as n, avg(norm) as mean_norm, {sums} from p group by c),
        d as (select p.row, p.c = q.c as own, q.n, p.norm + q.mean_norm - 2 * ({dot}) as far from p, q),
        s as (select row, max(n) filter (where own) as n, max(far) filter (where own) as a, min(far) filter (where not own) as b from d group by row)
        select round(avg(case when n = 1 then 0 else
          case when a * n / (n - 1) < b then 1 - a * n / (n - 1) / b when a * n / (n - 1) > b then b / (a * n / (n - 1)) - 1 else 0 end end), 6) as silhouette
        from s"""


_add("ml_silhouette_check", _silhouette_of_rule, "silhouette:d", _silhouette_sql())
