"""Reference SQL (DuckDB dialect) for the registered queries.

Each domain table is one named subquery over the benchmark's tables; a query lists only its
body and the subqueries it reads are collected from the names it mentions.
"""

from __future__ import annotations

import re
import uuid

from tallybook import refdata

CODES = list(refdata.CURRENCIES)


def code_case(number: str) -> str:
    whens = " ".join(f"when {i} then '{c}'" for i, c in enumerate(CODES))
    return f"case ({number}) % {len(CODES)} {whens} end"


def foreign_case(number: str) -> str:
    whens = " ".join(f"when {i} then '{c}'" for i, c in enumerate(CODES[1:]))
    return f"case ({number}) % {len(CODES) - 1} {whens} end"


def uuid5_sql(namespace: str, name: str) -> str:
    h = f"sha1(unhex('{uuid.UUID(namespace).hex}') || encode({name}))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '{'89ab' * 4}')"
    return (
        f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || "
        f"{variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12))"
    )


def surrogate_sql(kind: str, *parts: str) -> str:
    joined = " || '|' || ".join(f"coalesce(cast({p} as varchar), 'None')" for p in parts)
    return uuid5_sql(refdata.SURROGATE_NAMESPACE, f"'{kind}|' || {joined}")


def ratio(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator of integers, rounded half-up in integer arithmetic."""
    n, d, p = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)", 10**digits
    return (
        f"(case when {d} = 0 then null else "
        f"sign({n}) * ((2 * abs({n}) * {p} + {d}) // (2 * {d})) / {float(p)} end)"
    )


def avg_money(column: str, digits: int) -> str:
    """Average of a decimal(., 4) column."""
    return ratio(f"sum(cast({column} * 10000 as hugeint))", f"(count({column}) * 10000)", digits)


def growth(current: str, prior: str) -> str:
    return f"round(({current} - {prior}) / nullif({prior}, 0) * 100, 4)"


_ALIASES = ", ".join(f"('{a}', '{c}')" for a, c in refdata.currency_aliases().items())
_FORMATS = [
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%SZ", "%m/%d/%Y %I:%M %p",
    "%m/%d/%Y %H:%M", "%d-%m-%Y %H:%M", "%d/%m/%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S",
]
_CATEGORIES = ", ".join(f"({i}, '{n}')" for i, n in enumerate(refdata.EXPENSE_CATEGORIES))
_CURRENCIES = ", ".join(f"('{c}', '{n}')" for c, n in refdata.CURRENCIES.items())
_NUMBER = r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"


def _cycle(n: int, values: dict[int, str], default: str) -> str:
    whens = " ".join(f"when {k} then {v}" for k, v in values.items())
    return f"case event_id % {n} {whens} else {default} end"


_D2 = "cast(cast(value as decimal(18,2)) as varchar)"
_WIDE = f"lpad({_D2}, 6, '0')"

SUBQUERIES: dict[str, str] = {
    "n_sup": "select count(*) as n from supplier",
    "d_company": f"""select s_suppkey as c_id, s_name as c_name, n_name as hq_country,
        {code_case('s_suppkey')} as default_cncy, n_regionkey as industry_id
        from supplier join nation on s_nationkey = n_nationkey""",
    "d_industry": """select r_regionkey as industry_id, r_name as name,
        case when r_regionkey % 2 = 1 then 'EUR' else 'USD' end as display_cncy from region""",
    "d_currency": f"select * from (values {_CURRENCIES}) v(cncy_code, cncy_name)",
    "d_category": f"select * from (values {_CATEGORIES}) v(category_id, category_name)",
    "ledger": """select o_orderkey as tx_id, c.c_id, c.default_cncy as base_cncy, cast(null as varchar) as quote_cncy,
        o_orderdate as tx_timestamp, cast(o_totalprice as decimal(18,4)) as amount,
        case when o_orderkey % 7 = 0 then null
          else cast(cast(o_totalprice as decimal(18,2)) * cast(0.0025 as decimal(6,4)) as decimal(16,4)) end as fee_amount
        from orders cross join n_sup join d_company c on c.c_id = o_custkey % n_sup.n""",
    "fx_rate": f"""select event_id as fx_rate_id, {foreign_case('user_id')} as base_cncy, 'USD' as quote_cncy,
        ts as fx_timestamp, cast(0.5::double + value / 100 as decimal(14,7)) as rate
        from events where event_type = 'view'""",
    "intraday": f"""select event_id as tx_id, user_id % n as c_id, {foreign_case('user_id')} as base_cncy,
        case when event_id % 3 = 0 then 'USD' end as quote_cncy, ts as tx_timestamp,
        cast(value as decimal(18,4)) as amount,
        cast(cast(value as decimal(18,2)) * cast(0.005 as decimal(5,3)) as decimal(16,4)) as fee_amount
        from events cross join n_sup where event_type in ('purchase', 'click')""",
    "expense": """select l_orderkey * 8 + l_linenumber as expense_id, l_suppkey as c_id, 'USD' as cncy,
        l_shipdate as expense_timestamp,
        cast(cast(l_extendedprice as decimal(18,2)) * cast(l_tax as decimal(4,2)) as decimal(18,4)) as amount,
        l_linenumber % 6 as category_id
        from lineitem qualify row_number() over (partition by l_orderkey, l_linenumber
          order by l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_tax) = 1""",
    "recent_expense": """select expense_id, c_id, cncy, amount, category_id,
        timestamp '2024-01-01' + to_hours(cast((expense_id % 30) * 24 + expense_id % 24 as integer)) as expense_timestamp from expense""",
    "poll": """select date_trunc('hour', fx_timestamp) as polled_at, base_cncy, quote_cncy, min(rate) as rate,
        epoch(date_trunc('hour', fx_timestamp)) // 3600 as hour_no from fx_rate group by all""",
    "company_request": f"""select c_custkey, trim(c_name) as name, c_nationkey::varchar as hq_country,
        case c_custkey % {len(refdata.INDUSTRIES) + 1} {' '.join(f"when {i} then '{n}'" for i, n in enumerate([*refdata.INDUSTRIES, "Mining"]))} end as industry,
        case c_custkey % {len(CODES) + 1} {' '.join(f"when {i} then '{c}'" for i, c in enumerate([*CODES, "XXX"]))} end as default_cncy,
        cast(c_custkey % 110 as double) / 100 as weight from customer""",
    "raw_bad": """select l_orderkey * 8 + l_linenumber as tx_id,
        case when l_partkey % 50 = 0 then null else l_partkey % (n + 5) end as c_id,
        case l_partkey % 20 when 0 then 'XXX' when 1 then null else 'USD' end as base_cncy,
        case when l_partkey % 37 = 0 then null else l_shipdate end as tx_timestamp,
        cast(case when l_tax = 0 then 0 else l_extendedprice end as decimal(18,4)) as amount,
        l_shipdate as ingestion_timestamp
        from lineitem cross join n_sup""",
    "dirty": f"""select event_id as tx_id,
        {_cycle(10, {0: 'null', 1: f"'$' || {_D2}", 2: f"'(' || {_D2} || ')'", 3: f"'-' || {_D2}",
                     4: f"replace({_D2}, '.', ',')", 5: f"'1,' || {_WIDE}",
                     6: f"'1.' || replace({_WIDE}, '.', ',')", 7: f"'1 ' || {_WIDE}"}, _D2)} as amount,
        {_cycle(8, {0: "strftime(ts, '%m/%d/%Y %H:%M')", 1: "strftime(ts, '%d-%m-%Y %H:%M')",
                    2: "cast(45291 + day(ts) as varchar) || '.5'", 3: 'null', 4: "'14-32-2026'"},
                "strftime(ts, '%Y-%m-%d %H:%M:%S')")} as tx_timestamp,
        {_cycle(6, {0: "'euro'", 1: "' usd '", 2: "'$'", 3: "'XXX'"}, "'GBP'")} as base_cncy,
        {_cycle(12, {0: 'null', 1: 'lower(c.c_name)', 2: "' ' || upper(c.c_name) || ' '",
                     3: "'not_a_company'"}, 'cast(c.c_id as varchar)')} as c_id,
        {_cycle(9, {0: 'null', 1: "'2.5%'", 2: "'99999'", 3: "'n/a'"},
                "cast(cast(cast(value as decimal(18,2)) * cast(0.002 as decimal(5,3)) as decimal(18,4)) as varchar)")} as fee_amount,
        case when event_id % 5 = 0 then 'USD' end as quote_cncy, cast(ts as date) as batch_day
        from events cross join n_sup join d_company c on c.c_id = user_id % n_sup.n
        where event_type in ('signup', 'error')""",
    "alias": f"select * from (values {_ALIASES}) v(spelling, code)",
    "company_name": "select upper(trim(c_name)) as name, max(c_id) as id from d_company group by 1",
    "parsed_amount": """select *, regexp_replace(trim(amount), '^[£$€¥₹\\s]+', '') as a from dirty""",
    "parsed": rf"""select p.tx_id, p.batch_day, p.fee_amount as raw_fee, p.amount as raw_amount, p.tx_timestamp as raw_ts,
        p.base_cncy as raw_cncy, trim(p.c_id) as raw_c_id,
        case when (a like '(%' and a like '%)') or a like '-%' or (contains(a, ',') and not contains(a, '.')) then null
          else try_cast(replace(case when not contains(a, ',') then a
                when strpos(a, ',') < strpos(a, '.') then replace(a, ',', '')
                else replace(replace(a, '.', ''), ',', '.') end, ' ', '') as double) end as amount,
        case when regexp_full_match(p.tx_timestamp, '\d{{4,6}}(\.\d+)?')
          then make_timestamp(cast(round((try_cast(p.tx_timestamp as double) - 25569) * 86400000000) as bigint))
          else try_strptime(p.tx_timestamp, {_FORMATS}) end as tx_timestamp,
        b.code as base_cncy, q.code as quote_cncy,
        case when regexp_full_match(trim(p.c_id), '\d{{1,18}}') then cast(trim(p.c_id) as bigint) else cn.id end as c_id
        from parsed_amount p left join alias b on b.spelling = lower(trim(p.base_cncy))
        left join alias q on q.spelling = lower(trim(p.quote_cncy))
        left join company_name cn on cn.name = upper(trim(p.c_id))""",
    "fees": rf"""select *, case when raw_fee is null then 0
          when raw_fee like '%\%' escape '\' then coalesce(round(coalesce(cast(amount as decimal(18,4)), 0)
            * (cast(replace(raw_fee, '%', '') as decimal(6,4)) * cast(0.01 as decimal(3,2))), 4), 0)
          when regexp_full_match(trim(raw_fee), '{_NUMBER}') then cast(raw_fee as decimal(18,4)) else 0 end as fee_value
        from parsed""",
    "checked": """select tx_id, c_id, base_cncy, quote_cncy, cast(amount as decimal(18,4)) as amount,
        cast(case when fee_value > cast(amount as decimal(18,4)) then 0 else fee_value end as decimal(16,4)) as fee_amount,
        tx_timestamp, batch_day, raw_amount, raw_ts, raw_cncy, raw_c_id,
        case when c_id is null then 1 else 0 end as bad_company,
        case when amount is null or amount <= 0 then 1 else 0 end as bad_amount,
        case when tx_timestamp is null then 1 else 0 end as bad_time,
        case when base_cncy is null then 1 else 0 end as bad_currency
        from fees""",
    "clean": "select * from checked where bad_company + bad_amount + bad_time + bad_currency = 0",
    "violation": """select *, 'NULL_COMPANY_ID' as failure_code, 'c_id is null after normalization' as failure_reason,
          raw_c_id as dirty_value from checked where bad_company = 1
        union all select *, 'INVALID_AMOUNT', 'amount is null or non-positive after normalization', raw_amount
          from checked where bad_amount = 1
        union all select *, 'NULL_TIMESTAMP', 'tx_timestamp is null after normalization', raw_ts
          from checked where bad_time = 1
        union all select *, 'INVALID_BASE_CURRENCY', 'base_cncy is null or unresolvable after normalization', raw_cncy
          from checked where bad_currency = 1""",
    "quarantine_event": f"""select {uuid5_sql(refdata.QUARANTINE_NAMESPACE, "cast(batch_day as varchar) || ':' || cast(tx_id as varchar) || ':' || failure_code")} as quarantine_id,
        tx_id, c_id, base_cncy, quote_cncy, amount, fee_amount, tx_timestamp, failure_code, failure_reason,
        cast(batch_day as varchar) as batch_id, dirty_value,
        count(*) over (partition by batch_day, tx_id) as failure_count,
        cast(batch_day as timestamp) + interval 1 day as ingestion_timestamp from violation""",
    "resolution": """select quarantine_id, case when tx_id % 8 = 0 then 'deleted' else 'requeued' end as action
        from quarantine_event where tx_id % 4 = 0""",
    "pipeline_run": """select cast(batch_day as varchar) as batch_id,
        case day(batch_day) % 3 when 0 then 'low' when 1 then 'medium' else 'high' end as noise_level,
        count(*) as n_transactions, cast(batch_day as timestamp) + interval 1 day as run_timestamp,
        cast(count(*) as double) / 100 as duration_seconds,
        sum(case when bad_company + bad_amount + bad_time + bad_currency = 0 then 1 else 0 end) as clean_count,
        sum(bad_company + bad_amount + bad_time + bad_currency) as quarantine_count
        from checked group by batch_day""",
    "raw_violation": """with counted as (select *, count(*) over (partition by tx_id) as copies from raw_bad)
        select *, 'NULL_COMPANY_ID' as failure_code, 'c_id is null' as failure_reason from counted where c_id is null
        union all select *, 'INVALID_AMOUNT', 'amount is null or non-positive' from counted where amount is null or amount <= 0
        union all select *, 'UNKNOWN_COMPANY', 'c_id not found in analytics.d_company' from counted
          where c_id is not null and c_id not in (select c_id from d_company)
        union all select *, 'INVALID_BASE_CURRENCY', 'base_cncy not found in analytics.d_currency' from counted
          where base_cncy not in (select cncy_code from d_currency)
        union all select *, 'DUPLICATE_TX_ID', 'tx_id appears more than once in raw.transaction_event' from counted where copies > 1
        union all select *, 'NULL_TIMESTAMP', 'tx_timestamp is null' from counted where tx_timestamp is null""",
    "q_log": """select tx_id, c_id, base_cncy, tx_timestamp, amount, fee_amount, quote_cncy, ingestion_timestamp, batch_id,
          failure_code, failure_reason, 'python_layer' as source from quarantine_event
        union all select tx_id, c_id, base_cncy, tx_timestamp, amount, null, null, ingestion_timestamp, null,
          failure_code, failure_reason, 'sql_layer' from raw_violation""",
    "tx": """select tx_id, cast(amount - coalesce(fee_amount, 0) as decimal(18,4)) as amount, c_id,
        epoch_us(tx_timestamp) as time_id, tx_timestamp as t_stamp, base_cncy as cncy from ledger""",
    "itx": """select tx_id, cast(amount - coalesce(fee_amount, 0) as decimal(18,4)) as amount, c_id,
        tx_timestamp as t_stamp, base_cncy as cncy from intraday""",
    "ex": """select expense_id, amount, cncy, c_id, epoch_us(expense_timestamp) as time_id,
        expense_timestamp as t_stamp, category_id from expense""",
    "matched": """select t.*, f.fx_timestamp, f.rate from intraday t asof left join fx_rate f
        on t.base_cncy = f.base_cncy and t.quote_cncy = f.quote_cncy and t.tx_timestamp >= f.fx_timestamp""",
    "converted": """select *, case when rate is not null then cast(round(amount * rate, 4) as decimal(18,4)) end as usd,
        case when rate is not null then 'converted' else 'missing_rate' end as conversion_flag from matched""",
    "fx_dim": f"""select {surrogate_sql('fx', 'rate', 'base_cncy', 'quote_cncy')} as fx_id, rate, base_cncy, quote_cncy
        from (select distinct rate, base_cncy, quote_cncy from fx_rate) d""",
    "cx": f"""select {surrogate_sql('cx', 'tx_id')} as cx_id, amount as base_amount, fee_amount,
        {surrogate_sql('fx', 'rate', 'base_cncy', 'quote_cncy')} as fx_id, tx_id, rate, base_cncy, quote_cncy
        from matched where rate is not null""",
    "rex": """select expense_id, amount, cncy, c_id, epoch_us(expense_timestamp) as time_id,
        expense_timestamp as t_stamp, category_id from recent_expense""",
    "recent_revenue": """select industry_id, date_trunc('day', t_stamp) as day, sum(amount) as total_revenue,
        count(*) as transaction_count, count(distinct itx.c_id) as company_count
        from itx join d_company on itx.c_id = d_company.c_id group by 1, 2""",
    "recent_cost": """select industry_id, date_trunc('day', t_stamp) as day, sum(amount) as total_expenses
        from rex join d_company on rex.c_id = d_company.c_id group by 1, 2""",
    "recent_daily": f"""select r.industry_id, r.day, total_revenue, coalesce(total_expenses, 0) as total_expenses,
        total_revenue - coalesce(total_expenses, 0) as net_profit, transaction_count, company_count,
        {ratio('total_revenue * 10000', 'company_count * 10000', 4)} as avg_revenue_per_co,
        lag(total_revenue) over (partition by r.industry_id order by r.day) as prior
        from recent_revenue r left join recent_cost c on r.industry_id = c.industry_id and r.day = c.day""",
    "recent_industry": f"""select industry_id, epoch_us(cast(day as timestamp)) as time_id, total_revenue, total_expenses, net_profit,
        transaction_count, avg_revenue_per_co, company_count,
        case when abs({growth('total_revenue', 'prior')}) < 1000 then {growth('total_revenue', 'prior')} end as revenue_growth_rate
        from recent_daily""",
    "daily_revenue": """select industry_id, date_trunc('day', t_stamp) as day, sum(amount) as total_revenue,
        count(*) as transaction_count, count(distinct tx.c_id) as company_count
        from tx join d_company on tx.c_id = d_company.c_id group by 1, 2""",
    "daily_cost": """select industry_id, date_trunc('day', t_stamp) as day, sum(amount) as total_expenses
        from ex join d_company on ex.c_id = d_company.c_id group by 1, 2""",
    "daily": f"""select r.industry_id, r.day, total_revenue, coalesce(total_expenses, 0) as total_expenses,
        total_revenue - coalesce(total_expenses, 0) as net_profit, transaction_count, company_count,
        {ratio('total_revenue * 10000', 'company_count * 10000', 4)} as avg_revenue_per_co,
        lag(total_revenue) over (partition by r.industry_id order by r.day) as prior
        from daily_revenue r left join daily_cost c on r.industry_id = c.industry_id and r.day = c.day""",
    "f_industry": f"""select industry_id, day, epoch_us(cast(day as timestamp)) as time_id, total_revenue, total_expenses, net_profit,
        transaction_count, avg_revenue_per_co, company_count, prior,
        case when abs({growth('total_revenue', 'prior')}) < 1000 then {growth('total_revenue', 'prior')} end as revenue_growth_rate
        from daily""",
    "latest": """select base_cncy, quote_cncy, round(rate, 6) as rate, fx_timestamp from fx_rate
        qualify row_number() over (partition by base_cncy, quote_cncy order by fx_timestamp desc) = 1""",
    "company_cncy": """select tx.c_id, c_name, cncy, round(sum(amount), 2) as total_revenue
        from tx join d_company on tx.c_id = d_company.c_id group by 1, 2, 3""",
}

_TYPES = {"l": "bigint", "s": "varchar", "d": "double", "t": "timestamp", "b": "boolean"}
_ORDER = list(SUBQUERIES)


def statement(body: str, spec: str) -> str:
    """Complete SQL for a body, with every output column cast as `spec` (name:type ...) says."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(SUBQUERIES[name])

    visit(body)
    withs = ",\n".join(f"{n} as ({SUBQUERIES[n]})" for n in _sorted(needed))
    columns = ", ".join(
        f"cast({c} as {_TYPES[t]}) as {c}" for c, t in (item.split(":") for item in spec.split())
    )
    head = f"with {withs}\n" if withs else ""
    return f"{head}select {columns} from ({body}) result"


def _sorted(names: set[str]) -> list[str]:
    """Definition order with every subquery after those it reads."""
    done: list[str] = []

    def add(name: str) -> None:
        if name in done:
            return
        for other in _ORDER:
            if other != name and other in names and re.search(rf"\b{other}\b", SUBQUERIES[name]):
                add(other)
        done.append(name)

    for name in _ORDER:
        if name in names:
            add(name)
    return done
