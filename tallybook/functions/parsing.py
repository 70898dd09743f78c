"""Parsers for dirty feed columns, as native column expressions.

Every parser turns text into a typed column and yields NULL for what it cannot read, so that
the quarantine rules see it; none of them leaves generated code for Python. Cleaned text
that a parser looks at several times is its own column first: the optimizer keeps such a
projection apart, so the cleaning runs once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook import refdata

_SPACE = " \t\n\r\f\x0b"
# Possessive groups: no backtracking on long digit runs.
_INT = r"\d++(?:_\d++)*+"
_NUMBER = rf"^[+-]?(?:{_INT}(?:\.(?:{_INT})?)?|\.{_INT})(?:[eE][+-]?{_INT})?$"
_SERIAL = r"^\d{4,6}(\.\d+)?$"

# Accepted timestamp layouts: the shape of the text -> the pattern that reads it.
# The shapes exclude one another, so each text is tried against one pattern only. Year-first
# layouts with dashes (a space or `T` before the time, with or without `Z`) have no pattern:
# a cast reads them.
TIMESTAMP_LAYOUTS = [
    (r"^\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}Z?$", None),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2} [AaPp][Mm]$", "M/d/yyyy h:m a"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$", "M/d/yyyy H:m"),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}$", "d-M-yyyy H:m"),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", "d/M/yyyy H:m:s"),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$", "yyyy/M/d H:m:s"),
]

# Layouts tried last, month first where both readings are possible.
LAST_RESORT_LAYOUTS = [
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ["M/d/yyyy", "d/M/yyyy"]),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ["M-d-yyyy", "d-M-yyyy"]),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}$", ["d/M/yyyy H:m"]),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2}$", ["M/d/yyyy H:m:s"]),
    (r"^\d{1,2}-\d{1,2}-\d{4} \d{1,2}:\d{1,2}$", ["M-d-yyyy H:m"]),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ["yyyy/M/d"]),
    (r"^\d{8}$", ["yyyyMMdd"]),
    (r"^\d{8}T\d{6}$", ["yyyyMMdd\\'T\\'HHmmss"]),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AaPp][Mm]$", ["M/d/yyyy h:m:s a", "d/M/yyyy h:m:s a"]),
    (r"^\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}$", ["yyyy/M/d H:m"]),
    (r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2} [AaPp][Mm]$", ["yyyy-M-d h:m a"]),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ["M.d.yyyy", "d.M.yyyy"]),
    (r"^\d{1,2}\.\d{1,2}\.\d{4} \d{1,2}:\d{1,2}$", ["M.d.yyyy H:m", "d.M.yyyy H:m"]),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", ["d MMM yyyy"]),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", ["d-MMM-yyyy"]),
    (r"^\d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{1,2}$", ["d MMM yyyy H:m"]),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", ["d MMMM yyyy"]),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4}$", ["MMM d, yyyy", "MMM d yyyy"]),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4} \d{1,2}:\d{1,2} [AaPp][Mm]$", ["MMM d, yyyy h:m a", "MMM d yyyy h:m a"]),
    (r"^[A-Za-z]{3} \d{1,2},? \d{4} \d{1,2}:\d{1,2}$", ["MMM d, yyyy H:m", "MMM d yyyy H:m"]),
    (r"^[A-Za-z]{4,9} \d{1,2},? \d{4}$", ["MMMM d, yyyy", "MMMM d yyyy"]),
]


def strip(text: Column) -> Column:
    return F.btrim(text.cast("string"), F.lit(_SPACE))


def number(name: str) -> str:
    """SQL: plain decimal notation to double. Unlike a cast this refuses `12.5d` and `nan`."""
    return f"if({name} rlike r'{_NUMBER}', try_cast(replace({name}, '_', '') as double), null)"


def parse_numbers(df: DataFrame, column: str) -> DataFrame:
    text = f"__{column}"
    return df.withColumn(text, strip(F.col(column))).withColumn(column, F.expr(number(text))).drop(text)


def _timestamp_sql(t: str) -> str:
    serial = (
        f"timestamp_micros(cast(round((try_cast({t} as double) - {refdata.SPREADSHEET_EPOCH_DAYS}) "
        "* 86400000000) as bigint))"
    )
    shapes = [f"when {t} rlike r'{_SERIAL}' then {serial}"]
    for shape, pattern in TIMESTAMP_LAYOUTS:
        read = f"try_to_timestamp({t}, '{pattern}')" if pattern else f"try_cast({t} as timestamp)"
        shapes.append(f"when {t} rlike r'{shape}' then {read}")
    last = []
    for shape, patterns in LAST_RESORT_LAYOUTS:
        tries = ", ".join(f"try_to_timestamp({t}, '{p}')" for p in patterns)
        last.append(f"when {t} rlike r'{shape}' then coalesce({tries})")
    # Mail dates: a day of the week can be written but not read by a pattern.
    mail = r"^[A-Za-z]{3}, \d{1,2} [A-Za-z]{3} \d{4} \d{1,2}:\d{1,2}:\d{1,2} GMT$"
    middle = f"substring({t}, 6, length({t}) - 9)"
    last.append(f"when {t} rlike r'{mail}' then try_to_timestamp({middle}, 'd MMM yyyy H:m:s')")
    # Year-first text only: a bare time of day would be read as today's.
    last.append(rf"when {t} rlike r'^\d{{4}}-\d{{1,2}}(-|$)' then try_cast({t} as timestamp)")
    return f"coalesce(case {' '.join(shapes)} end, case {' '.join(last)} end)"


def parse_timestamps(df: DataFrame, column: str = "tx_timestamp") -> DataFrame:
    """Text, spreadsheet serial or native timestamp to a UTC timestamp."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        return df
    if isinstance(kind, (T.TimestampNTZType, T.DateType)):
        # No zone given: ambiguous, so left to the quarantine.
        return df.withColumn(column, F.lit(None).cast("timestamp"))
    text = f"__{column}"
    squeezed = F.regexp_replace(strip(F.col(column)), r"\s+", " ")
    return df.withColumn(text, squeezed).withColumn(column, F.expr(_timestamp_sql(text))).drop(text)


def resolve_currencies(df: DataFrame, columns: list[str]) -> DataFrame:
    """Any casing or known spelling of a currency to its code."""
    known = ", ".join(f"'{a}', '{c}'" for a, c in refdata.currency_aliases().items())
    codes = F.expr(f"map({known})")
    return df.withColumns({c: F.try_element_at(codes, F.lower(strip(F.col(c)))) for c in columns})


def parse_amounts(df: DataFrame, column: str = "amount") -> DataFrame:
    """Amount text in US, European or spaced notation to a non-negative double.

    Negatives, accounting parentheses and a comma without a period (which may be either a
    decimal or a thousands mark) give NULL.
    """
    if isinstance(df.schema[column].dataType, T.NumericType):
        value = F.col(column).cast("double")
        return df.withColumn(column, F.when((value >= 0) & ~F.isnan(value), value))
    t, plain = f"__{column}", f"__{column}_plain"
    bare = F.regexp_replace(strip(F.col(column)), r"^[£$€¥₹\s]+", "")
    one_notation = f"""case
        when (startswith({t}, '(') and endswith({t}, ')')) or startswith({t}, '-') then null
        when instr({t}, ',') = 0 then {t}
        when instr({t}, '.') = 0 then null
        when instr({t}, ',') < instr({t}, '.') then replace({t}, ',', '')
        else replace(replace({t}, '.', ''), ',', '.') end"""
    return (
        df.withColumn(t, bare)
        .withColumn(plain, F.expr(f"replace({one_notation}, ' ', '')"))
        .withColumn(column, F.expr(number(plain)))
        .drop(t, plain)
    )


def parse_fees(df: DataFrame, column: str = "fee_amount", amount: str = "amount") -> DataFrame:
    """Fee in money or as `p%` of the amount, to decimal(16,4).

    Missing or unreadable fees are 0; a fee above its amount has no value.
    """
    money = "decimal(18,4)"
    text, value = f"__{column}", f"__{column}_value"
    if isinstance(df.schema[column].dataType, T.NumericType):
        known = f"coalesce(try_cast(nanvl(cast({column} as double), 0) as {money}), 0)"
    else:
        df = df.withColumn(text, strip(F.col(column))).withColumn(
            value, F.regexp_replace(text, r"\s*%+$", "")
        )
        percent = f"try_cast({number(value)} as decimal(12,6))"
        share = f"try_cast(round(coalesce(try_cast({amount} as {money}), 0) * {percent} / 100, 4) as {money})"
        known = (
            f"coalesce(if(endswith({text}, '%'), {share}, try_cast({number(text)} as {money})), 0)"
        )
    return (
        df.withColumn(value, F.expr(f"cast({known} as {money})"))
        .withColumn(
            column,
            F.expr(
                f"if(coalesce({value} > try_cast({amount} as {money}), false), null, "
                f"try_cast({value} as decimal(16,4)))"
            ),
        )
        .drop(text, value)
    )


def uuid_text(column: str) -> Column:
    """Canonical lower-case text of any accepted UUID spelling, else NULL."""
    digits = F.regexp_replace(strip(F.col(column)), r"urn:|uuid:|[{}-]", "")
    dashed = F.regexp_replace(F.lower(digits), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(digits.rlike("^[0-9a-fA-F]{32}$"), dashed)


def integer_text(column: str) -> Column:
    """Trimmed digits, else NULL: the id form of tables keyed by integers."""
    text = strip(F.col(column))
    return F.when(text.rlike(r"^\d{1,18}$"), text)
