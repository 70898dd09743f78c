import uuid
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import ids, parsing


def run(spark, values, kind, parse, column="v"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = parse(spark.createDataFrame(rows, f"i int, {column} {kind}"))
    return [r[column] for r in df.orderBy("i").collect()]


def test_amount_texts(spark):
    cases = {
        "1200.50": 1200.5, "1,200.50": 1200.5, "$1200.50": 1200.5, "1 200.50": 1200.5, "1.200,50": 1200.5,
        "1.000,00": 1000.0, " € 12.5 ": 12.5, "+5": 5.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "1_000": 1000.0,
        "1,234,567.89": 1234567.89, "0": 0.0,
        "-1200.50": None, "(1200.50)": None, "$-5": None, "99,00": None, "500,50": None, "1,200": None,
        "12.5d": None, "nan": None, "inf": None, "": None, "1.2.3": None, "abc": None, "1__0": None, None: None,
    }
    got = run(spark, list(cases), "string", lambda df: parsing.parse_amounts(df, "v"))
    assert dict(zip(cases, got)) == cases


def test_numeric_amounts(spark):
    got = run(spark, [1200.5, -100.0, float("nan"), None, 0.0], "double", lambda df: parsing.parse_amounts(df, "v"))
    assert got == [1200.5, None, None, None, 0.0]


def test_long_digit_runs_do_not_backtrack(spark):
    got = run(spark, ["9" * 5000 + "x", "1" * 20], "string", lambda df: parsing.parse_amounts(df, "v"))
    assert got == [None, float("1" * 20)]


def test_timestamp_texts(spark):
    at = datetime(2026, 2, 14, 13, 45)
    cases = {
        "2026-02-14 13:45:00": at, "2026-02-14T13:45:00": at, "2026-02-14T13:45:00Z": at,
        "02/14/2026 1:45 PM": at, "02/14/2026 01:45 pm": at, "02/14/2026 13:45": at, "14-02-2026 13:45": at,
        "14/02/2026 13:45:00": at, "2026/02/14 13:45:00": at, "  2026-02-14   13:45:00 ": at,
        "14/02/2026 13:45": at, "02-14-2026 13:45": at,
        "46067.572916666664": at,
        "2026": datetime(1905, 7, 18), "45291.5": datetime(2023, 12, 31, 12),
        "2026-02-14": datetime(2026, 2, 14), "20260214": datetime(2026, 2, 14),
        "2026-02-14T13:45:00+02:00": datetime(2026, 2, 14, 11, 45),
        "03/04/2026 05:06": datetime(2026, 3, 4, 5, 6), "03-04-2026 05:06": datetime(2026, 4, 3, 5, 6),
        "14 Feb 2026 13:45": at, "February 14, 2026": datetime(2026, 2, 14), "14-Feb-2026": datetime(2026, 2, 14),
        "2026/02/14 13:45": at, "14.02.2026 13:45": at, "Feb 14 2026 1:45 PM": at, "20260214T134500": at,
        "2026-02-14 1:45 PM": at, "Sat, 14 Feb 2026 13:45:00 GMT": at, "02/14/2026 01:45:30 PM": at.replace(second=30),
        "14 February 2026": datetime(2026, 2, 14), "Feb 14, 2026 13:45": at, "14.02.2026": datetime(2026, 2, 14),
        "14-Abc-2026": None, "31.02.2026": None, "Sat, 14 Feb 2026 25:45:00 GMT": None,
        "14-32-2026": None, "2026-02-30 00:00:00": None, "10:11": None, "now": None, "": None, "123": None,
        "02/14/2026 13:45 PM": None, None: None,
    }
    got = run(spark, list(cases), "string", lambda df: parsing.parse_timestamps(df, "v"))
    assert dict(zip(cases, got)) == cases


def test_native_timestamps(spark):
    at = datetime(2026, 2, 14, 13, 45)
    assert run(spark, [at, None], "timestamp", lambda df: parsing.parse_timestamps(df, "v")) == [at, None]
    # Without a zone the time is ambiguous.
    assert run(spark, [at], "timestamp_ntz", lambda df: parsing.parse_timestamps(df, "v")) == [None]


def test_every_currency_spelling(spark):
    aliases = refdata.currency_aliases()
    assert len(aliases) == 44
    texts = [*aliases, *refdata.CURRENCIES, " Usd ", "US Dollars", "XXX", "", None]
    want = [*aliases.values(), *refdata.CURRENCIES, "USD", "USD", None, None, None]
    assert run(spark, texts, "string", lambda df: parsing.resolve_currencies(df, ["v"])) == want


def test_fees(spark):
    cases = [
        (None, 100.0, "0.0000"), ("2.5%", 1000.0, "25.0000"), (" 2.5 % ", 1000.0, "25.0000"), ("2.5%", None, "0.0000"),
        ("12.34567", 100.0, "12.3457"), ("n/a", 100.0, "0.0000"), ("x%", 100.0, "0.0000"), ("99999", 1.0, None),
        ("99999", None, "99999.0000"), ("-3", 10.0, "-3.0000"), ("200%", 10.0, None), ("10", 10.0, "10.0000"),
    ]
    rows = [(i, f, a) for i, (f, a, _) in enumerate(cases)]
    df = parsing.parse_fees(spark.createDataFrame(rows, "i int, fee_amount string, amount double"))
    got = [r.fee_amount for r in df.orderBy("i").collect()]
    assert got == [None if w is None else Decimal(w) for *_, w in cases]


def test_numeric_fees(spark):
    df = spark.createDataFrame([(1, 99999.0, 1.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, 0.5, 1.0)], "i int, fee_amount double, amount double")
    got = [r.fee_amount for r in parsing.parse_fees(df).orderBy("i").collect()]
    assert got == [None, Decimal("0.0000"), Decimal("0.0000"), Decimal("0.5000")]


def test_uuid_spellings(spark):
    plain = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"
    texts = [plain, plain.upper(), f"{{{plain}}}", f"urn:uuid:{plain}", plain.replace("-", ""), f" {plain} ", "not-a-uuid", plain[:-1], None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(parsing.uuid_text("v")).collect()]
    assert got == [plain] * 6 + [None] * 3


@pytest.mark.parametrize("namespace", [refdata.COMPANY_NAMESPACE, refdata.QUARANTINE_NAMESPACE])
def test_uuid5_equals_python(spark, namespace):
    names = ["COMP001", "", "naïve café ₹", "a:b:None", "x" * 500]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", ids.uuid5(namespace, F.col("n")).alias("id"))
    for row in df.collect():
        assert row.id == str(uuid.uuid5(uuid.UUID(namespace), row.n))


def test_quarantine_id_spells_nulls(spark):
    row = spark.range(1).select(
        ids.quarantine_id(F.lit("b"), F.lit(None), F.lit("NULL_TIMESTAMP")).alias("id")
    ).first()
    assert row.id == str(uuid.uuid5(uuid.UUID(refdata.QUARANTINE_NAMESPACE), "b:None:NULL_TIMESTAMP"))
