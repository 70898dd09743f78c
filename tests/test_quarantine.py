from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallybook.operators import normalize, quality, quarantine
from tallybook.plans.domain import Domain
from tallybook.sources import landing
from tallybook.sources.tables import TableStore

NOW = datetime(2026, 1, 2, 12)
FEED = "tx_id string, c_id string, base_cncy string, quote_cncy string, amount string, fee_amount string, tx_timestamp string"
ID = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"


@pytest.fixture(scope="module")
def names(spark):
    return spark.createDataFrame([("ORION SYSTEMS", ID)], "name string, id string")


def feed(spark):
    rows = [
        ("t1", ID, "usd", "EUR", "1,200.50", "2.5%", "2026-01-01 09:00:00"),
        ("t2", " Orion Systems ", "euro", None, "$5", None, "01/01/2026 9:00 AM"),
        ("t3", "nobody", "USD", None, "5", None, "2026-01-01 09:00:00"),
        ("t4", ID, "???", None, "-5", None, "never"),
        ("t5", ID, "GBP", None, "0.00001", "9", "2026-01-01 09:00:00"),
        (None, None, "GBP", None, "0", None, "2026-01-01 09:00:00"),
    ]
    return spark.createDataFrame(rows, FEED)


def test_normalize(spark, names):
    result = normalize.normalize_receipts(feed(spark), names)
    clean = {r.tx_id: r for r in result.clean.collect()}
    assert set(clean) == {"t1", "t2", "t5"}
    assert (clean["t1"].amount, clean["t1"].fee_amount) == (Decimal("1200.5000"), Decimal("30.0125"))
    assert (clean["t2"].c_id, clean["t2"].base_cncy, clean["t2"].tx_timestamp) == (ID, "EUR", datetime(2026, 1, 1, 9))
    # A fee above its amount becomes 0; a tiny positive amount is not a violation.
    assert (clean["t5"].amount, clean["t5"].fee_amount) == (Decimal("0.0000"), Decimal("0.0000"))
    found = {(r.tx_id, r.failure_code, r.dirty_value) for r in result.quarantine.collect()}
    assert found == {
        ("t3", "NULL_COMPANY_ID", "nobody"),
        ("t4", "INVALID_AMOUNT", "-5"),
        ("t4", "NULL_TIMESTAMP", "never"),
        ("t4", "INVALID_BASE_CURRENCY", "???"),
        (None, "NULL_COMPANY_ID", None),
        (None, "INVALID_AMOUNT", "0"),
    }


def test_every_row_is_clean_or_quarantined(spark):
    d = Domain(spark, "/root/testdata/sf0.001")
    all_ids = {r.tx_id for r in d.dirty_feed.select("tx_id").collect()}
    clean = {r.tx_id for r in d.normalized.clean.select("tx_id").collect()}
    bad = [r.tx_id for r in d.normalized.quarantine.select("tx_id").collect()]
    assert clean | set(bad) == all_ids and not clean & set(bad) and len(bad) >= len(set(bad))


def test_clean_feed_has_no_quarantine(spark, names):
    result = normalize.normalize_receipts(feed(spark).where("tx_id = 't1'"), names)
    assert result.quarantine.isEmpty() and result.clean.count() == 1
    assert {"failure_code", "failure_reason", "dirty_value"} <= set(result.quarantine.columns)


def test_feed_column_names(spark, names):
    dirty = feed(spark).withColumnsRenamed({"tx_timestamp": "data_hora", "amount": "valor", "base_cncy": "moeda", "fee_amount": "taxa"})
    assert normalize.normalize_receipts(dirty, names).clean.count() == 3
    assert normalize.rename_columns(dirty.withColumnRenamed("c_id", "empresa_id")).columns[1] == "company_id"


def test_user_rule(spark, names):
    rules = [*normalize.RULES, normalize.Rule("TOO_BIG", "amount above 1000", "amount > 1000")]
    result = normalize.normalize_receipts(feed(spark), names, rules)
    # An unknown outcome counts as a violation: t4's amount is null.
    assert {r.tx_id for r in result.quarantine.where("failure_code = 'TOO_BIG'").collect()} == {"t1", "t4"}
    clean, bad = normalize.split_quarantine(spark.createDataFrame([(1, None), (2, 5)], "tx_id int, n int"), [normalize.Rule("N", "n", "n > 9")])
    assert [r.tx_id for r in clean.collect()] == [2] and bad.count() == 1


def test_coercion_raises_on_text(spark):
    df = spark.createDataFrame([("not_a_number", None)], "amount string, fee_amount string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        normalize.coerce_types(df).collect()


def records(spark, names):
    bad = normalize.normalize_receipts(feed(spark), names).quarantine
    return quarantine.quarantine_records(bad, F.lit("b1"), F.lit(NOW))


def test_records(spark, names):
    rows = records(spark, names).collect()
    assert {(r.tx_id, r.failure_count) for r in rows} == {("t3", 1), ("t4", 3), (None, 1)}
    assert len({r.quarantine_id for r in rows}) == len(rows)
    with pytest.raises(ValueError):
        quarantine.quarantine_records(spark.createDataFrame([(1,)], "tx_id int"), F.lit("b"), F.lit(NOW))


def test_records_are_unique_with_nulls_equal(spark, names):
    one = records(spark, names)
    assert quarantine.new_records(one.unionByName(one), None).count() == 6
    assert quarantine.new_records(one, one).isEmpty()


def test_requeue(spark, names):
    events = records(spark, names)
    chosen = events.where("tx_id in ('t3', 't4') or tx_id is null")
    done = quarantine.resolve(events, chosen, "requeued", "me", NOW, new_c_id=ID)
    assert [(r.tx_id, r.c_id) for r in done.requeued.collect()] == [("t3", ID)]
    # t4 is one row although three of its records were chosen, and still breaks three rules.
    assert done.still_bad.where("tx_id = 't4'").count() == 3
    assert done.audit.count() == 6


def test_requeue_with_all_corrections(spark, names):
    events = records(spark, names)
    done = quarantine.resolve(
        events, events.where("tx_id = 't4'"), "requeued", "me", NOW, new_amount=Decimal("7.5"), new_timestamp=NOW
    )
    # The currency cannot be corrected.
    assert done.requeued.isEmpty() and [r.failure_code for r in done.still_bad.collect()] == ["INVALID_BASE_CURRENCY"]


def test_corrections_one_at_a_time(spark, names, tmp_path):
    """A row with several faults is corrected record by record, and nothing is lost on the way."""
    store = TableStore(spark, str(tmp_path))
    store.append("raw.quarantine_event", records(spark, names))
    chosen = store.read("raw.quarantine_event").where("tx_id in ('t3', 't4') or tx_id is null")
    done = quarantine.resolve(store.read("raw.quarantine_event"), chosen, "requeued", "me", NOW, new_c_id=ID)
    counts = landing.apply_resolution(store, done)
    # t3 goes in, the record without a transaction stays, t4 comes back with its new company.
    assert counts == {"resolved": 4, "requeued": 1, "quarantined": 3}
    assert [r.tx_id for r in store.read("raw.transaction_event").collect()] == ["t3"]
    events, settled = store.read("raw.quarantine_event"), store.read("raw.quarantine_resolution")
    still = events.join(settled, "quarantine_id", "left_anti").collect()
    assert sorted((r.tx_id or "", r.c_id) for r in still if r.tx_id) == [("t4", ID)] * 3
    assert any(r.tx_id is None for r in still)
    # Running it again adds nothing.
    landing.apply_resolution(store, done)
    assert store.read("raw.quarantine_event").count() == len(still) + settled.count()


def test_resolve_arguments(spark, names):
    events = records(spark, names)
    with pytest.raises(ValueError):
        quarantine.resolve(events, events, "archived", "me", NOW)
    with pytest.raises(ValueError):
        quarantine.resolve(events, events, "requeued", "me", NOW)
    deleted = quarantine.resolve(events, events, "deleted", "me", NOW)
    assert deleted.requeued.isEmpty() and deleted.audit.count() == 6


def test_pages_and_cursor_agree(spark):
    rows = [(f"q{i:03d}", "c1" if i % 2 else None, "X", datetime(2026, 1, 1 + i % 5)) for i in range(57)]
    log = spark.createDataFrame(rows, "quarantine_id string, c_id string, failure_code string, ingestion_timestamp timestamp")
    companies = spark.createDataFrame([("c1", "One")], "c_id string, c_name string")
    order = sorted(rows, key=lambda r: (-r[3].timestamp(), r[0]))
    seen, last = [], None
    for page in range(1, 7):
        plain = quarantine.rows_page(log, companies, page, 10).collect()
        ids = [r.quarantine_id for r in sorted(plain, key=lambda r: (-r.ingestion_timestamp.timestamp(), r.quarantine_id))]
        assert all(r.total == 57 and (r.c_name == "One") == (r.c_id == "c1") for r in plain)
        cursor = quarantine.rows_page(log, companies, 1, 10, after=last).collect()
        assert {r.quarantine_id for r in cursor} == set(ids)
        seen += ids
        last = (order[len(seen) - 1][3], order[len(seen) - 1][0])
    assert seen == [r[0] for r in order]
    with pytest.raises(ValueError):
        quarantine.rows_page(log, companies, page_size=101)
    with pytest.raises(ValueError):
        quarantine.rows_page(log, companies, source="elsewhere")


def test_health_of_nothing(spark):
    events = spark.createDataFrame([], "ingestion_timestamp timestamp")
    row = quarantine.health(events, events, NOW).first()
    assert (row.total_raw, float(row.pass_rate), row.latest_ingestion) == (0, 100.0, None)


def test_rate_bounds_reject_whole_polls(spark):
    rows = [("EUR", 1.1, 1), ("JPY", 150.0, 1), ("EUR", 2.0, 2), ("JPY", 49.0, 2), ("XYZ", 1e6, 3)]
    df = spark.createDataFrame(rows, "base_cncy string, rate double, poll int")
    kept = quality.validate_rate_bounds(df, "poll")
    assert sorted(r.poll for r in kept.collect()) == [1, 1, 3]
