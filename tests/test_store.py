from datetime import datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.operators import industry, normalize
from tallybook.plans import promote
from tallybook.sources import dimensions, fx_feed, landing, versions
from tallybook.sources.tables import TableStore
from tallybook.streaming import batches, metrics, ticks

NOW = datetime(2026, 1, 5)
FEED = "tx_id string, c_id string, base_cncy string, quote_cncy string, amount string, fee_amount string, tx_timestamp string"


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "store"))


def fx(spark, rows):
    return spark.createDataFrame(rows, "base_cncy string, quote_cncy string, fx_timestamp timestamp, rate double")


def tick_rows(n=10):
    return [("EUR", "USD", datetime(2026, 1, 1, 9) + timedelta(minutes=i), 1.0 + i / 100) for i in range(n)]


def feed(spark, ids):
    names = [c[1] for c in refdata.COMPANIES]
    rows = [
        (f"t{i}", names[i % 12], "EUR", "USD" if i % 2 else None, str(10 + i), "1%", f"2026-01-0{1 + i % 4} 10:00:00")
        for i in ids
    ]
    return spark.createDataFrame(rows, FEED)


def test_dimensions_are_seeded_once(store):
    assert all(dimensions.seed_dimensions(store).values())
    assert not any(dimensions.seed_dimensions(store).values())
    counts = [store.read(f"analytics.d_{n}").count() for n in ("currency", "industry", "company", "expense_category")]
    assert counts == [14, 4, 12, 6]


def test_raw_tables_are_append_only(store, spark):
    landing.append_fx_rates(store, fx(spark, tick_rows()), NOW)
    with pytest.raises(PermissionError, match="append-only"):
        store.replace("raw.fx_rate", store.read("raw.fx_rate"))
    with pytest.raises(KeyError):
        store.path("raw.unknown")


def test_loading_twice_adds_nothing(store, spark):
    rows = fx(spark, tick_rows() + tick_rows(3))
    assert landing.append_fx_rates(store, rows, NOW) == landing.Loaded(13, 10)
    assert landing.append_fx_rates(store, rows, NOW) == landing.Loaded(13, 0)
    later = fx(spark, [("EUR", "USD", datetime(2026, 1, 2), 2.0)])
    assert landing.append_fx_rates(store, later, NOW).inserted == 1
    assert store.read("raw.fx_rate").select("fx_rate_id").distinct().count() == 11
    assert store.read("raw.fx_rate", since=datetime(2026, 1, 2).date()).count() == 1
    assert {r.source for r in store.read("raw.fx_rate").collect()} == {"api"}


def test_missing_columns(store, spark):
    with pytest.raises(ValueError, match="missing required columns"):
        landing.append_transactions(store, spark.createDataFrame([("t",)], "tx_id string"))
    with pytest.raises(ValueError, match="missing required columns"):
        landing.append_expenses(store, spark.createDataFrame([("t",)], "expense_id string"))


def test_nan_becomes_null(store, spark):
    schema = "tx_id string, c_id string, base_cncy string, quote_cncy string, amount double, fee_amount double, tx_timestamp timestamp"
    rows = [("t", "c", "USD", None, 1.5, float("nan"), NOW)]
    landing.append_transactions(store, spark.createDataFrame(rows, schema), "b", NOW)
    row = store.read("raw.transaction_event").first()
    assert (row.amount, row.fee_amount, row.batch_id) == (Decimal("1.5000"), None, "b")


def test_logs(store):
    args = ("b1", NOW, NOW, 10, 8, 2, "medium")
    assert landing.log_batch(store, *args) and not landing.log_batch(store, *args)
    assert not landing.log_batch(store, "b2", NOW, NOW, "many", 8, 2, "medium")  # bad value: logged, not raised
    run = {"batch_id": "b1", "noise_level": "low", "n_transactions": 5, "fx_source": "live", "duration_seconds": Decimal("1.25")}
    assert landing.log_pipeline_run(store, run) and not landing.log_pipeline_run(store, run)
    with pytest.raises(ValueError):
        landing.log_pipeline_run(store, {**run, "noise_level": "extreme"})
    with pytest.raises(ValueError):
        landing.log_pipeline_run(store, {"noise_level": "low"})


def test_rule_errors_are_violations(spark):
    df = spark.createDataFrame([(1, 0, "x"), (2, 1, "7"), (3, 5, "8"), (4, None, "9")], "id int, q int, t string")
    rules = [
        normalize.Rule("RATIO", "10/q above 5", "10 / q > 5"), normalize.Rule("NUMBER", "t is no number", "cast(t as int) < 0"),
        normalize.Rule("ELEMENT", "no such element", "array(1, 2)[q] < 1"), normalize.Rule("TEXT", "compared with a number", "t > 100"),
    ]
    clean, bad = normalize.split_quarantine(df, rules)
    found = {(r.id, r.failure_code) for r in bad.collect()}
    assert found == {
        (1, "RATIO"), (1, "NUMBER"), (1, "TEXT"), (2, "RATIO"), (3, "ELEMENT"), (4, "RATIO"), (4, "ELEMENT"),
    }
    assert clean.count() == 0 and clean.columns == df.columns
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert normalize.split_quarantine(df, [])[1].count() == 0


def test_register_companies(spark):
    rows = [
        (" Zeta ", "Fintech", "Peru", "USD", 0.05), ("Acme", "Retail", "Italy", "EUR", 1.0), ("", "Retail", "Italy", "EUR", 0.5),
        ("B", "Mining", "Italy", "EUR", 0.5), ("C", "Retail", "Italy", "XXX", 0.5), ("D", "Retail", "Italy", "EUR", 0.001),
    ]
    requests = spark.createDataFrame(rows, "name string, industry string, hq_country string, default_cncy string, weight double")
    keys = spark.createDataFrame([(c[0],) for c in refdata.COMPANIES], "company_key string")
    accepted, rejected = dimensions.register_companies(requests, keys)
    got = {r.c_name: r for r in accepted.collect()}
    assert {n: r.company_key for n, r in got.items()} == {"Acme": "COMP013", "Zeta": "COMP014"}
    assert got["Acme"].c_id == refdata.company_id("COMP013") and got["Acme"].industry_id == refdata.industry_id("Retail")
    assert rejected.count() == 4 and rejected.where("reason is null").isEmpty()


def test_fx_sources(spark):
    rates = fx(spark, tick_rows())
    assert fx_feed.get_fx_rates("live", rates).count() == 1
    window = fx_feed.get_fx_rates("synthetic", rates, datetime(2026, 1, 1, 9, 2), datetime(2026, 1, 1, 9, 4))
    assert window.count() == 3
    with pytest.raises(ValueError):
        fx_feed.get_fx_rates("synthetic", rates)
    with pytest.raises(ValueError):
        fx_feed.get_fx_rates("guess", rates)


def test_batch_and_transform(store, spark, tmp_path):
    bad = spark.createDataFrame([("bad", None, "EUR", None, "-1", None, "never")], FEED)
    expenses = spark.createDataFrame(
        [("e1", refdata.company_id("COMP001"), "USD", datetime(2026, 1, 1, 8), 3.0, refdata.category_id("Rent"))],
        "expense_id string, c_id string, cncy string, expense_timestamp timestamp, amount double, category_id string",
    )
    counts = promote.run_batch(
        store, feed(spark, range(24)).unionByName(bad), fx(spark, tick_rows()), "b1", NOW, NOW, expenses=expenses
    )
    assert (counts["transactions"], counts["quarantine"], counts["fx_rates"]) == (24, 3, 10)
    assert counts["conversions"] == 12 and counts["expenses"] == 1 and counts["raw_expenses"] == 1
    log = store.read("raw.batch_log").first()
    assert (log.rows_received, log.rows_loaded, log.rows_quarantined) == (25, 24, 3)
    fact = store.read("analytics.f_transaction").where("tx_id = 't0'").first()
    assert (fact.amount, fact.cncy) == (Decimal("9.9000"), "EUR")
    conversion = store.read("analytics.f_conversion").join(store.read("analytics.f_fx_rate"), "fx_id").first()
    assert conversion.rate == Decimal("1.0900000")
    # A second run finds nothing left to do.
    again = promote.run_transform(store, expenses)
    assert set(again.values()) == {0}
    # A new day is added next to the stored ones, in windows.
    more = feed(spark, range(24, 28)).withColumn("tx_timestamp", F.lit("2026-01-09 10:00:00"))
    promote.run_batch(store, more, fx(spark, tick_rows(2)), "b2", NOW, NOW, transform=False)
    third = promote.run_transform(store, window_days=3)
    assert third["transactions"] == 4 and third["industry_rows"] == store.read("analytics.f_industry").where(
        F.to_date(F.timestamp_micros("time_id")) == F.lit("2026-01-09")
    ).count()
    # Growth of the new day is against each industry's last stored day.
    rows = store.read("analytics.f_industry")
    assert rows.groupBy("industry_id").agg(F.count_if(F.col("revenue_growth_rate").isNull()).alias("n")).where("n > 1").isEmpty()
    before = rows.count()
    store.replace("analytics.f_industry", industry.backfill_growth_clamped(rows))
    assert store.read("analytics.f_industry").count() == before
    landing.write_report_csv(store.read("raw.quarantine_event"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


def reads_of(store, monkeypatch):
    """All reads of the store from here on: table, and the executed plan of the read alone."""
    seen, plain = [], TableStore.read

    def read(self, name, **kwargs):
        df = plain(self, name, **kwargs)
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return df

    monkeypatch.setattr(TableStore, "read", read)
    return seen


def test_a_second_run_reads_only_what_it_needs(store, spark, monkeypatch):
    promote.run_batch(store, feed(spark, range(24)), fx(spark, tick_rows()), "b1", NOW, NOW)
    rows = feed(spark, range(24, 30)).withColumn("tx_timestamp", F.lit("2026-01-09 10:00:00"))
    promote.run_batch(store, rows, fx(spark, tick_rows(2)), "b2", NOW, NOW, transform=False)
    seen = reads_of(store, monkeypatch)
    assert promote.run_transform(store)["transactions"] == 6
    names = {name for name, _ in seen}
    assert "raw.transaction_event" not in names and "raw.expense_event" not in names
    for name, plan in seen:
        if name.startswith("raw.") or name in ("analytics.d_time", "analytics.f_transaction", "analytics.f_conversion", "analytics.f_expense", "analytics.f_fx_rate"):
            # Where nothing was ever written, there are no partitions to filter.
            assert "PartitionFilters: []" not in plan or "PushedFilters: [IsNotNull(p_" in plan or "FileScan" not in plan, (name, plan)
    del seen[:]
    assert set(promote.run_transform(store).values()) == {0} and not seen


def test_waiting_conversions_are_carried(store, spark):
    """Transactions before their first tick wait, over runs, until an earlier tick arrives."""
    late = feed(spark, [1, 3]).withColumn("tx_timestamp", F.lit("2026-01-01 08:00:00"))
    promote.run_batch(store, late.unionByName(feed(spark, [5])), fx(spark, tick_rows()), "b1", NOW, NOW)
    assert {r.tx_id for r in store.read("state.waiting_conversion").collect()} == {"t1", "t3"}
    promote.run_batch(store, feed(spark, [7]), fx(spark, tick_rows(3)), "b2", NOW, NOW)
    assert store.read("analytics.f_conversion").count() == 2
    early = fx(spark, [("EUR", "USD", datetime(2025, 12, 30), 3.0), ("EUR", "USD", datetime(2025, 12, 31, 23), 4.0)])
    landing.append_fx_rates(store, early, NOW)
    assert promote.run_transform(store)["conversions"] == 2
    assert store.read("state.waiting_conversion").count() == 0
    rates = store.read("analytics.f_conversion").join(store.read("analytics.f_fx_rate"), "fx_id")
    assert {r.tx_id: float(r.rate) for r in rates.collect()} == {"t1": 4.0, "t3": 4.0, "t5": 1.09, "t7": 1.09}


def test_a_run_that_dies_is_replayed(store, spark, monkeypatch):
    """Whatever step fails, the next run completes it and nothing is there twice."""
    landing.append_fx_rates(store, fx(spark, tick_rows()), NOW)
    dimensions.seed_dimensions(store)
    names = dimensions.known_company_names(store)
    landing.append_transactions(store, normalize.normalize_receipts(feed(spark, range(12)), names).clean, "b", NOW)
    for table in ("analytics.d_time", "analytics.f_conversion", "state.waiting_conversion", "analytics.f_industry"):
        with monkeypatch.context() as patch:
            for method in ("append", "replace"):
                plain = getattr(TableStore, method)

                def failing(self, name, df, plain=plain):
                    plain(self, name, df)
                    if name == table:
                        raise RuntimeError("lost")

                patch.setattr(TableStore, method, failing)
            with pytest.raises(Exception, match="lost"):
                promote.run_transform(store)
    promote.run_transform(store)
    for table, key in (("f_transaction", "tx_id"), ("f_conversion", "tx_id"), ("d_time", "time_id"), ("f_fx_rate", "fx_id")):
        rows = store.read(f"analytics.{table}")
        assert rows.count() == rows.select(key).distinct().count() > 0
    assert store.read("analytics.f_transaction").count() == 12 and store.read("analytics.f_conversion").count() == 6
    assert store.read("analytics.f_industry").groupBy("industry_id", "time_id").count().where("count > 1").isEmpty()


def test_key_index_is_pruned_and_repaired(store, spark, monkeypatch):
    schema = "tx_id string, c_id string, base_cncy string, quote_cncy string, amount double, fee_amount double, tx_timestamp timestamp"
    rows = lambda ids: spark.createDataFrame([(f"t{i}", "c", "USD", None, 1.0, 0.0, NOW) for i in ids], schema)
    evaluated = spark.sparkContext.accumulator(0)
    counted = rows(range(50)).rdd.map(lambda r: (evaluated.add(1), r)[1])
    assert landing.append_transactions(store, spark.createDataFrame(counted, schema), "b", NOW) == landing.Loaded(50, 50)
    assert evaluated.value == 50
    seen = reads_of(store, monkeypatch)
    few = rows([3, 3, 99])
    buckets = store.buckets_of("raw.transaction_event", few)
    plan = store.known_keys("raw.transaction_event", buckets)._jdf.queryExecution().executedPlan().toString()
    assert len(buckets) <= 2 and "PartitionFilters: []" not in plan and f"p_bucket#" in plan
    assert landing.append_transactions(store, few, "c", NOW) == landing.Loaded(3, 1)
    assert not [name for name, _ in seen if name == "raw.transaction_event"]
    # The writer dies after the rows and before their keys.
    with monkeypatch.context() as patch:
        patch.setattr(TableStore, "_add_keys", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            landing.append_transactions(store, rows([200, 201]), "d", NOW)
    assert landing.append_transactions(store, rows([200, 201, 202]), "d", NOW) == landing.Loaded(3, 1)
    assert landing.append_transactions(store, rows([None]), "e", NOW).inserted == 1
    store.compact_keys("raw.transaction_event")
    assert landing.append_transactions(store, rows([0, 99, 200, None, 300]), "f", NOW) == landing.Loaded(5, 1)
    stored = store.read("raw.transaction_event")
    assert stored.count() == stored.select("tx_id").distinct().count() == 56


def test_replace_publishes_whole_versions(store, spark, monkeypatch):
    name, schema = "analytics.d_currency", "cncy_code string, cncy_name string"
    frame = lambda n: spark.createDataFrame([(f"c{i}", str(n)) for i in range(n)], schema)
    store.append(name, frame(3))
    old = store.read(name)
    store.replace(name, frame(5))
    new = store.read(name)
    assert (old.count(), new.count()) == (3, 5)  # a plan made before sees its own version
    with monkeypatch.context() as patch:
        patch.setattr(versions, "write_text", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.replace(name, frame(9))
    assert store.read(name).count() == 5
    store.replace(name, store.read(name).where("cncy_code <> 'c0'"))
    store.append(name, frame(1))
    assert store.read(name).count() == 5 and new.count() == 5
    versions.clean(spark, store.path(name), retain_seconds=0)
    assert store.read(name).count() == 5
    assert len(versions.names(spark, f"{store.path(name)}/_versions")) <= 2


def test_growth_is_filled_in_place(store, spark, monkeypatch):
    """Only the partitions with changed rows are written anew; growth is carried over their edges."""
    day = lambda m, d: int(datetime(2026, m, d, tzinfo=timezone.utc).timestamp() * 1_000_000)
    rows = [("i", day(m, d), 100.0 * k, None) for k, (m, d) in enumerate([(1, 30), (1, 31), (2, 1), (2, 2), (3, 1)], 1)]
    rows[1] = (*rows[1][:3], 7.0)
    frame = spark.createDataFrame(rows, "industry_id string, time_id bigint, total_revenue double, revenue_growth_rate double")
    store.append("analytics.f_industry", frame)
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(store.path("analytics.f_industry")).rglob("*.parquet")}
    before = files()
    changed = promote.backfill_growth(store, [datetime(2026, 2, 1).date(), datetime(2026, 2, 2).date()])
    assert changed == {datetime(2026, 2, 1).date()}
    kept = {p for p in before if "p_day=2026-02" not in str(p)}
    assert kept and all(files().get(p) == before[p] for p in kept)
    growth = [float(r.revenue_growth_rate) if r.revenue_growth_rate is not None else None for r in store.read("analytics.f_industry").orderBy("time_id").collect()]
    assert growth == [None, 7.0, 50.0, 33.3333, None]
    assert promote.backfill_growth(store) == {datetime(2026, 3, 1).date()}
    assert promote.backfill_growth(store) == set()
    assert promote.backfill_growth(store, clamped=True) == {datetime(2026, 1, 1).date()}
    assert store.read("analytics.f_industry").count() == 5
    # The writer dies with a partition gone: the next writer puts it back in place.
    more = frame.where(F.col("time_id") == day(2, 1)).withColumn("revenue_growth_rate", F.lit(1.5))
    with monkeypatch.context() as patch:
        def lost(self, name, staged):
            versions.remove(self.spark, f"{self.path(name)}/p_day=2026-02-01")
            raise RuntimeError("lost")

        patch.setattr(TableStore, "_overwrite", lost)
        with pytest.raises(RuntimeError):
            store.merge("analytics.f_industry", more)
    store.append("analytics.f_industry", frame.where(F.col("time_id") == day(3, 1)).withColumn("industry_id", F.lit("j")))
    stored = {(r.industry_id, r.time_id): r.revenue_growth_rate for r in store.read("analytics.f_industry").collect()}
    assert len(stored) == 6 and float(stored["i", day(2, 1)]) == 1.5 and float(stored["i", day(2, 2)]) == 33.3333


def test_windows_are_committed_one_by_one(store, spark, monkeypatch):
    at = [datetime(2025, 1, 1), datetime(2025, 2, 20), datetime(2025, 3, 5), datetime(2026, 1, 1)]
    rows = spark.createDataFrame([(f"t{i}", "c", "USD", 5.0, t) for i, t in enumerate([*at, None])], "tx_id string, c_id string, base_cncy string, amount double, tx_timestamp timestamp")
    rows = rows.withColumn("fee_amount", F.lit(None).cast("double"))
    appended, plain = [], TableStore.append
    monkeypatch.setattr(TableStore, "append", lambda self, name, df: (appended.append(name), plain(self, name, df))[1])
    assert promote.promote_windows(store, rows, 60) == 4
    assert appended == ["analytics.f_transaction"] * 3
    assert promote.promote_windows(store, rows, 30) == 0
    assert promote.promote_windows(store, rows.limit(0)) == 0


def test_registering_in_batches(store, spark):
    schema = "name string, industry string, hq_country string, default_cncy string, weight double"
    batch = lambda names: spark.createDataFrame([(n, "Retail", "Italy", "EUR", 0.5) for n in names], schema)
    first, _ = dimensions.register(store, batch(["Zeta", "Acme", " "]))
    second, refused = dimensions.register(store, batch([f"N{i:04}" for i in range(1200)] + ["Acme"]))
    keys = [r.company_key for r in store.read("state.company_key").collect()]
    assert len(keys) == len(set(keys)) == 12 + 2 + 1201 and "COMP1000" in keys
    assert {r.c_name: r.company_key for r in first.collect()} == {"Acme": "COMP013", "Zeta": "COMP014"}
    assert second.where("c_name = 'Acme'").first().company_key == "COMP015" and refused.count() == 0
    assert store.read("analytics.d_company").count() == 12 + 2 + 1201
    names = {r.name: r.id for r in dimensions.known_company_names(store).where("name in ('ZETA', 'N0007')").collect()}
    assert names["ZETA"] == refdata.company_id("COMP014") and len(names) == 2


def test_late_rows_of_a_stored_day_are_not_aggregated_again(store, spark):
    promote.run_batch(store, feed(spark, range(12)), fx(spark, tick_rows()), "b1", NOW, NOW)
    before = {tuple(r) for r in store.read("analytics.f_industry").collect()}
    promote.run_batch(store, feed(spark, range(12, 24)), fx(spark, tick_rows()), "b2", NOW, NOW)
    assert {tuple(r) for r in store.read("analytics.f_industry").collect()} == before
    assert store.read("analytics.f_transaction").count() == 24


def test_wrong_rate_is_refused(store, spark):
    from tallybook.operators import quality

    cx = spark.createDataFrame([("cx", "fx", "t")], "cx_id string, fx_id string, tx_id string")
    tx = spark.createDataFrame([("t", "EUR")], "tx_id string, cncy string")
    rate = spark.createDataFrame([("fx", "JPY")], "fx_id string, base_cncy string")
    with pytest.raises(ValueError, match="currency mismatch"):
        quality.require_conversion_currency(cx, tx, rate)


# --- streaming -------------------------------------------------------------


def stream(spark, df, path):
    df.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def test_tick_stream(store, spark, tmp_path):
    rows = tick_rows() + tick_rows(2) + [("JPY", "USD", datetime(2026, 1, 1, 9, 5), 9999.0)]
    source, checkpoint, seen = str(tmp_path / "in"), str(tmp_path / "cp"), []
    log = metrics.IngestMetrics(spark, str(tmp_path / "metrics"), every=2)
    spark.streams.addListener(log)
    try:
        arrivals = stream(spark, fx(spark, rows), source)
        ticks.stream_fx_ticks(arrivals, store, checkpoint, on_batch=lambda e, n: seen.append(n)).awaitTermination()
        # The implausible JPY rate takes the EUR rate of its poll with it.
        assert store.read("raw.fx_rate").count() == 9
        # An older and a newer tick arrive: a restarted poller takes only the newer one.
        more = fx(spark, [("EUR", "USD", datetime(2026, 1, 1, 9, 5), 1.5), ("EUR", "USD", datetime(2026, 1, 1, 9, 30), 1.5)])
        arrivals = stream(spark, more, source)
        ticks.stream_fx_ticks(arrivals, store, checkpoint, skip_seen=True).awaitTermination()
        assert store.read("raw.fx_rate").count() == 10
        # A stream started from nothing replays all and adds only what was dropped as seen.
        ticks.stream_fx_ticks(arrivals, store, str(tmp_path / "cp2"), bounds={}).awaitTermination()
        assert store.read("raw.fx_rate").groupBy("base_cncy", "quote_cncy", "fx_timestamp").count().where("count > 1").isEmpty()
    finally:
        spark.streams.removeListener(log)
    assert sum(n.inserted for n in seen) == 9
    log.flush()
    stored = metrics.read_metrics(spark, str(tmp_path / "metrics"))
    entries = stored.collect()
    assert any(e.event == "batch" and e.input_rows == len(rows) and e.success for e in entries)
    assert {e.event for e in entries} == {"started", "batch", "stopped"} and all(e.p_day == e["at"].date() for e in entries)
    days = metrics.ingest_summary(stored).collect()
    assert sum(d.input_rows for d in days) >= len(rows) + 2 and sum(d.failed for d in days) == 0
    assert metrics.read_metrics(spark, str(tmp_path / "no metrics")).count() == 0


def test_polls_are_judged_whole(store, spark, tmp_path):
    at = lambda m: datetime(2026, 1, 1, 9, m)
    schema = "source string, poll_id string, polled_at timestamp, n_quotes int, base_cncy string, quote_cncy string, rate double"
    poll = lambda source, m, n, rates: [(source, f"{source}{m}", at(m), n, base, "USD", rate) for base, rate in rates.items()]
    good, bad = {"EUR": 1.1, "GBP": 1.3}, {"EUR": 1.1, "JPY": 9999.0}
    source, checkpoint, added = str(tmp_path / "polls"), str(tmp_path / "cp"), []
    batches_of = [
        poll("a", 1, 2, good) + poll("a", 2, 2, bad) + poll("a", 3, 2, {"EUR": 1.2}) + poll("a", 4, 2, good) + poll("b", 1, 1, {"CAD": 1.4}),
        # The rest of a split poll, a replay, a late poll, another source's old time, half a bad poll.
        poll("a", 3, 2, {"GBP": 1.2}) + poll("a", 1, 2, good) + poll("a", 0, 1, {"EUR": 1.0}) + poll("b", 2, 1, {"CAD": 1.5}) + poll("a", 5, 2, {"EUR": 1.1}),
        poll("a", 5, 2, {"JPY": 9999.0}) + poll("a", 6, 3, good),
        poll("a", 30, 1, {"EUR": 1.6}),
    ]
    for rows in batches_of:
        arrivals = stream(spark, spark.createDataFrame(rows, schema), source)
        ticks.stream_polls(arrivals, store, checkpoint, on_batch=lambda e, n: added.append(n.inserted)).awaitTermination()
    assert added == [5, 3, 0, 1]
    stored = {(r.base_cncy, r.fx_timestamp.minute) for r in store.read("raw.fx_rate").collect()}
    assert stored == {("EUR", 1), ("GBP", 1), ("EUR", 4), ("GBP", 4), ("CAD", 1), ("EUR", 3), ("GBP", 3), ("CAD", 2), ("EUR", 30)}
    marks = {r.source: r.mark for r in store.read("state.poll_mark").collect()}
    assert marks == {"a": at(30), "b": at(2)} and store.read("state.poll_pending").count() == 0
    # From a lost checkpoint everything is seen.
    ticks.stream_polls(arrivals, store, str(tmp_path / "cp2")).awaitTermination()
    assert store.read("raw.fx_rate").count() == 9


def test_quotes(spark):
    df = spark.createDataFrame([("EUR/USD", "1.123456789"), ("GBP/USD", "n/a"), ("JPY/USD", None)], "symbol string, rate string")
    df = df.unionByName(spark.createDataFrame([("EUR/JPY", "160.5")], df.schema))
    got = ticks.parse_quotes(df.withColumn("fx_timestamp", F.lit(NOW))).collect()
    assert [(r.base_cncy, r.quote_cncy, r.rate) for r in got] == [("EUR", "USD", Decimal("1.1234568"))]


def test_normalize_and_transform_streams(store, spark, tmp_path):
    dimensions.seed_dimensions(store)
    landing.append_fx_rates(store, fx(spark, tick_rows()), NOW)
    source, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    names = dimensions.known_company_names(store)
    for part in (range(10), range(10, 15)):
        arrivals = stream(spark, feed(spark, part), source)
        batches.stream_normalize(arrivals, names, store, cp, now=lambda: NOW).awaitTermination()
        batches.stream_transform(store, str(tmp_path / "cp_t")).awaitTermination()
    assert store.read("analytics.f_transaction").count() == 15
    assert store.read("analytics.f_conversion").count() == 7
    assert sorted(r.rows_received for r in store.read("raw.batch_log").collect()) == [5, 10]
    # Replaying from a lost checkpoint adds nothing.
    batches.stream_normalize(arrivals, names, store, str(tmp_path / "cp2"), now=lambda: NOW).awaitTermination()
    assert store.read("raw.transaction_event").count() == 15


def test_steps_read_tasks_that_fit(spark):
    from tallybook.session import TASK_BYTES, configure

    before = {key: spark.conf.get(key) for key in TASK_BYTES}
    try:
        for size, expected in (("128MB", 32 << 20), ("134217728b", 32 << 20), ("1m", "1m"), ("64k", "64k")):
            for key in TASK_BYTES:
                spark.conf.set(key, size)
            configure(spark)
            assert [spark.conf.get(key) for key in TASK_BYTES] == [str(expected)] * len(TASK_BYTES)
    finally:
        for key, size in before.items():
            spark.conf.set(key, size)


def test_first_batch_is_not_compared_or_copied(store, spark, monkeypatch):
    ticks_new = fx(spark, tick_rows())
    new = landing.joins.not_in(ticks_new, store.read("raw.fx_rate"), ["base_cncy", "quote_cncy"])
    assert "Join" not in new._jdf.queryExecution().optimizedPlan().toString()

    labels = []
    keep = landing.materialize
    monkeypatch.setattr(landing, "materialize", lambda df, label: labels.append(label) or keep(df, label))
    ddl = "expense_id string, c_id string, cncy string, expense_timestamp timestamp, amount decimal(18,4), category_id string"
    at = datetime(2026, 1, 1)
    rows = spark.createDataFrame([(k, "c", "USD", at, Decimal(1), "0") for k in ("a", "b", "b", None, None)], ddl)
    assert landing.append_expenses(store, rows, NOW) == landing.Loaded(5, 3)
    assert labels == ["batch"]
    assert landing.append_expenses(store, rows, NOW) == landing.Loaded(5, 0)
    assert store.read("raw.expense_event").count() == 3


def test_arrivals_are_staged_without_sorting(store, spark):
    landing.append_fx_rates(store, fx(spark, tick_rows()), NOW)
    seen = []

    def split(batch, epoch):
        parts = store.split_arrivals(batch, promote.SOURCES)
        files = {f for part in parts.values() for f in part.inputFiles()}
        seen.append(({n: part.count() for n, part in parts.items()}, [f for f in files if "table=" in f]))

    stream = store.arrivals(promote.SOURCES).writeStream.foreachBatch(split)
    stream.option("checkpointLocation", f"{store.root}/marks/x").trigger(availableNow=True).start().awaitTermination()
    assert seen == [({"raw.fx_rate": 10, "raw.transaction_event": 0, "raw.expense_event": 0}, [])]
