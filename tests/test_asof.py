import random
from datetime import datetime, timedelta

import pytest


from tallybook.operators import asof

START = datetime(2024, 1, 1)


def tables(spark, seed, n_left=300, n_right=120, span=6 * 3600, dup=False):
    rnd = random.Random(seed)
    pairs = [("EUR", "USD"), ("EUR", "USD"), ("EUR", "USD"), ("JPY", "USD"), ("GBP", None)]
    right, seen = [], set()
    while len(right) < n_right:
        base, quote = rnd.choice(pairs)
        at = START + timedelta(seconds=rnd.randrange(span))
        if dup or (base, quote, at) not in seen:
            seen.add((base, quote, at))
            right.append((base, quote, at, float(rnd.randrange(1000))))
    left = []
    for i in range(n_left):
        base, quote = rnd.choice(pairs)
        # A third of all rows share one pair and one second.
        at = START + timedelta(seconds=span // 2 if i % 3 == 0 else rnd.randrange(-600, span + 7200))
        if i % 3 == 0:
            base, quote = "EUR", "USD"
        left.append((i, base, quote, None if i % 50 == 1 else at))
    return left, right


def brute(left, right, strict=False):
    out = {}
    for i, base, quote, at in left:
        best = None
        if None not in (base, quote, at):
            for b, q, t, rate in right:
                if (b, q) == (base, quote) and (t < at or (t == at and not strict)):
                    best = max(best or (t, rate), (t, rate))
        out[i] = best or (None, None)
    return out


def frames(spark, left, right):
    return (
        spark.createDataFrame(left, "id int, base_cncy string, quote_cncy string, tx_timestamp timestamp"),
        spark.createDataFrame(right, "base_cncy string, quote_cncy string, fx_timestamp timestamp, rate double"),
    )


@pytest.mark.parametrize(
    "tuning",
    [{}, {"max_ticks": 3}, {"max_left": 7}, {"max_ticks": 2, "max_left": 4, "period_seconds": 86_400}],
    ids=["defaults", "sliced", "salted", "both"],
)
def test_equals_brute_force(spark, tuning):
    left, right = tables(spark, seed=len(tuning))
    tx, fx = frames(spark, left, right)
    got = {r.id: (r.fx_timestamp, r.rate) for r in asof.match_fx_rates(tx, fx, **tuning).collect()}
    assert got == brute(left, right)


def test_duplicate_ticks_take_the_greatest(spark):
    left, right = tables(spark, seed=9, n_right=60, span=40, dup=True)
    tx, fx = frames(spark, left, right)
    got = {r.id: (r.fx_timestamp, r.rate) for r in asof.match_fx_rates(tx, fx, max_ticks=2, max_left=9).collect()}
    assert got == brute(left, right)


def test_strictly_earlier(spark):
    left, right = tables(spark, seed=4, span=300)
    tx, fx = frames(spark, left, right)
    joined = asof.asof_join(tx, fx, ["base_cncy", "quote_cncy"], "tx_timestamp", "fx_timestamp", ["rate"], allow_equal=False, max_ticks=5)
    assert {r.id: (r.fx_timestamp, r.rate) for r in joined.collect()} == brute(left, right, strict=True)


def test_inner_drops_unmatched_and_equals_lateral(spark):
    left, right = tables(spark, seed=5)
    tx, fx = frames(spark, left, right)
    got = {(r.id, r.rate) for r in asof.match_fx_rates(tx, fx, how="inner", max_left=10).collect()}
    lateral = spark.sql(
        """select t.id, m.rate from {tx} t join lateral (
             select rate from {fx} f where f.base_cncy = t.base_cncy and f.quote_cncy = t.quote_cncy
               and f.fx_timestamp <= t.tx_timestamp order by f.fx_timestamp desc limit 1) m""",
        tx=tx, fx=fx,
    )
    assert got == {(r.id, r.rate) for r in lateral.collect()}


def test_an_hour_in_one_second(spark):
    """A burst of ticks and transactions: slots and salts stay small, and nothing changes."""
    rnd = random.Random(8)
    second = START + timedelta(minutes=30)
    right = [("EUR", "USD", second + timedelta(microseconds=rnd.randrange(1000)), float(i)) for i in range(900)]
    right += [("EUR", "USD", second, float(i)) for i in range(300)] + [("EUR", "USD", START - timedelta(days=3), 0.5)]
    left = [(i, "EUR", "USD", second + timedelta(microseconds=rnd.randrange(1000) if i % 2 else 500)) for i in range(800)]
    left += [(1000 + i, "EUR", "USD", START + timedelta(minutes=i)) for i in range(20)]
    tx, fx = frames(spark, left, right)
    tuning = {"max_ticks": 20, "max_left": 30}
    sides = asof.prepare(tx.repartition(3), fx, ["base_cncy", "quote_cncy"], "tx_timestamp", "fx_timestamp", ["rate"], **tuning)
    slot = ["__slot", "__salt"]
    ticks = sides.supply.where("__us > 0").groupBy(*slot).count()
    rows = sides.demand.groupBy(*slot).count()
    assert max(r["count"] for r in ticks.collect()) <= 20
    sizes = [r["count"] for r in rows.collect()]
    # Salts are dealt by hash, so about evenly.
    assert max(sizes) <= 60 and sum(sizes) == len(left)
    # Of the ticks of one time only the last is left, and copies go to crowded slots alone.
    times = len({t for _, _, t, _ in right if t >= START})
    assert sides.supply.where("__us > 0 and __salt = 0").count() <= times + 1
    assert sides.supply.count() <= times + 1 + len(sizes) * 21
    got = {r.id: (r.fx_timestamp, r.rate) for r in asof.match_fx_rates(tx, fx, **tuning).collect()}
    assert got == brute(left, right)


def test_copies_of_one_row_are_all_kept(spark):
    at = START + timedelta(hours=1)
    left = [(1, "EUR", "USD", at)] * 200
    tx, fx = frames(spark, left, [("EUR", "USD", START, 1.5)])
    joined = asof.match_fx_rates(tx.repartition(6), fx, max_left=10)
    assert joined.where("rate = 1.5").count() == 200


def test_times_before_1970(spark):
    old = datetime(1969, 12, 31, 23, 59, 50)
    tx, fx = frames(spark, [(1, "EUR", "USD", old)], [("EUR", "USD", old - timedelta(days=400), 2.0)])
    assert asof.match_fx_rates(tx, fx).first().rate == 2.0


def test_empty_sides(spark):
    left, right = tables(spark, seed=1, n_left=20, n_right=5)
    tx, fx = frames(spark, left, right)
    assert asof.match_fx_rates(tx, fx.limit(0)).where("rate is null").count() == 20
    assert asof.match_fx_rates(tx.limit(0), fx).count() == 0


def test_no_row_pairs_in_the_plan(spark):
    left, right = tables(spark, seed=2)
    tx, fx = frames(spark, left, right)
    plan = asof.match_fx_rates(tx, fx)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_unknown_kind(spark):
    left, right = tables(spark, seed=2, n_left=1, n_right=1)
    with pytest.raises(ValueError):
        asof.match_fx_rates(*frames(spark, left, right), how="outer")

