"""The time dimension's key is the timestamp itself, in microseconds since 1970.

A fact row's time attributes are therefore functions of its own `time_id`. Resolving them
needs no join with the time dimension, which holds one row per distinct event time and so
grows with the facts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def time_id(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def t_stamp(key: Column) -> Column:
    return F.timestamp_micros(key)


def day_of(key: Column) -> Column:
    """Midnight of the key's day, as a timestamp."""
    return F.timestamp_micros(day_key(key))


def day_key(key: Column) -> Column:
    """`time_id` of the key's midnight, by integer arithmetic."""
    return key - F.pmod(key, F.lit(MICROS_PER_DAY))


def minute_of(key: Column) -> Column:
    return F.timestamp_micros(key - F.pmod(key, F.lit(60_000_000)))


def fisc_quarter(ts: Column) -> Column:
    return F.quarter(ts).cast("smallint")


def day_of_week(ts: Column) -> Column:
    """0 is Monday, 6 is Sunday."""
    return F.weekday(ts).cast("smallint")


def iso_text(ts: Column) -> Column:
    """A timestamp as ISO text, with a fraction only if it has one."""
    plain = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000))
    return F.when(fraction == 0, plain).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


_RATE_ROOM = 10**15


def newest_rate(ts: Column, rate: Column) -> Column:
    """Aggregate of the latest time and, of equal times, the greatest rate, as one number.

    A number, unlike a struct, is aggregated by hash, without sorting all ticks.
    """
    since = F.unix_micros(ts.cast("timestamp")).cast("decimal(20,0)") + F.lit(1 << 62).cast("decimal(20,0)")
    digits = (rate.cast("decimal(14,7)") * F.lit(10**7)).cast("decimal(16,0)") + F.lit(10**14).cast("decimal(16,0)")
    return F.max((since * F.lit(_RATE_ROOM).cast("decimal(16,0)") + digits).cast("decimal(38,0)"))


def newest_parts(newest: str) -> tuple[Column, Column]:
    """The time and the rate that `newest_rate` found."""
    since = F.expr(f"{newest} div {_RATE_ROOM}bd") - F.lit(1 << 62)
    digits = F.expr(f"cast({newest} % {_RATE_ROOM}bd as bigint)") - F.lit(10**14)
    return F.timestamp_micros(since), (digits.cast("decimal(16,0)") / F.lit(10**7).cast("decimal(8,0)")).cast("decimal(14,7)")
