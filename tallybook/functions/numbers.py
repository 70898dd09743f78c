"""Exact decimal helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_avg(value: Column, digits: int) -> Column:
    """Average rounded half-up once: the built-in average of a decimal keeps four extra
    digits and would be rounded twice."""
    return F.round(F.sum(value) / F.count(value), digits)


def null_if_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def growth_rate(current: Column, prior: Column, out_of_range: str = "null") -> Column:
    """Percent change to four digits, with no value without a non-zero prior.

    `out_of_range` says what happens to a change of 1000 percent or more: `null` drops it,
    `clamp` limits it to +-999.9999, which is what the stored column can hold.
    """
    percent = F.round((current - prior) / null_if_zero(prior) * 100, 4)
    if out_of_range == "clamp":
        limit = F.lit("999.9999").cast("decimal(7,4)")
        percent = F.when(percent.isNotNull(), F.least(limit, F.greatest(-limit, percent)))
    elif out_of_range == "null":
        percent = F.when(F.abs(percent) < 1000, percent)
    else:
        raise ValueError(f"out_of_range must be 'null' or 'clamp', not {out_of_range!r}")
    return percent.cast("decimal(7,4)")
