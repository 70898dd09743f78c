"""One entry for FX rates from either source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook import refdata
from tallybook.functions import timekeys

COLUMNS = ["fx_timestamp", "base_cncy", "quote_cncy", "rate"]


def get_fx_rates(
    source: str, ticks: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """Rates from `ticks` in one shape: `live` gives the newest tick per pair, `synthetic`
    the whole series inside [start, end]."""
    if source not in refdata.FX_SOURCES:
        raise ValueError(f"Unknown FX source {source!r}. Valid options: {sorted(refdata.FX_SOURCES)}")
    if source == "synthetic":
        if start is None or end is None:
            raise ValueError("start and end are required for the synthetic source")
        return ticks.where(F.col("fx_timestamp").between(F.lit(start), F.lit(end))).select(*COLUMNS)
    newest = timekeys.newest_rate(F.col("fx_timestamp"), F.col("rate")).alias("t")
    at, rate = timekeys.newest_parts("t")
    return ticks.groupBy("base_cncy", "quote_cncy").agg(newest).select(
        at.alias("fx_timestamp"), "base_cncy", "quote_cncy", rate.alias("rate")
    )
