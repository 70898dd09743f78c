"""Streaming forms of normalization and of the star-schema transform."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tallybook import refdata
from tallybook.functions import parsing
from tallybook.operators import normalize
from tallybook.plans import promote
from tallybook.session import materialize
from tallybook.sources import landing
from tallybook.sources.tables import TableStore


def batch_id(stream: str, epoch: int) -> str:
    """The same micro-batch always gets the same id, so that replaying it adds nothing."""
    return refdata._uuid5(refdata.SURROGATE_NAMESPACE, f"{stream}:{epoch}")


def stream_normalize(
    feed: DataFrame,
    names: DataFrame,
    store: TableStore,
    checkpoint: str,
    name: str = "feed",
    valid_id=parsing.uuid_text,
    now: Callable[[], datetime] = lambda: datetime.now(timezone.utc),
    noise_level: str = "medium",
    mapping: dict[str, str] | None = None,
    rules: list[normalize.Rule] | None = None,
    **trigger,
) -> StreamingQuery:
    """Normalize each micro-batch into raw transactions and quarantine, and log it.

    The logged window is that of the batch's transaction times, or the time of the run if none
    could be read.
    """

    def load(batch: DataFrame, epoch: int) -> None:
        if batch.isEmpty():
            return
        run, at = batch_id(name, epoch), now()
        result = normalize.normalize_receipts(
            batch, names, rules, valid_id, stage=lambda parsed: materialize(parsed, "parsed"), mapping=mapping
        )
        clean = landing.append_transactions(store, result.clean, run, at)
        bad = landing.append_quarantine(store, result.quarantine, run, at)
        received, first, last = result.annotated.agg(F.count(F.lit(1)), F.min("tx_timestamp"), F.max("tx_timestamp")).first()
        landing.log_batch(
            store, run, first or at, last or at, received, clean.received, bad.received, noise_level, at
        )

    writer = feed.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_transform(store: TableStore, checkpoint: str, **trigger) -> StreamingQuery:
    """Run the transform whenever ticks, transactions or expenses have arrived.

    All raw tables are the stream, and a run handles the rows of its micro-batch.
    """
    return promote.start_transform(store, checkpoint, **trigger)
