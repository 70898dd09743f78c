"""Ingestion metrics as a partitioned table of JSON lines on shared storage."""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tallybook.sources import versions

SCHEMA = (
    "event string, at timestamp, query string, run_id string, batch bigint, input_rows bigint, fetch_ms bigint, "
    "insert_ms bigint, total_ms bigint, success boolean, failures int, p_day date"
)


class IngestMetrics(StreamingQueryListener):
    """One row per micro-batch, start and stop: rows, durations, success.

    Rows are held until there are `every` of them or a query stops, then written as one file of
    their day's partition.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path.rstrip("/"), every
        self.failures = 0
        self._held: list[dict] = []
        self._lock = threading.Lock()
        self._stopped: set[str] = set()
        self._news = threading.Condition()

    def _add(self, event: str, run_id, success: bool = True, **more) -> None:
        at = datetime.now(timezone.utc)
        row = {
            "event": event, "at": at.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "run_id": str(run_id), "success": success,
            "failures": self.failures, **more,
        }
        with self._lock:
            self._held.append(row)
            due = len(self._held) >= self.every
        if due:
            self.flush()

    def flush(self) -> None:
        """Write what is held."""
        with self._lock:
            rows, self._held = self._held, []
        days: dict[str, list[str]] = {}
        for row in rows:
            days.setdefault(row["at"][:10], []).append(json.dumps(row))
        for day, lines in days.items():
            folder = f"{self.path}/p_day={day}"
            versions.make_folder(self.spark, folder)
            versions.write_text(self.spark, f"{folder}/part-{uuid.uuid4().hex}.json", "\n".join(lines) + "\n")

    def onQueryStarted(self, event) -> None:
        self._add("started", event.runId, query=event.name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        durations = dict(progress.durationMs)
        self._add(
            "batch", progress.runId, query=progress.name, batch=progress.batchId, input_rows=progress.numInputRows,
            fetch_ms=durations.get("getBatch", 0) + durations.get("latestOffset", 0),
            insert_ms=durations.get("addBatch", 0), total_ms=durations.get("triggerExecution", 0),
        )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        failed = event.exception is not None
        self.failures += int(failed)
        self._add("stopped", event.runId, not failed)
        self.flush()
        with self._news:
            self._stopped.add(str(event.runId))
            self._news.notify_all()

    def wait_for(self, run_id, seconds: float = 30.0) -> bool:
        """Wait until the rows of a query that has ended are stored: events arrive after its end."""
        with self._news:
            return self._news.wait_for(lambda: str(run_id) in self._stopped, seconds)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows, pruned by `p_day`; none if nothing was stored."""
    if not versions.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path)


def ingest_summary(rows: DataFrame) -> DataFrame:
    """Per day: micro-batches, rows, failed queries, and mean and longest durations."""
    batch = F.col("event") == "batch"
    return rows.groupBy("p_day").agg(
        F.count_if(batch).alias("batches"),
        F.coalesce(F.sum(F.when(batch, F.col("input_rows"))), F.lit(0)).alias("input_rows"),
        F.count_if((F.col("event") == "stopped") & ~F.col("success")).alias("failed"),
        F.round(F.avg("total_ms"), 1).alias("mean_ms"),
        F.max("total_ms").alias("longest_ms"),
    )
