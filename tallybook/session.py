"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

RUNTIME_CONF = {
    # All event times are UTC; parsers and date_trunc depend on it.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts must fail loudly; parsers use the try_* functions instead.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time, which every shuffled join here relies on.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split them even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Appends that rewrite a partition must leave the other partitions alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

#: The most that a task reads of a table or of a shuffle. Rows take up to ten times their compressed size in a
#: sort, and a task may hold two sorts, so with Spark's own sizes (128 and 64 MB) they spill.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 32 << 20,
}
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def _bytes(size: str) -> int:
    """Bytes of a size as Spark writes it, such as `64MB` or `16m`."""
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)i?b?", size.strip().lower()).groups()
    return int(number) << _UNITS[unit]


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on to an existing session.

    Sizes of tasks are lowered to TASK_BYTES; smaller ones stay.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


#: Rows handed to a Python worker at once. Both sides hold a whole batch, whose texts may be long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> SparkSession:
    """Lower the rows of an Arrow batch to BATCH_ROWS; smaller batches stay."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def build_session(app: str = "tallybook", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for intermediate tables.

    The cluster's shared folder (`spark.checkpoint.dir`) is used wherever it is set, so that
    a table written by one executor can be read by all others and survives losing any of them.
    Only an unset setting on a local master falls back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = tempfile.mkdtemp(prefix="tallybook-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the scratch folder and read it back, cutting its lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class RowCounter:
    """Counts the rows of a DataFrame while it is written, without a job of its own."""

    def __init__(self) -> None:
        self._seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, F.count(F.lit(1)).alias("n"))

    @property
    def rows(self) -> int:
        try:
            return self._seen.get["n"]
        except Py4JError:
            # Run-time optimization removes an input found to be empty together with its
            # counter, which then has no value.
            return 0
