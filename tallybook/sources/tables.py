"""Parquet tables of the raw and analytics schemas under one root folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions import timekeys
from tallybook.operators.normalize import nan_to_null
from tallybook.schemas import TABLES, TableSpec
from tallybook.session import configure, materialize, scratch_path
from tallybook.sources import versions

_DAY = "p_day"
_VALUE = "p_value"
_BUCKET = "p_bucket"
#: Buckets of a key index, each of them sorted by hash.
KEY_BUCKETS = 64
#: Up to this number of partitions is looked up by name, without listing the others.
LISTED_PERIODS = 400
#: A stream takes files that become visible within this time of being written.
FILE_AGE = "30d"


class TableStore:
    """Reads and appends tables; raw tables can only be appended to."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        if name not in TABLES:
            raise KeyError(f"unknown table {name!r}")
        return f"{self.root}/{name.replace('.', '/')}"

    def read(
        self,
        name: str,
        since: date | None = None,
        until: date | None = None,
        days: Iterable[date] | None = None,
        values: Iterable[str] | None = None,
    ) -> DataFrame:
        """The current version of the table, or an empty one if nothing was written yet.

        `since` and `until` (inclusive), `days` and `values` prune the partitions of tables that
        have them; a longer period is read whole.
        """
        spec = TABLES[name]
        periods = None if days is None else {_first_of(spec, d) for d in days}
        df = self._with_parts(name, periods)
        if spec.day_of:
            if since is not None:
                df = df.where(F.col(_DAY) >= F.lit(_first_of(spec, since)))
            if until is not None:
                df = df.where(F.col(_DAY) <= F.lit(_first_of(spec, until)))
            if periods is not None:
                df = df.where(F.col(_DAY).isin(sorted(periods)))
            df = df.drop(_DAY)
        if spec.value_of:
            if values is not None:
                df = df.where(F.col(_VALUE).isin(sorted(values)))
            df = df.drop(_VALUE)
        return df

    def days(self, name: str) -> set[date]:
        """The first days of the periods a table has partitions for; reads no column."""
        return {r[0] for r in self._with_parts(name).select(_DAY).distinct().collect()}

    def _parts(self, name: str) -> list[tuple[str, T.DataType]]:
        spec = TABLES[name]
        return [(_DAY, T.DateType())] * bool(spec.day_of) + [(_VALUE, T.StringType())] * bool(spec.value_of)

    def _with_parts(self, name: str, periods: set[date] | None = None) -> DataFrame:
        """The table with its partition columns. Of few periods only the folders are listed."""
        schema = T.StructType(list(TABLES[name].schema))
        for part, kind in self._parts(name):
            schema = schema.add(part, kind)
        path = versions.current(self.spark, self.path(name))
        if periods is None or len(periods) > LISTED_PERIODS or not TABLES[name].day_of:
            return self._parquet(path, schema)
        stored = set(versions.names(self.spark, path))
        folders = [f"{_DAY}={p.isoformat()}" for p in sorted(periods) if f"{_DAY}={p.isoformat()}" in stored]
        return self._parquet(path, schema, folders)

    def _parquet(self, path: str, schema: T.StructType, folders: list[str] | None = None) -> DataFrame:
        # The filter tells the optimizer that nothing is there, so joins with it go away unplanned.
        nothing = self.spark.createDataFrame([], schema).where(F.lit(False))
        if folders is not None and not folders:
            return nothing
        paths = [path] if folders is None else [f"{path}/{f}" for f in folders]
        try:
            return self.spark.read.schema(schema).option("basePath", path).parquet(*paths)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return nothing

    def _columns(self, name: str, df: DataFrame) -> list[Column]:
        spec = TABLES[name]
        missing = [c for c in spec.required if c not in df.columns]
        if missing:
            raise ValueError(f"rows for {name} are missing required columns: {missing}")
        return [
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema
        ]

    def conform(self, name: str, df: DataFrame) -> DataFrame:
        """Columns, order and types of the table; NaN becomes NULL.

        Raises if a required column is absent. Other absent columns are NULL.
        """
        columns = self._columns(name, df)
        return nan_to_null(df).select(*columns)

    def _parted(self, name: str, df: DataFrame) -> DataFrame:
        """The table's columns and its partition columns, from rows that may have more."""
        spec, columns = TABLES[name], self._columns(name, df)
        if spec.day_of:
            if spec.day_of not in df.columns:
                raise ValueError(f"rows for {name} need {spec.day_of}")
            columns.append(period_of(name, df).alias(_DAY))
        if spec.value_of:
            columns.append(F.col(spec.value_of).cast("string").alias(_VALUE))
        return nan_to_null(df).select(*columns)

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows. Files are rebalanced by partition, so a large one is split over several
        files and small ones do not leave one file per task."""
        self._finish_merge(name)
        spec, parts = TABLES[name], [p for p, _ in self._parts(name)]
        rows, path = self._parted(name, df), versions.current(self.spark, self.path(name))
        if parts:
            rows = rows.hint("rebalance", *[F.col(p) for p in parts])
            rows.sortWithinPartitions(*parts, *spec.sort).write.mode("append").partitionBy(*parts).parquet(path)
        else:
            rows.hint("rebalance").write.mode("append").parquet(path)

    def replace(self, name: str, df: DataFrame) -> None:
        """Publish a new version of a table, possibly computed from itself. Refused for raw tables."""
        if name.startswith("raw."):
            raise PermissionError(f"Raw tables are append-only: {name}")
        self._finish_merge(name)
        versions.publish(self._parted(name, df), self.path(name), tuple(p for p, _ in self._parts(name)))

    def merge(self, name: str, df: DataFrame) -> set[date]:
        """Put the rows of `df` in the place of the stored ones with their key.

        Only partitions that hold such rows are read and rewritten; the files of all others stay
        as they are. The new partitions are staged first, and a note of them is left while they
        are put in place: if the writer dies then, the next writer of the table completes it.
        Returns the first days of the periods rewritten. Readers may see some of them before others.
        """
        if name.startswith("raw."):
            raise PermissionError(f"Raw tables are append-only: {name}")
        self._finish_merge(name)
        spec = TABLES[name]
        changed = materialize(self._parted(name, df), "merge")
        periods = {r[0] for r in changed.select(_DAY).distinct().collect()}
        if periods:
            stored = self._with_parts(name, periods).where(F.col(_DAY).isin(sorted(periods)))
            keys = changed.select(*[F.col(k).alias(f"__{k}") for k in spec.key])
            match = [stored[k].eqNullSafe(keys[f"__{k}"]) for k in spec.key]
            path = scratch_path(self.spark, "merged")
            stored.join(keys, match, "left_anti").unionByName(changed).write.parquet(path)
            versions.write_text(self.spark, self._merge_note(name), path)
            self._finish_merge(name)
        return periods

    def _merge_note(self, name: str) -> str:
        return f"{self.path(name)}/_merge"

    def _finish_merge(self, name: str) -> None:
        """Put staged partitions in place, if a merge was begun; doing it again changes nothing."""
        staged = versions.read_text(self.spark, self._merge_note(name))
        if staged:
            self._overwrite(name, staged)
            versions.remove(self.spark, self._merge_note(name))

    def _overwrite(self, name: str, staged: str) -> None:
        schema = T.StructType(list(TABLES[name].schema)).add(_DAY, T.DateType())
        rows = self.spark.read.schema(schema).parquet(staged).hint("rebalance", F.col(_DAY))
        writer = rows.sortWithinPartitions(_DAY, *TABLES[name].sort).write.mode("overwrite")
        path = versions.current(self.spark, self.path(name))
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(_DAY).parquet(path)

    def is_empty(self, name: str) -> bool:
        return self.read(name).isEmpty()

    # --- key index ---------------------------------------------------------

    def _key_path(self, name: str) -> str:
        return f"{self.root}/keys/{name.replace('.', '/')}"

    def bucketed(self, name: str, df: DataFrame) -> DataFrame:
        """The index columns of rows: key, hash and bucket."""
        keys = TABLES[name].indexed
        hashed = F.xxhash64(*keys)
        return df.select(*keys, hashed.alias("key_hash"), F.pmod(hashed, F.lit(KEY_BUCKETS)).cast("int").alias(_BUCKET))

    def buckets_of(self, name: str, df: DataFrame) -> list[int]:
        """Buckets of the index that the keys of `df` fall in."""
        return sorted(r[0] for r in self.bucketed(name, df).select(_BUCKET).distinct().collect())

    def has_keys(self, name: str) -> bool:
        """Whether the index of a table holds any key."""
        self._repair_keys(name)
        return bool(versions.names(self.spark, versions.current(self.spark, self._key_path(name))))

    def known_keys(self, name: str, buckets: list[int]) -> DataFrame:
        """Stored keys of an indexed table, from these buckets only."""
        self._repair_keys(name)
        return self._index(name).where(F.col(_BUCKET).isin(buckets)).select(*TABLES[name].indexed)

    def _index(self, name: str) -> DataFrame:
        keys = [f for f in TABLES[name].schema if f.name in TABLES[name].indexed]
        schema = T.StructType(keys).add("key_hash", T.LongType()).add(_BUCKET, T.IntegerType())
        return self._parquet(versions.current(self.spark, self._key_path(name)), schema)

    def _add_keys(self, name: str, rows: DataFrame) -> None:
        path = versions.current(self.spark, self._key_path(name))
        index = self.bucketed(name, rows).hint("rebalance", F.col(_BUCKET))
        index.sortWithinPartitions(_BUCKET, "key_hash").write.mode("append").partitionBy(_BUCKET).parquet(path)

    def append_indexed(self, name: str, rows: DataFrame, days: Iterable[date]) -> None:
        """Append rows and their keys. `days` are the partitions that the rows go to.

        A note of the days is left before the rows and removed after the keys. If the writer
        dies in between, the next one that asks for keys finds the note and indexes what
        those partitions hold.
        """
        pending = f"{self._key_path(name)}/_pending/{uuid.uuid4().hex}"
        versions.make_folder(self.spark, f"{self._key_path(name)}/_pending")
        versions.write_text(self.spark, pending, ",".join(sorted(d.isoformat() for d in days)))
        self.append(name, rows)
        self._add_keys(name, rows)
        versions.remove(self.spark, pending)

    def _repair_keys(self, name: str) -> None:
        folder = self._key_path(name)
        if not versions.exists(self.spark, folder):
            # A table from before it had an index, or none at all.
            if not self.is_empty(name):
                self._add_keys(name, self.read(name))
            versions.make_folder(self.spark, f"{folder}/_pending")
        for note in versions.names(self.spark, f"{folder}/_pending"):
            days = [date.fromisoformat(d) for d in (versions.read_text(self.spark, f"{folder}/_pending/{note}") or "").split(",") if d]
            rows = self.read(name, days=days)
            index = self._index(name).where(F.col(_BUCKET).isin(self.buckets_of(name, rows)))
            keys = TABLES[name].indexed
            seen = index.select(*[F.col(k).alias(f"__{k}") for k in keys])
            missing = rows.join(seen, [rows[k].eqNullSafe(seen[f"__{k}"]) for k in keys], "left_anti")
            self._add_keys(name, materialize(missing.select(*keys), "missing-keys"))
            versions.remove(self.spark, f"{folder}/_pending/{note}")

    def compact_keys(self, name: str) -> None:
        """Publish the index anew, each bucket in few sorted files without repeats."""
        index = self._index(name).distinct().hint("rebalance", F.col(_BUCKET)).sortWithinPartitions(_BUCKET, "key_hash")
        versions.publish(index, self._key_path(name), (_BUCKET,))

    # --- arrivals ----------------------------------------------------------

    def arrivals(self, names: list[str]) -> DataFrame:
        """Streams of raw tables as one: `table` names the one whose column holds the row."""
        united = None
        for name in names:
            versions.make_folder(self.spark, self.path(name))
            schema = T.StructType(list(TABLES[name].schema))
            for part, kind in self._parts(name):
                schema = schema.add(part, kind)
            stream = self.spark.readStream.schema(schema).option("maxFileAge", FILE_AGE).parquet(self.path(name))
            columns = [F.col(f.name) for f in TABLES[name].schema]
            cells = [
                (F.struct(*columns) if other == name else F.lit(None).cast(T.StructType(list(TABLES[other].schema)))).alias(other.replace(".", "_"))
                for other in names
            ]
            tagged = stream.select(F.lit(name).alias("table"), *cells)
            united = tagged if united is None else united.unionByName(tagged)
        return united

    def split_arrivals(self, batch: DataFrame, names: list[str]) -> dict[str, DataFrame]:
        """The rows of each table in a micro-batch, written once so that files are read once.

        A file holds one table's rows and says so in its statistics, by which readers skip it.
        Folders by table would need every row sorted.
        """
        staged = materialize(batch, "arrivals")
        return {n: staged.where(F.col("table") == n).select(f"{n.replace('.', '_')}.*") for n in names}


def _first_of(spec: TableSpec, day: date) -> date:
    return day.replace(day=1) if spec.period == "month" else day


def period_of(name: str, df: DataFrame) -> Column:
    """First day of the partition that a row of `df` belongs to."""
    spec = TABLES[name]
    column = F.col(spec.day_of)
    if isinstance(df.schema[spec.day_of].dataType, T.LongType):
        column = timekeys.t_stamp(column)
    day = F.to_date(column.cast("timestamp"))
    return F.trunc(day, "month") if spec.period == "month" else day
