"""Whole versions of a table, switched by a pointer.

A table that is rewritten as a whole keeps each rewrite in a folder of its own. The pointer, one
small file, names the current one and is replaced last, in one rename. A reader that resolves the
pointer therefore sees one whole version, and a writer that dies leaves the old one in place.
Superseded versions stay for RETAIN_SECONDS, so that plans made before a switch can still run.

One writer at a time may rewrite a table.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RETAIN_SECONDS = 3600.0
_POINTER = "_current"
_FOLDER = "_versions"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    _files(spark, path).mkdirs(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none if it doesn't exist."""
    files = _files(spark, path)
    if not files.exists(_path(spark, path)):
        return []
    found = (status.getPath().getName() for status in files.listStatus(_path(spark, path)))
    return sorted(name for name in found if name[0] not in "._")


def remove(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None if there is none."""
    try:
        source = _files(spark, path).open(_path(spark, path))
    except Py4JJavaError as error:
        if "FileNotFoundException" in str(error.java_exception):
            return None
        raise
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that a reader sees the old content or the new one, never a part."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/_draft-{name}-{uuid.uuid4().hex}"
    out = _files(spark, path).create(_path(spark, draft), True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(rename, 1)
    overwrite[0] = rename.OVERWRITE
    target = _files(spark, path).makeQualified(_path(spark, path))
    context = fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(_files(spark, path).makeQualified(_path(spark, draft)), target, overwrite)


def current(spark: SparkSession, path: str) -> str:
    """Folder of the current version: the table's own folder if it was never rewritten."""
    version = read_text(spark, f"{path}/{_POINTER}")
    return f"{path}/{_FOLDER}/{version}" if version else path


def publish(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write `df` as a new version and make it the current one. It may be computed from the table."""
    spark = df.sparkSession
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(f"{path}/{_FOLDER}/{version}")
    write_text(spark, f"{path}/{_POINTER}", version)
    clean(spark, path)
    return version


def clean(spark: SparkSession, path: str, retain_seconds: float | None = None) -> None:
    """Remove finished versions that were replaced longer ago than the retention time.

    A version is replaced when the next finished one was written. Unfinished ones may still be
    in the making and stay.
    """
    retain = RETAIN_SECONDS if retain_seconds is None else retain_seconds
    folder, now = f"{path}/{_FOLDER}", time.time() * 1000
    held = read_text(spark, f"{path}/{_POINTER}")
    files = _files(spark, path)
    done = []
    for name in names(spark, folder):
        mark = _path(spark, f"{folder}/{name}/_SUCCESS")
        if files.exists(mark):
            done.append((name, files.getFileStatus(mark).getModificationTime()))
    for (name, _), (_, replaced) in zip(done, done[1:]):
        if name != held and name < (held or "") and now - replaced > retain * 1000:
            remove(spark, f"{folder}/{name}")


def read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The current version of a table that was published at least once."""
    return spark.read.schema(schema).parquet(current(spark, path))
