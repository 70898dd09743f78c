"""Exact duplicates by content hash, with the bytes compared inside each group.

DataFrame functions only. Rows are grouped by a 128-bit hash of the normalised text; where a
hash occurs more than once, its texts are grouped by hash and text together, which compares
bytes. Texts of hashes that occur once never leave their task. Copies collapse before the
shuffle, so a group holding a third of all rows is a few rows per task.

Defined cases: a null text is the empty text, and all empty texts are copies of each other. Rows
that repeat an id with the same text are one document: each counts in the group size, and each
is kept if that id is. A row without an id is kept only if its whole group has none. An empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.spread import broadcast_if_small
from tallybook.session import RowCounter, materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; a null is the empty text.

    `lower` does just that where every character is one byte, and is much faster.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep: str = "smallest",
    fingerprint: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per row of `docs`.

    `keep` says which id of a group stays, the smallest or the largest.
    """
    return _grouped(docs, id_column, text_column, keep, fingerprint).drop("raw")


def _grouped(docs: DataFrame, id_column: str, text_column: str, keep: str, fingerprint=F.md5) -> DataFrame:
    best = {"smallest": F.min, "largest": F.max}[keep]
    source = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.col(f"`{text_column}`").alias("text"),
        F.xxhash64(f"`{text_column}`").alias("raw"),
    )
    rows = materialize(
        source.withColumn("norm", ascii_lower(F.col("text"))).select(
            "doc_id", "raw", fingerprint(F.col("norm")).alias("hash"), F.sha2("norm", 256).alias("text_sha256")
        ),
        "hashes",
    )
    groups = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("group_size"), best("doc_id").alias("keep_id"))
    # Texts whose hash occurs again. The raw hash tells repeated ids with different texts apart.
    repeated = rows.join(groups.where("group_size > 1").select("hash"), "hash")
    suspects_seen = RowCounter()
    suspects = materialize(suspects_seen.watch(repeated.select("doc_id", "raw", "hash").distinct()), "suspects")
    wanted = broadcast_if_small(suspects, suspects_seen.rows)
    compared = source.join(
        wanted.hint("shuffle_hash") if suspects_seen.rows and wanted is suspects else wanted,
        source["doc_id"].eqNullSafe(wanted["doc_id"]) & (source["raw"] == wanted["raw"]),
    ).select(source["doc_id"], source["raw"], "hash", ascii_lower(F.col("text")).alias("norm"))
    classes = materialize(
        compared.groupBy("hash", "norm")
        .agg(F.count(F.lit(1)).alias("group_size"), best("doc_id").alias("keep_id"))
        .select("hash", "group_size", "keep_id", F.xxhash64("norm").alias("part")),
        "classes",
    )
    collided = classes.groupBy("hash").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    result = rows.join(groups, "hash")
    if not collided.isEmpty():
        result = _separated(rows, groups, compared, collided, best)
    return result.select(
        "doc_id",
        "raw",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("doc_id").isNull() & F.col("keep_id").isNull()).alias("kept"),
        "text_sha256",
    )


def _separated(rows: DataFrame, groups: DataFrame, compared: DataFrame, collided: DataFrame, best) -> DataFrame:
    """Rows with their group where different texts share a hash: those groups are split by text."""
    texts = compared.join(collided.select("hash"), "hash")
    split = texts.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("group_size"), best("doc_id").alias("keep_id"))
    owner = (
        texts.join(split, ["hash", "norm"])
        .select("doc_id", "raw", "hash", "group_size", "keep_id")
        .distinct()
        .withColumnsRenamed({"doc_id": "_id", "raw": "_raw", "hash": "_hash"})
    )
    clean = rows.join(collided.select("hash"), "hash", "left_anti").join(groups, "hash")
    mixed = rows.join(
        owner,
        rows["doc_id"].eqNullSafe(owner["_id"]) & (rows["raw"] == owner["_raw"]) & (rows["hash"] == owner["_hash"]),
    ).drop("_id", "_raw", "_hash")
    return clean.unionByName(mixed.select(*clean.columns))


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of `docs` that stay, with all their columns, one for each group."""
    groups = materialize(_grouped(docs, id_column, text_column, keep), "groups")
    # Whole rows travel as one column, so that their names can't clash with others.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    own_id, text = F.col(f"row.`{id_column}`"), F.col(f"row.`{text_column}`")

    def matched(rows: DataFrame, wanted: DataFrame, how: str) -> DataFrame:
        seen = RowCounter()
        keys = materialize(seen.watch(wanted.select("doc_id", "raw").distinct()), "keys")
        keys = broadcast_if_small(keys, seen.rows)
        return rows.join(keys, own_id.eqNullSafe(F.col("doc_id")) & (F.xxhash64(text) == F.col("raw")), how)

    kept = matched(packed, groups.where("not kept"), "left_anti")
    # Of rows that repeat an id and its text, or have no id, one stays.
    again = groups.where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = materialize(again, "again")
    if again.isEmpty():
        return kept.select("row.*")
    again = groups.where("kept").join(
        again.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha")),
        F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_sha256") == F.col("sha")),
    )
    single = matched(kept, again, "left_semi").withColumns({"id": own_id, "norm": ascii_lower(text)}).dropDuplicates(["id", "norm"])
    return matched(kept, again, "left_anti").unionByName(single.select("row")).select("row.*")
