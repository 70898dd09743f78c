"""Deterministic identifiers as native column expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybook import refdata


def uuid5(namespace: str, name: Column) -> Column:
    """RFC 4122 version-5 UUID of `name`, equal to Python's `uuid.uuid5`."""
    prefix = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.sha1(F.concat(prefix, F.encode(name, "utf-8")))
    # The variant nibble keeps its two low bits and gets the bits 10 in front.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def _part(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("None"))


def quarantine_id(batch_id: Column, tx_id: Column, failure_code: Column) -> Column:
    """Identity of one violation inside a batch; nulls are spelled `None`."""
    name = F.concat_ws(":", _part(batch_id), _part(tx_id), _part(failure_code))
    return uuid5(refdata.QUARANTINE_NAMESPACE, name)


def surrogate_id(kind: str, *natural_key: Column) -> Column:
    """Retry-safe replacement for a random surrogate key: a hash of the natural key."""
    return uuid5(
        refdata.SURROGATE_NAMESPACE, F.concat_ws("|", F.lit(kind), *map(_part, natural_key))
    )
