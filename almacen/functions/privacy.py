"""Masking as a policy: what happens to each sensitive column, and keyed pseudonyms that can be rotated.

A pseudonym is ``<version>:<HMAC-SHA256 of the value's text under that version's key>``. Without the key
it can't be found by trying values, unlike a plain hash of a small id; with one key it is the same in every
table, so tables still join on it. Keys are literals of the plan: who may read plans may read them,
so write pseudonymised tables in a session of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, DROP, MASK, PSEUDONYM, MONTH = "keep", "drop", "mask", "pseudonym", "month"
BLOCK_BYTES = 64  # of SHA-256


@dataclass(frozen=True)
class Keys:
    """Secret keys by version, and the version that new pseudonyms get."""

    by_version: Mapping[str, bytes]
    current: str


def hmac_sha256(value: Column, key: bytes) -> Column:
    """HMAC-SHA256 of text or bytes as lowercase hex; null stays null."""
    key = (hashlib.sha256(key).digest() if len(key) > BLOCK_BYTES else key).ljust(BLOCK_BYTES, b"\0")
    inner, outer = (F.lit(bytearray(k ^ pad for k in key)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, value.cast("binary")), 256))), 256)


def pseudonym(column: str, keys: Keys, version: str | None = None) -> Column:
    version = version or keys.current
    return F.concat(F.lit(f"{version}:"), hmac_sha256(F.col(column).cast("string"), keys.by_version[version]))


def apply_policy(df: DataFrame, policy: Mapping[str, str], keys: Keys | None = None) -> DataFrame:
    """``df`` with every column treated as ``policy`` says; a column it doesn't name is dropped, so that a new one can't leak.

    ``mask`` keeps the form of a text (letters x, digits n), ``month`` the first day of a date's month.
    """
    if PSEUDONYM in policy.values() and keys is None:
        raise ValueError("pseudonyms need keys")
    rules = {
        KEEP: F.col,
        MASK: lambda c: F.mask(F.col(c).cast("string")),
        MONTH: lambda c: F.trunc(F.col(c), "month"),
        PSEUDONYM: lambda c: pseudonym(c, keys),
    }
    unknown = {rule for rule in policy.values() if rule not in rules and rule != DROP}
    if unknown:
        raise ValueError(f"unknown rules {sorted(unknown)}")
    return df.select(*[rules[policy[c]](c).alias(c) for c in df.columns if policy.get(c, DROP) != DROP])


def crosswalk(ids: DataFrame, column: str, keys: Keys, old: str, new: str | None = None) -> DataFrame:
    """(anterior, actual): the pseudonyms of all values of ``column`` under two versions, one row a value."""
    some = ids.where(F.col(column).isNotNull()).select(column).distinct()
    return some.select(pseudonym(column, keys, old).alias("anterior"), pseudonym(column, keys, new).alias("actual"))


def rotate(stored: DataFrame, column: str, walk: DataFrame) -> DataFrame:
    """A stored table with the pseudonyms of ``column`` replaced by ``walk``; those it doesn't have stay, so a run may be repeated."""
    joined = stored.join(walk, F.col(column) == F.col("anterior"), "left")
    new = F.coalesce("actual", column).alias(column)
    return joined.select(*[new if c == column else F.col(c) for c in stored.columns])
