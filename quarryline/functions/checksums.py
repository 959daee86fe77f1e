"""Checksums of text or binary columns, as lower-case hex."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SHA2_SIZES = (224, 256, 384, 512)


def md5(value: Column | str) -> Column:
    return F.md5(value)


def sha1(value: Column | str) -> Column:
    return F.sha1(value)


def sha2(value: Column | str, bits: int) -> Column:
    return F.sha2(value, bits)


def all_checksums(value: Column | str) -> dict[str, Column]:
    """Every supported checksum, keyed by its report column name."""
    named = {"MD5 Checksum": md5(value), "SHA1 Checksum": sha1(value)}
    named.update({f"SHA{bits} Checksum": sha2(value, bits) for bits in SHA2_SIZES})
    return named
