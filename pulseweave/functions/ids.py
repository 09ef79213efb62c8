"""Identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _dashed(hex32: Column) -> Column:
    """Split 32 hex digits into the 8-4-4-4-12 form."""
    starts_and_lengths = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(hex32, s, n) for s, n in starts_and_lengths])


def uuid_from_bytes(raw: Column) -> Column:
    """16 big-endian bytes to UUID text."""
    return _dashed(F.lower(F.hex(raw)))


def bytes_from_uuid(text: Column) -> Column:
    """UUID text to 16 big-endian bytes."""
    return F.unhex(F.replace(text, F.lit("-"), F.lit("")))


def uuid_from_long(number: Column) -> Column:
    """A non-negative integer key in UUID form, zero padded."""
    return _dashed(F.lower(F.lpad(F.hex(number), 32, "0")))


def random_id() -> Column:
    """A new id on every evaluation; a retried task produces other ids."""
    return F.expr("uuid()")


def stable_id(*parts: Column) -> Column:
    """An id derived from the row, so that a retry writes the same row again.

    Each part goes in with its length, so that no two lists of parts look alike.
    """
    def part(p: Column) -> Column:
        text = p.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return _dashed(F.md5(F.concat(*[part(p) for p in parts])))


def value_part(value: Column) -> Column:
    """A reading as a part of an id, to millionths."""
    return (F.when(F.isnan(value), F.lit("nan"))
            .otherwise(F.round(value * 1_000_000).try_cast("bigint").cast("string")))
