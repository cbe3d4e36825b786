"""Period keys, stable identifiers and the split bucket."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

GRAIN_FORMATS = {"month": "yyyy-MM", "day": "yyyy-MM-dd"}


def period_of(date: Column, grain: str = "month") -> Column:
    """First day of the period as a DATE: four bytes in every grouping, sort and join."""
    if grain not in GRAIN_FORMATS:
        raise ValueError(f"grain must be one of {sorted(GRAIN_FORMATS)}")
    return F.trunc(date, "MM") if grain == "month" else date


def period_label(period: Column, grain: str = "month") -> Column:
    """Text of a period, as written to files and reports."""
    return F.date_format(period, GRAIN_FORMATS[grain])


def period_from_label(label: Column) -> Column:
    return F.to_date(F.rpad(label, 10, "-01"))


def stable_id(prefix: str, *parts: Column) -> Column:
    """Identifier derived from the natural key, so it needs no global sequence and survives recomputation."""
    digest = F.md5(F.concat_ws("|", *[part.cast("string") for part in parts]))
    return F.concat(F.lit(prefix), digest)


def split_bucket(key: Column) -> Column:
    """0..99, the same for a key wherever and whenever it is computed."""
    digest = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(100)).cast("int")


def cents(amount: Column) -> Column:
    """Money as whole hundredths: sums are exact in any order, and no sum that fits a table overflows 38 digits."""
    whole = F.rint(amount * 100)
    # By way of a BIGINT where it fits: a double becomes a decimal by way of its text.
    fits = F.abs(whole) < F.lit(1e15)
    return F.when(fits, whole.cast("bigint").cast("decimal(38,0)")).otherwise(whole.cast("decimal(38,0)"))


def from_cents(total: Column) -> Column:
    return total.cast("double") / 100
