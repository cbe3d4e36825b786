"""The row at a given rank, found by histograms and never by sorting or storing rows.

Each pass counts the rows of the range that still holds the rank in at most
``BUCKETS`` parts and goes on with the one part in which the rank falls. The
parts follow the key: equal widths for numbers and dates, the next digits of
the bytes for texts. The range shrinks to the least and the greatest key of
that part, so that a part with one key ends the search whatever its number of
rows. Only the counts of a pass reach the driver.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass, field
from os.path import commonprefix
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 2**14
#: Hexadecimal digits of a text that a pass looks at: 16**3 parts.
DIGITS = 3
_WHOLE = ("byte", "short", "integer", "long")


@dataclass
class Selected:
    """``value``, the key at the rank; rows with an earlier key, their sums, and how far into the equal keys the rank is."""

    value: Any
    before: int
    rest: int
    sums: dict[str, float] = field(default_factory=dict)


def _number_bucket(kind: str, low, high) -> Column:
    key = F.col("_key")
    if kind == "whole":
        width = (high - low) // BUCKETS + 1
        exact = "bigint" if high - low < 2**62 else "decimal(38,0)"
        return F.floor((key.cast(exact) - F.lit(str(low)).cast(exact)) / F.lit(str(width)).cast("decimal(20,0)")).cast("int")
    # Halves, so that the span of any two numbers is finite; each step keeps the order.
    share = (key / 2 - F.lit(low) / 2) / (F.lit(high) / 2 - F.lit(low) / 2)
    return F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def _within(low, high) -> Column:
    return (F.col("_key") >= F.lit(low)) & (F.col("_key") <= F.lit(high))


def select_rank(
    df: DataFrame, key: str, rank: int, descending: bool = False, sums: dict[str, Column] | None = None
) -> Selected | None:
    """The key at ``rank`` (from 1) in the order of ``key``; None if there are fewer rows.

    ``sums`` are added up over the rows with an earlier key on the way. Rows
    without a key do not count; numbers must not be NaN. ``df`` is read a few
    times, once more than the base-``BUCKETS`` logarithm of the spread of its
    keys in the densest place, and should be a stored table.
    """
    sums = sums or {}
    kind = df.schema[key].dataType.typeName()
    if kind == "string":
        column, kind = F.hex(F.col(key).cast("binary")), "text"
    elif kind == "date":
        column, kind = F.unix_date(key), "date"
    else:
        column, kind = F.col(key), "whole" if kind in _WHOLE else "number"
    rows = df.select(column.alias("_key"), *[c.alias(name) for name, c in sums.items()]).filter(F.col("_key").isNotNull())
    counted = [F.count(F.lit(1)).alias("_n"), *[F.coalesce(F.sum(name), F.lit(0.0)).alias(name) for name in sums]]
    ends = [F.min("_key").alias("_low"), F.max("_key").alias("_high")]

    whole = rows.agg(F.count(F.lit(1)).alias("_n"), *ends).first()
    if not 1 <= rank <= whole["_n"]:
        return None
    low, high, found = whole["_low"], whole["_high"], Selected(None, 0, rank, dict.fromkeys(sums, 0.0))
    while True:
        inside = rows.filter(_within(low, high))
        if low == high:
            parts = []
        elif kind == "text":
            # Min and max of a text per part would make Spark sort; the common beginning is found by itself.
            head = len(commonprefix([low, high]))
            parts = inside.groupBy(F.substring("_key", 1, head + DIGITS).alias("_part")).agg(*counted).collect()
            parts.sort(key=lambda part: part["_part"], reverse=descending)
        else:
            parts = inside.groupBy(_number_bucket("whole" if kind == "date" else kind, low, high).alias("_part")).agg(*counted, *ends).collect()
            parts.sort(key=lambda part: part["_part"], reverse=descending)
        for part in parts:
            if found.rest <= part["_n"]:
                break
            found.rest -= part["_n"]
            found.before += part["_n"]
            for name in sums:
                found.sums[name] += part[name]
        else:
            found.value = low
            break
        if kind == "text":
            chosen = inside.filter(F.substring("_key", 1, head + DIGITS) == part["_part"]).agg(*ends).first()
            low, high = chosen["_low"], chosen["_high"]
        else:
            low, high = part["_low"], part["_high"]
    if kind == "text":
        found.value = bytes.fromhex(found.value).decode()
    elif kind == "date":
        found.value = datetime.date(1970, 1, 1) + datetime.timedelta(days=found.value)
    return found
