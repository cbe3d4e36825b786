"""Contiguous shards of nearly equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendsight.session import materialise


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of a text plus one for its separator; a NULL text counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def balanced_shards(items: DataFrame, order: list[str], size: str, shards: int) -> DataFrame:
    """``items`` with shard (int), slot and start (long): contiguous in ``order``, equal bytes a shard.

    ``items`` should hold keys and sizes, not texts: it is what gets sorted.
    An item of size s that starts at byte p goes to the shard in whose equal
    share of all bytes its middle p + s/2 lies, so a shard is off its share by
    at most one item. Slots count the items of a shard from 0 without gaps;
    start is the bytes of all items before.

    Items are range-partitioned by ``order`` and stored; only the totals of
    the partitions, one row each, meet in one task for their prefix sums.
    Within a partition a running sum goes on from its start. Repeated rows are
    dealt over partitions by a stored row number. NULL keys sort first, an
    empty table gives no rows, sizes must be positive. Columns of ``items``
    named shard, slot or start are replaced.
    """
    kept = [c for c in items.columns if c not in ("shard", "slot", "start")]
    numbered = materialise(items.select(*kept).withColumn("_row", F.monotonically_increasing_id()), "items")
    order = [*order, "_row"]
    slices = materialise(numbered.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()), "slices")

    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = slices.groupBy("_slice").agg(F.sum(size).alias("_bytes"), F.count("*").alias("_count")).select(
        "_slice",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_count_before"),
        F.sum("_bytes").over(whole).alias("_total"),
    )
    upto = Window.partitionBy("_slice").orderBy(*order)
    placed = slices.join(F.broadcast(totals), "_slice").withColumns({
        "start": F.col("_bytes_before") + F.sum(size).over(upto.rowsBetween(Window.unboundedPreceding, 0)) - F.col(size),
        "_at": F.col("_count_before") + F.row_number().over(upto) - 1,
    })
    # Twice the middle against twice the total keeps the cut in whole numbers.
    middle = (2 * F.col("start") + F.col(size)).cast("decimal(38,0)") * shards
    shard = F.expr("least(shard_exact, last_shard)").cast("int")
    placed = placed.withColumns({
        "shard_exact": F.floor(middle / (2 * F.col("_total"))), "last_shard": F.lit(shards - 1),
    }).withColumn("shard", shard)
    placed = materialise(placed, "placed")
    firsts = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        *kept, "shard", (F.col("_at") - F.col("_first")).alias("slot"), "start"
    )
