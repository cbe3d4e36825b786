"""Orders over a whole table, computed without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendsight.session import materialise


def running_totals(
    df: DataFrame, by: str, totals: dict[str, str], descending: bool = False, overall: dict[str, str] | None = None
) -> DataFrame:
    """Running sums of ``totals`` (new name -> column) over all rows ordered by the distinct values of ``by``.

    Rows are range-partitioned into slices and stored; slice sums give each
    slice its starting point, and the sums then run within the slices. Only the
    slice sums, one row per shuffle partition, meet in one task. ``overall``
    adds sums over all rows.
    """
    overall = overall or {}
    order = F.col(by).desc() if descending else F.col(by).asc()
    sliced = materialise(df.repartitionByRange(order).withColumn("_slice", F.spark_partition_id()), "running-totals")

    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = sorted({*totals.values(), *overall.values()})
    sums = sliced.groupBy("_slice").agg(*[F.sum(c).alias(f"_sum_{c}") for c in summed])
    starts = sums.select(
        "_slice",
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_start_{name}") for name, c in totals.items()],
        *[F.sum(f"_sum_{c}").over(everything).alias(name) for name, c in overall.items()],
    )
    within = Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sliced.join(F.broadcast(starts), "_slice")
    running = {name: F.sum(c).over(within) + F.col(f"_start_{name}") for name, c in totals.items()}
    return placed.withColumns(running).select(*df.columns, *totals, *overall)


def with_next(df: DataFrame, by: str, columns: dict[str, str], descending: bool = False) -> DataFrame:
    """``df`` with, for each row, values of the row that follows in the order of the distinct values of ``by``.

    ``columns`` maps new names to columns, which must not be NULL; the last row
    gets NULLs. Rows are range-partitioned into slices and stored. Within a
    slice a window looks ahead; across its end each slice is handed a halo, the
    first row of the next slice that has rows. Only these halos, one row per
    shuffle partition, meet in one task.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    sliced = materialise(df.repartitionByRange(order).withColumn("_slice", F.spark_partition_id()), "slices")
    first = F.max_by if descending else F.min_by
    firsts = sliced.groupBy("_slice").agg(*[first(c, by).alias(f"_first_{name}") for name, c in columns.items()])
    ahead = Window.orderBy("_slice")
    halos = firsts.select("_slice", *[F.lead(f"_first_{name}").over(ahead).alias(f"_halo_{name}") for name in columns])
    within = Window.partitionBy("_slice").orderBy(order)
    seen = sliced.join(F.broadcast(halos), "_slice")
    following = {name: F.coalesce(F.lead(c).over(within), F.col(f"_halo_{name}")) for name, c in columns.items()}
    return seen.withColumns(following).select(*df.columns, *columns)


def value_ranks(df: DataFrame, column: str) -> DataFrame:
    """Every known value of a column with its share-of-ranks position, ties sharing their mean rank."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running_totals(counts, column, {"_upto": "_n"}, overall={"_known": "_n"})
    mean_rank = F.col("_upto") - (F.col("_n") - 1) / 2
    return ranks.select(column, (mean_rank / F.col("_known")).alias("_rank"))


def with_percent_rank(df: DataFrame, column: str, name: str) -> DataFrame:
    """Percentile rank with mean rank for ties; NULLs stay unranked and do not count."""
    return df.join(value_ranks(df, column).withColumnRenamed("_rank", name), column, "left")


def with_min_max(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``value`` scaled to 0..1 between its least and greatest; NULL where all values are equal. Reads ``df`` twice."""
    valued = df.withColumn("_value", value)
    bounds = valued.agg(F.struct(F.min("_value").alias("low"), F.max("_value").alias("high")).alias("bounds")).scalar()
    span = bounds["high"] - bounds["low"]
    scaled = F.when(span != 0, (F.col("_value") - bounds["low"]) / span)
    return valued.withColumn(name, scaled).drop("_value")


def latent_risk(clients: DataFrame) -> DataFrame:
    """Fragility of each client, 0..1: low income and short tenure rank high."""
    ranked = with_percent_rank(clients, "monthly_income", "income_rank")
    ranked = with_percent_rank(ranked, "bank_tenure_months", "tenure_rank")
    weighted = F.lit(0.5) * (1 - F.col("income_rank")) + F.lit(0.3) * (1 - F.col("tenure_rank"))
    return with_min_max(materialise(ranked, "ranked"), weighted, "latent_risk")
