"""Latest known situation of every credit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

PANEL_STATE = ["stage", "outstanding"]
FEATURE_STATE = ["late_streak", "balance_avg_3", "balance_avg_12", "overdraft_ratio_3", "incident_freq_6"]


_ORDERED = {"date": F.unix_date, "timestamp": F.unix_micros, "byte": F.col, "short": F.col, "integer": F.col, "long": F.col}


def latest_per_key(df: DataFrame, key: str, order: str, columns: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key, by aggregation and without a window.

    Numbers and dates aggregate in hash maps, and the rows of a key fold on the
    map side. All columns come from one row: below the order, a whole number, a
    date or a timestamp, stands a hash of the columns, so that of several rows
    of one order the same one counts in every run and any partitioning. Another
    type of order travels as it is, which makes Spark aggregate by sorting.
    ``summary.duplicate_keys`` finds such rows, and the portfolio job looks for
    them unless told not to. Rows without an order do not count.
    """
    kind = df.schema[order].dataType.typeName()
    if kind not in _ORDERED:
        latest = df.filter(F.col(order).isNotNull()).groupBy(key).agg(F.max(F.struct(order, F.struct(*columns).alias("row"))).alias("latest"))
        return latest.select(key, "latest.row.*")
    size = F.lit(str(2**60)).cast("decimal(19,0)")
    tie = F.pmod(F.xxhash64(*columns), F.lit(2**60)).cast("decimal(19,0)")
    place = (_ORDERED[kind](order).cast("bigint").cast("decimal(19,0)") * size + tie).cast("decimal(38,0)")
    return df.withColumn("_place", place).groupBy(key).agg(*[F.max_by(c, "_place").alias(c) for c in columns])


def credit_attributes(credits: DataFrame, clients: DataFrame) -> DataFrame:
    return credits.select("credit_id", "client_id", "credit_type").join(
        clients.select("client_id", "country"), "client_id"
    )


def portfolio_state(
    panel: DataFrame,
    features: DataFrame,
    credits: DataFrame,
    clients: DataFrame,
    panel_order: str = "month_index",
    features_order: str = "period",
) -> DataFrame:
    """Latest panel row and latest feature row of each credit, with client, credit type and country.

    Credits missing from either side are left out; missing attributes stay NULL.
    """
    situation = latest_per_key(panel, "credit_id", panel_order, PANEL_STATE)
    behaviour = latest_per_key(features, "credit_id", features_order, FEATURE_STATE)
    return situation.join(behaviour, "credit_id").join(credit_attributes(credits, clients), "credit_id", "left")
