"""Behavioural features of a credit over its periods.

All windows share one partitioning and one order (credit, period), hence one
shuffle and one sort. Frames count rows, so a missing period widens the span.
Input is unique on (credit, period), which bounds a window group by the number
of periods however many raw events a credit has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from lendsight.functions.keys import cents, from_cents
from lendsight.operators.activity import period_activity

BALANCE_SPANS = (3, 6, 12)
OVERDRAFT_SPAN = 3
INCIDENT_SPAN = 6

FEATURE_TABLE = [
    "credit_id",
    "period",
    "due_status",
    "late_streak",
    "balance",
    "balance_avg_3",
    "balance_avg_6",
    "balance_avg_12",
    "overdraft_ratio_3",
    "incident_freq_6",
]

def _by_credit() -> WindowSpec:
    return Window.partitionBy("credit_id").orderBy("period")


def _to_date() -> WindowSpec:
    return _by_credit().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _last_rows(n: int) -> WindowSpec:
    return _by_credit().rowsBetween(1 - n, Window.currentRow)


def _is_late() -> Column:
    return F.col("due_status") != "on_time"


# Running quantities that the features below build on.


def _position() -> Column:
    return F.row_number().over(_by_credit())


def _balance_cents() -> Column:
    return F.sum(cents(F.col("net_movement"))).over(_to_date())


def _late_streak() -> Column:
    # Rows since the last one that was not late; a missing status counts as not late.
    punctual = F.when(F.coalesce(_is_late(), F.lit(False)), F.lit(None)).otherwise(F.col("_position"))
    return (F.col("_position") - F.coalesce(F.max(punctual).over(_to_date()), F.lit(0))).cast("bigint")


def _balances() -> dict[str, Column]:
    def mean(n: int) -> Column:
        frame = _last_rows(n)
        return F.sum("_balance_cents").over(frame).cast("double") / (F.count("_balance_cents").over(frame) * 100)

    return {"balance": from_cents(F.col("_balance_cents")), **{f"balance_avg_{n}": mean(n) for n in BALANCE_SPANS}}


def _overdraft_ratio() -> Column:
    return F.avg((F.col("overdraft_amount") > 0).cast("double")).over(_last_rows(OVERDRAFT_SPAN))


def _incident_frequency() -> Column:
    # A missing status is no evidence either way: avg() leaves it out.
    return F.avg((F.col("due_status") == "unpaid").cast("double")).over(_last_rows(INCIDENT_SPAN))


def with_late_streak(activity: DataFrame) -> DataFrame:
    """Number of consecutive late or unpaid instalments up to this row; a missing status ends the run."""
    return activity.withColumn("_position", _position()).withColumn("late_streak", _late_streak()).drop("_position")


def with_status_islands(activity: DataFrame) -> DataFrame:
    """Runs of equal lateness: change flag, run number and rank within the run."""
    # 1 for late, 0 for on time, NULL for unknown; an unknown row starts a run, and so does the row after it.
    state = _is_late().cast("int")
    before = F.lag(state).over(_by_credit())
    changed = F.when(state == before, F.lit(0)).otherwise(F.lit(1))
    within = Window.partitionBy("credit_id", "island").orderBy("period")
    return (
        activity.withColumn("changed", changed)
        .withColumn("island", F.sum("changed").over(_to_date()))
        .withColumn("island_rank", F.row_number().over(within))
    )


def with_balance_trend(activity: DataFrame) -> DataFrame:
    """Running account balance and its rolling means."""
    return activity.withColumn("_balance_cents", _balance_cents()).withColumns(_balances()).drop("_balance_cents")


def with_overdraft_ratio(activity: DataFrame) -> DataFrame:
    """Share of the last three rows with an overdraft."""
    return activity.withColumn("overdraft_ratio_3", _overdraft_ratio())


def with_incident_frequency(activity: DataFrame) -> DataFrame:
    """Share of unpaid instalments among the known statuses of the last six rows."""
    return activity.withColumn("incident_freq_6", _incident_frequency())


def features_from_activity(activity: DataFrame) -> DataFrame:
    """All features in two window passes over one sort."""
    running = activity.withColumns(
        {
            "_position": _position(),
            "_balance_cents": _balance_cents(),
            "overdraft_ratio_3": _overdraft_ratio(),
            "incident_freq_6": _incident_frequency(),
        }
    )
    return running.withColumns({"late_streak": _late_streak(), **_balances()}).select(*FEATURE_TABLE)


def behaviour_features(
    events: DataFrame,
    grain: str = "month",
    order_by: Column | None = None,
    known_only: bool = False,
    statuses: list[str] | None = None,
) -> DataFrame:
    """Feature table straight from raw events; for ``known_only`` and ``statuses`` see :func:`period_activity`."""
    return features_from_activity(period_activity(events, grain, order_by, known_only, statuses))
