"""Behavioural features of new periods, continued from a stored state instead of from all history.

The state has one row per credit: where its balance and its late streak stand,
and what the windows still look back on, the last eleven rows. New rows and those
of the state meet in one shuffle on the credit, and the windows run over both.
Sums over many rows are differences of running totals. Since balances are whole
hundredths and everything else is counted, the features are those of a run over
all history, bit by bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from lendsight.functions.keys import cents, from_cents
from lendsight.operators.behaviour import BALANCE_SPANS, FEATURE_TABLE, INCIDENT_SPAN, OVERDRAFT_SPAN

#: Rows before the newest one that the widest window looks back on.
KEPT = max(*BALANCE_SPANS, OVERDRAFT_SPAN, INCIDENT_SPAN) - 1

_RECENT = "array<struct<balance_cents:decimal(38,0),overdrawn:int,unpaid:int>>"
_STATE = f"struct<period:date,balance_cents:decimal(38,0),late_streak:bigint,recent:{_RECENT}>"


def state_schema(credit_type: str) -> str:
    """Columns of the state: ``recent`` lists rows from the newest back, at most ``KEPT``; unpaid is NULL without a status."""
    return f"credit_id {credit_type}, period date, balance_cents decimal(38,0), late_streak bigint, recent {_RECENT}"


def no_state(activity: DataFrame) -> DataFrame:
    """The state before the first period."""
    return activity.sparkSession.createDataFrame([], state_schema(activity.schema["credit_id"].dataType.simpleString()))


def _by_credit() -> WindowSpec:
    """Rows of the state first, from the oldest, then the new ones."""
    return Window.partitionBy("credit_id").orderBy("_is_new", "period", "_place")


def _to_date() -> WindowSpec:
    return _by_credit().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _share(span: int, flag: str) -> Column:
    """Mean of a flag over the last ``span`` rows where it is known."""
    frame = _by_credit().rowsBetween(1 - span, Window.currentRow)
    known = F.count(flag).over(frame)
    return F.when(known > 0, F.sum(flag).over(frame).cast("double") / known)


def _mean_balance(span: int) -> Column:
    """From running totals, a lag of them each: no frame is summed again for every row."""

    def within(total: str) -> Column:
        return F.col(total) - F.coalesce(F.lag(total, span).over(_by_credit()), F.lit(0))

    known = within("_known_balances")
    return F.when(known > 0, within("_total_cents").cast("double") / (known * 100))


def _past(state: DataFrame) -> DataFrame:
    """The rows that the state lists; the newest one brings the balance and the streak to go on from."""
    listed = state.select("*", F.posexplode_outer("recent").alias("_back", "_row"))
    newest = F.coalesce("_back", F.lit(0)) == 0
    return listed.select(
        "credit_id", "period", F.lit(False).alias("_is_new"), (-F.coalesce("_back", F.lit(0))).alias("_place"),
        F.when(newest, F.col("balance_cents")).cast("decimal(38,0)").alias("_movement"),
        F.when(newest, F.col("late_streak")).alias("_streak_before"), F.col("period").alias("_state_period"),
        F.col("_row").isNotNull().alias("_is_listed"), F.col("_row.balance_cents").alias("_listed_cents"), F.col("_row.overdrawn").alias("_overdrawn"), F.col("_row.unpaid").alias("_unpaid"),
    )


def continued(activity: DataFrame, state: DataFrame) -> DataFrame:
    """The rows of ``activity`` with their features, and with each credit's last row the state after it.

    ``activity`` holds one row per credit and period, all later than the
    credit's state; an earlier one is an error. A credit without new rows is
    kept as one row of its own. Store the result and read it with
    :func:`new_features` and :func:`new_state`.
    """
    late = F.coalesce(F.col("due_status") != "on_time", F.lit(False))
    fresh = activity.select(
        "credit_id", "period", "due_status", F.lit(True).alias("_is_new"), F.lit(0).alias("_place"),
        cents(F.col("net_movement")).alias("_movement"), late.alias("_late"),
        (F.col("overdraft_amount") > 0).cast("int").alias("_overdrawn"), (F.col("due_status") == "unpaid").cast("int").alias("_unpaid"),
    )
    counted = fresh.unionByName(_past(state), allowMissingColumns=True)
    running = counted.withColumns({
        "_new_rows": F.count_if("_is_new").over(_to_date()),
        "_running_cents": F.sum("_movement").over(_to_date()),
        "_streak_before": F.coalesce(F.max("_streak_before").over(_to_date()), F.lit(0).cast("bigint")),
        "_state_period": F.max("_state_period").over(_to_date()),
        "overdraft_ratio_3": _share(OVERDRAFT_SPAN, "_overdrawn"),
        "incident_freq_6": _share(INCIDENT_SPAN, "_unpaid"),
        "_is_last": F.lead("_is_new").over(_by_credit()).isNull(),
        "_is_kept": F.lead("_is_new", KEPT).over(_by_credit()).isNull(),
    })
    running = running.withColumn("_balance_cents", F.when(F.col("_is_new"), F.col("_running_cents")).otherwise(F.col("_listed_cents")))
    totalled = running.withColumns({
        "_punctual": F.max(F.when(F.col("_is_new") & ~F.col("_late"), F.col("_new_rows"))).over(_to_date()),
        "_total_cents": F.sum("_balance_cents").over(_to_date()),
        "_known_balances": F.count("_balance_cents").over(_to_date()),
    })
    streak = F.when(F.col("_punctual").isNull(), F.col("_new_rows") + F.col("_streak_before")).otherwise(F.col("_new_rows") - F.col("_punctual"))
    row = F.struct(F.col("_balance_cents").alias("balance_cents"), F.col("_overdrawn").alias("overdrawn"), F.col("_unpaid").alias("unpaid"))
    listed = F.col("_is_kept") & (F.col("_is_new") | F.col("_is_listed"))
    whole = _by_credit().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    featured = totalled.withColumns({
        "late_streak": streak.cast("bigint"),
        "balance": from_cents(F.col("_balance_cents")),
        **{f"balance_avg_{n}": _mean_balance(n) for n in BALANCE_SPANS},
        "_rows": F.collect_list(F.when(listed, row)).over(whole),
    })
    after = F.struct(
        F.col("period"), F.col("_running_cents").alias("balance_cents"), F.col("late_streak"), F.reverse("_rows").alias("recent")
    )
    before = F.coalesce("_state_period", F.lit("0001-01-01").cast("date"))
    wrong = F.raise_error(F.concat(F.lit("a row is not after the state of credit "), F.col("credit_id").cast("string"))).cast("date")
    checked = F.when(~F.col("_is_new") | (F.col("period") > before), F.col("period")).otherwise(wrong)
    featured = featured.withColumns({"_after": F.when(F.col("_is_last"), after.cast(_STATE)), "period": checked})
    return featured.filter(F.col("_is_new") | F.col("_is_last")).select(*FEATURE_TABLE, "_is_new", "_after")


def new_features(rows: DataFrame) -> DataFrame:
    """The feature table of the new rows."""
    return rows.filter("_is_new").select(*FEATURE_TABLE)


def new_state(rows: DataFrame) -> DataFrame:
    """The state after the new rows, of every credit."""
    return rows.filter(F.col("_after").isNotNull()).select("credit_id", "_after.*")
