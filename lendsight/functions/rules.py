"""Credit rules as Column expressions; all of them stay in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values.
STAGE_2_DPD = 30
STAGE_3_DPD = 90
PROVISION_RATES = {1: 0.01, 2: 0.10, 3: 0.60}
STREAK_WEIGHT = 0.35
TREND_WEIGHT = 0.25
OVERDRAFT_WEIGHT = 0.20
INCIDENT_WEIGHT = 0.20
STREAK_SATURATION = 6
BALANCE_DROP_SATURATION = -0.5
MEDIUM_ALERT = 0.3
HIGH_ALERT = 0.6
SCORE_DECIMALS = 4


def stage_from_dpd(dpd: Column) -> Column:
    return (
        F.when(dpd >= STAGE_3_DPD, F.lit(3))
        .when(dpd >= STAGE_2_DPD, F.lit(2))
        .when(dpd < STAGE_2_DPD, F.lit(1))
    )


def due_status_from_dpd(dpd: Column) -> Column:
    return (
        F.when(dpd >= STAGE_2_DPD, F.lit("unpaid"))
        .when(dpd > 0, F.lit("late"))
        .when(dpd <= 0, F.lit("on_time"))
    )


def instalment_amount(principal: Column, term_months: Column) -> Column:
    return F.rint(principal / term_months)


def outstanding_balance(principal: Column, term_months: Column, months_elapsed: Column, dpd: Column) -> Column:
    """Straight-line balance; from 30 days past due on, the arrears are added back (not capped at the principal)."""
    paid = F.when(dpd >= STAGE_2_DPD, months_elapsed - dpd / F.lit(30.0)).otherwise(months_elapsed.cast("double"))
    return F.rint(principal * F.greatest(F.lit(0.0), F.lit(1.0) - paid / term_months))


def expected_loss(balance: Column, stage: Column) -> Column:
    """Balance times the stage's provision rate, in whole units. A stage outside 1..3 is an error."""
    unknown = F.raise_error(F.concat(F.lit("no provision rate for stage "), F.coalesce(stage.cast("string"), F.lit("NULL"))))
    rate = F.when(stage == 1, F.lit(PROVISION_RATES[1]))
    for known in (2, 3):
        rate = rate.when(stage == known, F.lit(PROVISION_RATES[known]))
    return F.rint(balance * rate.otherwise(unknown.cast("double")))


def downgraded_stage(stage: Column) -> Column:
    return F.when(stage == 1, F.lit(2)).otherwise(F.lit(3))


def _at_most_one(value: Column) -> Column:
    # least() would turn a missing ratio into 1.
    return F.when(value > 1.0, F.lit(1.0)).otherwise(value)


def streak_subscore(late_streak: Column) -> Column:
    return _at_most_one(late_streak / F.lit(float(STREAK_SATURATION)))


def balance_trend_subscore(balance_avg_3: Column, balance_avg_12: Column) -> Column:
    """Share of a saturating fall of the short balance mean below the long one; 0 where there is no fall."""
    fall = (balance_avg_3 - balance_avg_12) / F.abs(balance_avg_12)
    return (
        F.when((balance_avg_12 <= 0) | (balance_avg_3 >= balance_avg_12), F.lit(0.0))
        .otherwise(_at_most_one(fall / F.lit(BALANCE_DROP_SATURATION)))
    )


def risk_score(
    late_streak: Column,
    balance_avg_3: Column,
    balance_avg_12: Column,
    overdraft_ratio: Column,
    incident_freq: Column,
) -> Column:
    """Weighted sum of the four sub-scores, within [0, 1], half-even to four decimals."""
    raw = (
        F.lit(STREAK_WEIGHT) * streak_subscore(late_streak)
        + F.lit(TREND_WEIGHT) * balance_trend_subscore(balance_avg_3, balance_avg_12)
        + F.lit(OVERDRAFT_WEIGHT) * _at_most_one(overdraft_ratio)
        + F.lit(INCIDENT_WEIGHT) * _at_most_one(incident_freq)
    )
    return F.bround(F.when(raw < 0, F.lit(0.0)).otherwise(_at_most_one(raw)), SCORE_DECIMALS)


def alert_level(score: Column) -> Column:
    return F.when(score >= HIGH_ALERT, F.lit("high")).when(score >= MEDIUM_ALERT, F.lit("medium")).otherwise(F.lit("low"))


def variation_pct(before: Column, after: Column) -> Column:
    """Relative change in percent to two decimals; 0 where there was nothing before."""
    return F.bround(F.when(before != 0, (after - before) / before * 100).otherwise(F.lit(0.0)), 2)


def clipped_rate(rate: Column, low: float, high: float) -> Column:
    """Rate within its bounds, half-even to two decimals after scaling by a hundred."""
    bounded = F.when(rate < low, F.lit(float(low))).when(rate > high, F.lit(float(high))).otherwise(rate)
    return F.rint(bounded * 100) / 100


def entered_default(previous_stage: Column, stage: Column) -> Column:
    return (previous_stage != 3) & (stage == 3)
