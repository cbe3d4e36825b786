"""Questions asked of the portfolio state: scores, watch list, provisions, stress."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from lendsight.functions import rules
from lendsight.operators.selection import Selected, select_rank

WATCH_LIST_SIZE = 100


def with_score(state: DataFrame) -> DataFrame:
    score = rules.risk_score(
        F.col("late_streak"),
        F.col("balance_avg_3"),
        F.col("balance_avg_12"),
        F.col("overdraft_ratio_3"),
        F.col("incident_freq_6"),
    )
    return state.withColumn("score", score).withColumn("alert_level", rules.alert_level(F.col("score")))


def score_table(state: DataFrame) -> DataFrame:
    return with_score(state).select(
        "credit_id",
        "score",
        "alert_level",
        F.col("late_streak").cast("bigint").alias("late_streak"),
        F.col("stage").cast("int").alias("stage"),
    )


def credit_score(state: DataFrame, credit_id) -> DataFrame:
    """Score of one credit; empty if the credit is unknown."""
    return score_table(state.filter(F.col("credit_id") == F.lit(credit_id)))


def credit_scores(state: DataFrame, wanted: DataFrame) -> DataFrame:
    """Scores of the credits listed in ``wanted``; unknown ones give no row."""
    return score_table(state.join(wanted.select("credit_id"), "credit_id", "left_semi"))


def watch_list(state: DataFrame, limit: int = WATCH_LIST_SIZE) -> DataFrame:
    """The ``limit`` riskiest credits at or above the medium alert, ties in credit order."""
    return (
        with_score(state)
        .filter(F.col("score") >= rules.MEDIUM_ALERT)
        .orderBy(F.desc("score"), "credit_id")
        .limit(limit)
        .select(
            "credit_id",
            "country",
            "credit_type",
            "score",
            "alert_level",
            F.col("stage").cast("int").alias("stage"),
            F.col("outstanding").cast("double").alias("outstanding"),
            F.col("late_streak").cast("bigint").alias("late_streak"),
        )
    )


WATCH_LIST_COLUMNS = ["credit_id", "country", "credit_type", "score", "alert_level", "stage", "outstanding", "late_streak"]


def watch_list_display(watched: DataFrame, headings: dict[str, str]) -> DataFrame:
    """The watch list under the headings of a report; a column without one keeps its name."""
    return watched.select(*[F.col(c).alias(headings.get(c, c)) for c in WATCH_LIST_COLUMNS])


def _loss() -> Column:
    return rules.expected_loss(F.col("outstanding"), F.col("stage"))


def overview(state: DataFrame) -> DataFrame:
    """One row: credits, credits per alert level and total expected loss."""
    level = F.col("alert_level")
    return with_score(state).agg(
        F.count(F.lit(1)).alias("n_credits"),
        F.count_if(level == "low").alias("n_low"),
        F.count_if(level == "medium").alias("n_medium"),
        F.count_if(level == "high").alias("n_high"),
        F.coalesce(F.sum(_loss()), F.lit(0.0)).alias("total_ecl"),
    )


def loss_by_country(state: DataFrame) -> DataFrame:
    """Credits and expected loss per known country, greatest loss first."""
    return (
        state.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count("credit_id").alias("n_credits"), F.sum(_loss()).alias("ecl"))
        .orderBy(F.desc("ecl"), "country")
    )


def _rank_score() -> Column:
    return F.coalesce("score", F.lit(-1.0))  # an unknown score ranks last


def _cut(scored: DataFrame, part: float, sums: dict[str, Column] | None = None) -> tuple[int, Selected | None, Selected | None]:
    """Rows of the share, the score in which it ends, and its last credit among those of that score (None, None for no rows)."""
    if not 0 <= part <= 1:
        raise ValueError("part must lie between 0 and 1")
    wanted = math.floor(float(scored.count()) * part)
    ranked = scored.withColumn("_rank_score", _rank_score())
    cut = select_rank(ranked, "_rank_score", wanted, descending=True, sums=sums)
    if cut is None:
        return wanted, None, None
    tied = ranked.filter(F.col("_rank_score") == F.lit(cut.value))
    return wanted, cut, select_rank(tied, "credit_id", cut.rest, sums=sums)


def riskiest_share(scored: DataFrame, part: float) -> Column:
    """Predicate that holds for exactly ``floor(n * part)`` rows with the greatest scores, of equal ones in credit order.

    The table is never sorted and none of its rows stored: histograms of the
    score find the score at which the cut falls, and histograms of the credit
    the last one inside among those of that score, so that any number of
    scores and any number of credits of one score will do. ``scored`` has one
    row per credit, is read several times and should be a stored table.
    """
    _, cut, last = _cut(scored, part)
    if cut is None:
        return F.lit(False)
    score = _rank_score()
    return (score > F.lit(cut.value)) | ((score == F.lit(cut.value)) & (F.col("credit_id") <= F.lit(last.value)))


def provision_stress(scored: DataFrame, part: float) -> DataFrame:
    """Expected loss before and after the riskiest ``part`` of the credits drops one stage.

    ``scored`` has credit_id, score, stage and outstanding, one row per credit.
    What the stress adds is summed while the cut is searched for, as in
    :func:`riskiest_share`; the one row at the cut is read by its key.
    """
    worse = rules.expected_loss(F.col("outstanding"), rules.downgraded_stage(F.col("stage")))
    added = F.coalesce(worse, F.lit(0.0)) - F.coalesce(_loss(), F.lit(0.0))
    wanted, cut, last = _cut(scored, part, {"added": added})
    total = 0.0
    if cut is not None:
        at_cut = scored.filter((F.col("credit_id") == F.lit(last.value)) & (_rank_score() == F.lit(cut.value)))
        total = cut.sums["added"] + last.sums["added"] + at_cut.agg(F.coalesce(F.sum(added), F.lit(0.0))).first()[0]
    before = scored.agg(F.coalesce(F.sum(_loss()), F.lit(0.0)).alias("ecl_before"))
    stressed = before.select(
        F.lit(wanted).cast("bigint").alias("n_downgraded"), "ecl_before", (F.col("ecl_before") + F.lit(total)).alias("ecl_after")
    )
    return stressed.withColumn("variation_pct", rules.variation_pct(F.col("ecl_before"), F.col("ecl_after")))
