"""Forward-looking default labels and default entries on a panel.

The panel has one row per credit and period; ``order`` names its period column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lendsight.functions import rules

LABEL_HORIZON = 3


def in_default() -> Column:
    return F.col("stage").eqNullSafe(3)


def with_label(panel: DataFrame, horizon: int = LABEL_HORIZON, order: str = "month_index") -> DataFrame:
    """Every panel row with its label, rows in default too."""
    ahead = Window.partitionBy("credit_id").orderBy(order).rowsBetween(1, horizon)
    return panel.withColumn(f"default_within_{horizon}", F.coalesce(F.max(in_default().cast("int")).over(ahead), F.lit(0)))


def default_labels(
    panel: DataFrame, horizon: int = LABEL_HORIZON, order: str = "month_index", drop_censored: bool = False
) -> DataFrame:
    """1 if the credit is in stage 3 in any of its next ``horizon`` rows, for rows not in stage 3 themselves.

    The last rows of a credit see fewer than ``horizon`` rows and default to 0;
    ``drop_censored`` leaves them out instead. A row whose stage is unknown is
    not in stage 3 and keeps its label.
    """
    labelled = with_label(panel, horizon, order)
    label = f"default_within_{horizon}"
    if drop_censored:
        ahead = Window.partitionBy("credit_id").orderBy(order).rowsBetween(1, horizon)
        labelled = labelled.withColumn("_seen", F.count(F.lit(1)).over(ahead)).filter(F.col("_seen") == horizon)
    kept = [c for c in ("credit_id", "client_id", order, "statement_date", "stage") if c in panel.columns]
    return labelled.filter(~in_default()).select(*kept, label)


def default_entries(panel: DataFrame, order: str = "month_index") -> DataFrame:
    """Rows on which a credit moves into stage 3; a first row counts as coming from stage 1."""
    previous = F.lag("stage", 1, 1).over(Window.partitionBy("credit_id").orderBy(order))
    return (
        panel.withColumn("previous_stage", previous)
        .filter(rules.entered_default(F.col("previous_stage"), F.col("stage")))
        .select("credit_id", order, "previous_stage", "stage")
    )
