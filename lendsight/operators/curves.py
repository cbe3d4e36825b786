"""How well a score separates the positive label: confusion counts, ROC and precision-recall."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from lendsight.functions.rules import SCORE_DECIMALS
from lendsight.operators.ranking import running_totals, with_next


def confusion_matrix(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Counts for the four combinations of label and prediction; a combination that never occurs counts 0."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    cells = {"n00": ~actual & ~predicted, "n01": ~actual & predicted, "n10": actual & ~predicted, "n11": actual & predicted}
    return (
        predictions.agg(*[F.count_if(condition).alias(name) for name, condition in cells.items()])
        .unpivot([], list(cells), "cell", "n")
        .select(
            F.substring("cell", 2, 1).cast("int").alias("label"),
            F.substring("cell", 3, 1).cast("int").alias("prediction"),
            "n",
        )
    )


def classification_metrics(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of the positive class from one pass, to four decimals."""
    actual, predicted = F.col(label) == 1, F.col(prediction) == 1
    counts = predictions.agg(
        F.count_if(actual & predicted).alias("tp"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
    )

    def share(part, whole):
        return F.bround(F.when(whole > 0, part / whole).otherwise(F.lit(0.0)), 4)

    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        share(tp, tp + fp).alias("precision_positive"),
        share(tp, tp + fn).alias("recall_positive"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_positive"),
    )


def threshold_table(scored: DataFrame, score: str, label: str, decimals: int | None = None) -> DataFrame:
    """Positives and negatives at every score, and true and false positives when it is the threshold.

    Every distinct score is kept, and the running sums are spread over the
    cluster. ``decimals`` of at most four round scores of 0..1 first: they then
    have at most 10 001 values, which are summed in one task.
    """
    value = F.col(score) if decimals is None else F.bround(F.col(score), decimals)
    counts = (
        scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(value.alias("threshold"))
        .agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives"))
    )
    if decimals is None or decimals > SCORE_DECIMALS:
        return running_totals(counts, "threshold", {"tp": "positives", "fp": "negatives"}, descending=True)
    upto = Window.orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns({"tp": F.sum("positives").over(upto), "fp": F.sum("negatives").over(upto)})


def _origin(df: DataFrame, **values: float) -> DataFrame:
    return df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), *[F.lit(v).alias(name) for name, v in values.items()]
    )


def without_straight_points(table: DataFrame) -> DataFrame:
    """A threshold table without the points at which neither count changes its step, of any number of thresholds.

    The first and the last point stay. The step to a point is its own counts of
    positives and negatives, so it only has to be held against the next point's.
    """
    ahead = with_next(table, "threshold", {"_positives": "positives", "_negatives": "negatives"}, descending=True)
    bends = (F.col("_positives") != F.col("positives")) | (F.col("_negatives") != F.col("negatives"))
    is_first = F.col("tp") + F.col("fp") == F.col("positives") + F.col("negatives")
    return ahead.filter(is_first | F.coalesce(bends, F.lit(True))).select(*table.columns)


def roc_points(table: DataFrame, drop_collinear: bool = False) -> DataFrame:
    """False and true positive rates per threshold, from the origin (threshold NULL) on.

    ``drop_collinear`` leaves out points on the straight line between their neighbours.
    """
    if drop_collinear:
        table = without_straight_points(table)
    totals = table.agg(F.struct(F.max("tp").alias("tp"), F.max("fp").alias("fp")).alias("totals")).scalar()
    points = table.select(
        "threshold",
        F.when(totals["fp"] > 0, F.col("fp") / totals["fp"]).alias("fpr"),
        F.when(totals["tp"] > 0, F.col("tp") / totals["tp"]).alias("tpr"),
    )
    return _origin(table, fpr=0.0, tpr=0.0).unionByName(points)


def pr_points(table: DataFrame) -> DataFrame:
    """Precision and recall per threshold, closed by precision 1 at recall 0 (threshold NULL)."""
    positives = table.agg(F.max("tp").alias("tp")).scalar()
    points = table.select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.when(positives > 0, F.col("tp") / positives).otherwise(F.lit(1.0)).alias("recall"),
    )
    return _origin(table, precision=1.0, recall=0.0).unionByName(points)


def area_under_curves(table: DataFrame) -> DataFrame:
    """Trapezoid areas under the ROC and the precision-recall curve, rounded table or not.

    The counts at a threshold tell where the strip to its left begins, so this
    is a plain aggregate. The precision-recall curve starts at recall 0 with
    the precision of the highest threshold.
    """
    tp, fp, positives, negatives = (F.col(c) for c in ("tp", "fp", "positives", "negatives"))
    before_tp, before_fp = tp - positives, fp - negatives
    precision = tp / (tp + fp)
    before = F.when(before_tp + before_fp > 0, before_tp / (before_tp + before_fp)).otherwise(precision)
    summed = table.agg(
        F.sum(negatives.cast("double") * (tp + before_tp)).alias("roc"),
        F.sum(positives * (precision + before)).alias("pr"),
        F.max("tp").alias("tp"),
        F.max("fp").alias("fp"),
    )
    return summed.select(
        F.when((tp > 0) & (fp > 0), F.col("roc") / (2.0 * tp * fp)).alias("auc_roc"),
        F.when(tp > 0, F.col("pr") / (2.0 * tp)).alias("auc_pr"),
    )
