"""Training set, class weights, split, class-weighted logistic regression and its evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from lendsight.functions.keys import period_of, split_bucket
from lendsight.operators.curves import area_under_curves, classification_metrics, threshold_table
from lendsight.session import scratch_path

MODEL_FEATURES = [
    "late_streak",
    "balance_avg_3",
    "balance_avg_6",
    "balance_avg_12",
    "overdraft_ratio_3",
    "incident_freq_6",
]
LABEL = "default_within_3"

# Fixed values.
TRAIN_SHARE = 0.75
SEED = 42


def training_set(
    features: DataFrame, labels: DataFrame, label: str = LABEL, date: str = "statement_date", grain: str = "month"
) -> DataFrame:
    """Feature rows with the label of the same credit and period.

    Two labels for one credit and period count as one, positive if either is,
    so that no feature row is doubled.
    """
    per_period = (
        labels.withColumn("period", period_of(F.col(date), grain))
        .groupBy("credit_id", "period")
        .agg(F.max(label).alias(label))
    )
    return features.join(per_period, ["credit_id", "period"]).select(*MODEL_FEATURES, label, "credit_id", "period")


def class_counts(dataset: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: all rows, positives and negatives."""
    return dataset.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(label) == 1).alias("n_positive"),
        F.count_if(F.col(label) == 0).alias("n_negative"),
    )


def with_class_weight(dataset: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight n / (2 * class size); a class without rows divides by one, a missing label weighs as negative."""
    weighed = class_counts(dataset, label).select(
        F.struct(
            (F.col("n") / (2 * F.greatest("n_positive", F.lit(1)))).alias("positive"),
            (F.col("n") / (2 * F.greatest("n_negative", F.lit(1)))).alias("negative"),
        ).alias("weights")
    )
    weights = weighed.scalar()
    return dataset.withColumn("weight", F.when(F.col(label) == 1, weights["positive"]).otherwise(weights["negative"]))


def split_by_key(dataset: DataFrame, key: str = "credit_id", train_share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    """All rows of a credit on one side; the same split on every run and any partitioning."""
    in_train = split_bucket(F.col(key)) < round(train_share * 100)
    return dataset.filter(in_train), dataset.filter(~in_train)


def split_by_row(dataset: DataFrame, train_share: float = TRAIN_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Random split of rows; depends on the partitioning, so store the dataset first."""
    train, test = dataset.randomSplit([train_share, 1 - train_share], seed=seed)
    return train, test


def build_model(label: str = LABEL, handle_invalid: str = "error", aggregation_depth: int = 2) -> Pipeline:
    """Assemble, scale to unit deviation, weighted logistic regression."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=MODEL_FEATURES, outputCol="raw_features", handleInvalid=handle_invalid),
            StandardScaler(inputCol="raw_features", outputCol="scaled_features"),
            LogisticRegression(
                featuresCol="scaled_features", labelCol=label, weightCol="weight", aggregationDepth=aggregation_depth
            ),
        ]
    )


def fit_and_predict(dataset: DataFrame, label: str = LABEL, by_row: bool = False) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Model fitted on the training side, its predictions for the test side, and the test side.

    The fit reads ``dataset`` several times; pass a stored table. The model is
    read back from storage: the fitted object drags its training summary, which
    is bound to the driver's session, into every task that predicts.
    """
    train, test = split_by_row(dataset) if by_row else split_by_key(dataset)
    path = scratch_path(dataset.sparkSession, "model")
    build_model(label).fit(train).write().save(path)
    model = PipelineModel.load(path)
    return model, model.transform(test), test


def prediction_table(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    return predictions.select(
        "credit_id",
        "period",
        label,
        vector_to_array("probability")[1].alias("probability_positive"),
        "prediction",
    )


def with_margin(predictions: DataFrame) -> DataFrame:
    """``margin``: the raw score of the positive class, which ranks finer than the probability near 0 and 1."""
    return predictions.withColumn("margin", vector_to_array("rawPrediction")[1])


def evaluate(predictions: DataFrame, label: str = LABEL, score: str = "margin") -> DataFrame:
    """One row with both areas under curve and precision, recall and F1 of the positive class, unweighted.

    The areas are exact: every distinct score is a threshold, and their sums
    run over the cluster. Two passes over ``predictions``, which should be a
    stored table.
    """
    areas = area_under_curves(threshold_table(predictions, score, label))
    both = areas.select(F.struct("auc_roc", "auc_pr").alias("areas")).scalar()
    return classification_metrics(predictions, label).select(
        F.bround(both["auc_roc"], 4).alias("auc_roc"),
        F.bround(both["auc_pr"], 4).alias("auc_pr"),
        "precision_positive",
        "recall_positive",
        "f1_positive",
    )


def weighted_gradient(model: PipelineModel, train: DataFrame, label: str = LABEL) -> DataFrame:
    """(term, gradient): how far the fit is from its optimum on the rows it was fitted on, per feature and intercept.

    The derivative of the mean weighted log loss: sum of weight x (probability
    - label) x scaled feature, over the sum of weights. Zero at the optimum.
    """
    fitted = model.transform(train).select(
        (F.col("weight") * (vector_to_array("probability")[1] - F.col(label))).alias("error"),
        "weight", vector_to_array("scaled_features").alias("x"),
    )
    terms = {name: F.col("x")[i] for i, name in enumerate(MODEL_FEATURES)} | {"intercept": F.lit(1.0)}
    sums = fitted.agg(*[(F.sum(F.col("error") * x) / F.sum("weight")).alias(name) for name, x in terms.items()])
    return sums.unpivot([], list(terms), "term", "gradient")


def scaled_features(model: PipelineModel, dataset: DataFrame) -> DataFrame:
    """Key, period and the features as the fitted scaler sees them."""
    scaled = model.transform(dataset).withColumn("_x", vector_to_array("scaled_features"))
    return scaled.select("credit_id", "period", *[F.col("_x")[i].alias(name) for i, name in enumerate(MODEL_FEATURES)])
