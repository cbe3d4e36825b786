"""Training set, weights, split, fit and evaluation."""

import datetime
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lendsight.operators import model, newton
from lendsight.session import materialise

FEATURES = (
    "credit_id string, period date, due_status string, late_streak bigint, balance double, balance_avg_3 double, "
    "balance_avg_6 double, balance_avg_12 double, overdraft_ratio_3 double, incident_freq_6 double"
)
LABELS = "credit_id string, statement_date date, default_within_3 int"
JANUARY = datetime.date(2023, 1, 1)


@pytest.fixture(scope="module")
def dataset(spark):
    rng = random.Random(2)
    features, labels = [], []
    for i in range(600):
        bad = int(rng.random() < 0.2)
        streak = rng.randint(2, 6) if bad and rng.random() < 0.9 else rng.randint(0, 3)
        level = 900.0 - 200 * bad + rng.gauss(0, 150)
        features.append((f"C{i}", JANUARY, "late", streak, level, level, level + 40, level + 90, rng.random(), rng.random()))
        labels.append((f"C{i}", datetime.date(2023, 1, 1 + i % 28), bad))
    labels.append(("nobody", JANUARY, 1))
    labels.append(("C0", datetime.date(2023, 1, 30), 0))  # second statement in one month
    labels.append(("C0", datetime.date(2023, 2, 1), 1))  # a month without features
    return materialise(model.training_set(spark.createDataFrame(features, FEATURES), spark.createDataFrame(labels, LABELS)))


def test_training_set_keeps_every_feature_row_once(dataset):
    assert dataset.count() == 600 == dataset.select("credit_id", "period").distinct().count()
    assert dataset.columns == [*model.MODEL_FEATURES, "default_within_3", "credit_id", "period"]


def test_two_labels_in_a_period_count_as_positive_if_one_is(spark):
    features = spark.createDataFrame([("A", JANUARY, "late", 1, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0)], FEATURES)
    labels = spark.createDataFrame([("A", JANUARY, 0), ("A", datetime.date(2023, 1, 31), 1)], LABELS)
    assert [r.default_within_3 for r in model.training_set(features, labels).collect()] == [1]


@pytest.mark.parametrize(
    "labels, expected",
    [
        ([1] * 20 + [0] * 40, {1: 1.5, 0: 0.75}),
        ([0] * 10, {0: 0.5}),
        ([1] * 10, {1: 0.5}),
        ([1] * 2 + [0] * 5 + [None] * 3, {1: 2.5, 0: 1.0, None: 1.0}),
    ],
)
def test_class_weights(spark, labels, expected):
    df = spark.createDataFrame([(v,) for v in labels], "default_within_3 int")
    weighted = model.with_class_weight(df).distinct().collect()
    assert {r.default_within_3: r.weight for r in weighted} == expected


def test_an_absent_class_divides_by_one(spark):
    df = spark.createDataFrame([(0,), (0,)], "default_within_3 int")
    weights = model.with_class_weight(df)
    assert weights.select(F.max("weight")).first()[0] == 0.5


def test_weights_leave_no_cross_join(dataset):
    plan = model.with_class_weight(dataset)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_split_by_key_is_stable_and_whole(dataset):
    train, test = model.split_by_key(dataset)
    keys = lambda df: {r.credit_id for r in df.select("credit_id").collect()}
    again, _ = model.split_by_key(dataset.repartition(9))
    assert keys(train) == keys(again) and not keys(train) & keys(test)
    assert train.count() + test.count() == 600 and 0.65 < train.count() / 600 < 0.85


def test_split_by_row_is_whole(dataset):
    train, test = model.split_by_row(dataset)
    assert train.count() + test.count() == 600


@pytest.mark.parametrize("by_row", [False, True])
def test_fit_predict_evaluate(dataset, by_row):
    fitted, predictions, test = model.fit_and_predict(model.with_class_weight(dataset), by_row=by_row)
    kept = materialise(predictions.select("credit_id", "period", "default_within_3", "rawPrediction", "probability", "prediction"))
    kept = model.with_margin(kept)
    assert kept.count() == test.count() > 0
    table = model.prediction_table(kept)
    assert table.filter("probability_positive not between 0 and 1").isEmpty()
    assert table.filter("(prediction = 1) <> (probability_positive > 0.5)").isEmpty()
    metrics = model.evaluate(kept).first()
    judge = BinaryClassificationEvaluator(labelCol="default_within_3", rawPredictionCol="margin", numBins=0)
    assert metrics.auc_roc == round(judge.evaluate(kept, {judge.metricName: "areaUnderROC"}), 4) > 0.8
    assert metrics.auc_pr == round(judge.evaluate(kept, {judge.metricName: "areaUnderPR"}), 4)
    rows = [(r.default_within_3, r.prediction) for r in kept.collect()]
    tp, fp = rows.count((1, 1.0)), rows.count((0, 1.0))
    fn = rows.count((1, 0.0))
    assert metrics.precision_positive == pytest.approx(tp / (tp + fp), abs=1e-4)
    assert metrics.recall_positive == pytest.approx(tp / (tp + fn), abs=1e-4)
    assert fitted.stages[-1].numFeatures == 6


def test_same_split_gives_the_same_model(dataset):
    weighted = model.with_class_weight(dataset)
    first, _, _ = model.fit_and_predict(weighted)
    second, _, _ = model.fit_and_predict(weighted.repartition(5))
    assert first.stages[-1].coefficients.toArray() == pytest.approx(second.stages[-1].coefficients.toArray(), rel=1e-5)


def _rows(spark, n, separable=False, seed=5):
    rng = random.Random(seed)
    made = []
    for i in range(n):
        x = [float(rng.randint(0, 5)), rng.gauss(0, 50), rng.gauss(10, 40), rng.gauss(5, 30), rng.random(), 0.25]
        risk = x[0] - 2 + (0 if separable else rng.gauss(0, 3))
        made.append((*x, int(risk > 0), f"C{i}", 1.0 + (i % 3)))
    names = ", ".join(f"{c} double" for c in model.MODEL_FEATURES)
    return spark.createDataFrame(made, f"{names}, {model.LABEL} int, credit_id string, weight double")


def test_newton_finds_the_optimum_of_the_pipeline(spark):
    rows = _rows(spark, 800)
    fitted = newton.fit(rows)
    assert fitted.steps < 12 and fitted.coefficients[5] == 0.0  # the last feature does not vary
    stages = model.build_model().fit(rows).stages
    assert fitted.coefficients == pytest.approx(list(stages[-1].coefficients), abs=1e-4)
    assert fitted.intercept == pytest.approx(stages[-1].intercept, abs=1e-4)
    gradient = newton._sums(newton._scaled(rows, fitted.deviations, model.LABEL), np.array([*fitted.coefficients[:5], fitted.intercept]))[1]
    assert np.abs(gradient).max() < 1e-12
    predicted = newton.predict(rows, fitted).collect()
    assert all((r.probability_positive > 0.5) == (r.prediction == 1.0) == (r.margin > 0) for r in predicted)


def test_newton_on_separable_rows_one_class_and_no_rows(spark):
    fitted = newton.fit(_rows(spark, 200, separable=True))
    rows = newton.predict(_rows(spark, 200, separable=True), fitted).collect()
    assert all(int(r.prediction) == r[model.LABEL] for r in rows)
    alone = newton.predict(_rows(spark, 50).withColumn(model.LABEL, F.lit(1)), newton.fit(_rows(spark, 50).withColumn(model.LABEL, F.lit(1))))
    assert alone.filter("prediction < 1").isEmpty()
    with pytest.raises(ValueError, match="no rows"):
        newton.fit(_rows(spark, 1).limit(0))
