"""Running totals, percentile ranks and curves against pandas and plain Python."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from lendsight.operators import curves, ranking


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, some have none."""
    rng = random.Random(4)
    draw = lambda: 7.0 if rng.random() < 0.34 else None if rng.random() < 0.05 else round(rng.gauss(0, 50), 1)
    return pd.DataFrame({"id": range(4000), "v": [draw() for _ in range(4000)]})


@pytest.fixture(scope="module")
def skewed_df(spark, skewed):
    rows = [(int(i), None if pd.isna(v) else float(v)) for i, v in skewed.itertuples(index=False)]
    return spark.createDataFrame(rows, "id bigint, v double").repartition(5)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(skewed_df, skewed, descending):
    counts = skewed_df.filter("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    got = {r.v: r.upto for r in ranking.running_totals(counts, "v", {"upto": "n"}, descending).collect()}
    expected = skewed.v.value_counts().sort_index(ascending=not descending).cumsum()
    assert got == expected.to_dict()


def test_percent_rank_equals_pandas(skewed_df, skewed):
    got = {r.id: r.p for r in ranking.with_percent_rank(skewed_df, "v", "p").collect()}
    assert len(got) == 4000
    for i, p in zip(skewed.id, skewed.v.rank(pct=True)):
        assert (got[i] is None) if pd.isna(p) else got[i] == p


def test_min_max(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (5.0,), (None,)], "x double")
    assert [r.s for r in ranking.with_min_max(df, F.col("x") * 2, "s").orderBy("x").collect()] == [None, 0.0, 0.5, 1.0]
    flat = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert {r.s for r in ranking.with_min_max(flat, F.col("x"), "s").collect()} == {None}


def test_latent_risk(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"monthly_income": rng.integers(1, 60, 500) * 1000.0, "bank_tenure_months": rng.integers(1, 180, 500)})
    raw = 0.5 * (1 - pdf.monthly_income.rank(pct=True)) + 0.3 * (1 - pdf.bank_tenure_months.rank(pct=True))
    expected = (raw - raw.min()) / (raw.max() - raw.min())
    rows = [(i, float(a), int(b)) for i, (a, b) in enumerate(pdf.itertuples(index=False))]
    clients = spark.createDataFrame(rows, "client_id int, monthly_income double, bank_tenure_months int")
    got = {r.client_id: r.latent_risk for r in ranking.latent_risk(clients).collect()}
    assert [got[i] for i in range(500)] == pytest.approx(expected.tolist(), abs=1e-12)


SCORED = "score double, label int"


@pytest.fixture(scope="module")
def scored_rows():
    rng = random.Random(9)
    rows = []
    for _ in range(3000):
        label = int(rng.random() < 0.1)
        score = 0.0 if rng.random() < 0.34 else min(1.0, max(0.0, rng.gauss(0.3 + 0.2 * label, 0.2)))
        rows.append((score, label))
    return rows


@pytest.fixture(scope="module")
def scored(spark, scored_rows):
    return spark.createDataFrame(scored_rows, SCORED).repartition(4)


def counted(rows, decimals):
    points, tp, fp = [], 0, 0
    key = lambda s: s if decimals is None else round(s, decimals)
    for threshold in sorted({key(s) for s, _ in rows}, reverse=True):
        tp += sum(1 for s, y in rows if key(s) == threshold and y == 1)
        fp += sum(1 for s, y in rows if key(s) == threshold and y == 0)
        points.append((threshold, tp, fp))
    return points


@pytest.mark.parametrize("decimals", [None, 2, 4])
def test_threshold_table(scored, scored_rows, decimals):
    got = curves.threshold_table(scored, "score", "label", decimals).collect()
    assert sorted(((r.threshold, r.tp, r.fp) for r in got), reverse=True) == counted(scored_rows, decimals)


def test_roc_and_pr_points(scored, scored_rows):
    table = curves.threshold_table(scored, "score", "label", 2)
    points = counted(scored_rows, 2)
    p, n = points[-1][1:]
    roc = {r.threshold: (r.fpr, r.tpr) for r in curves.roc_points(table).collect()}
    assert roc == {None: (0.0, 0.0), **{t: (fp / n, tp / p) for t, tp, fp in points}}
    pr = {r.threshold: (r.precision, r.recall) for r in curves.pr_points(table).collect()}
    assert pr == {None: (1.0, 0.0), **{t: (tp / (tp + fp), tp / p) for t, tp, fp in points}}


def test_dropping_collinear_points_keeps_the_area(scored):
    table = curves.threshold_table(scored, "score", "label", 2)
    area = lambda df: np.trapezoid(*np.array(sorted((r.tpr, r.fpr) for r in df.collect())).T)
    full, thin = curves.roc_points(table), curves.roc_points(table, drop_collinear=True)
    assert thin.count() <= full.count() and area(thin) == pytest.approx(area(full), abs=1e-12)


@pytest.mark.parametrize("decimals", [2, 4, None])
def test_areas_equal_the_library_evaluator(scored, decimals):
    areas = curves.area_under_curves(curves.threshold_table(scored, "score", "label", decimals)).first()
    score = F.col("score") if decimals is None else F.bround("score", decimals)
    rounded = scored.select(score.alias("score"), F.col("label").cast("double").alias("label"))
    judge = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="score", numBins=0)
    assert areas.auc_roc == pytest.approx(judge.evaluate(rounded, {judge.metricName: "areaUnderROC"}), abs=1e-12)
    assert areas.auc_pr == pytest.approx(judge.evaluate(rounded, {judge.metricName: "areaUnderPR"}), abs=1e-12)


@pytest.mark.parametrize("size,partitions", [(1, 4), (2, 4), (3, 2), (12_000, 7)])
def test_points_thinned_like_a_plain_loop(spark, size, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    labels = [int((i * i) % 11 < 4 and i % 300 > 40) for i in range(size)]
    df = spark.createDataFrame([(i / 7 - 900, label) for i, label in enumerate(labels)], SCORED)
    thin = curves.roc_points(curves.threshold_table(df, "score", "label"), drop_collinear=True)
    plan = thin._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    down = sorted(((i / 7 - 900, label) for i, label in enumerate(labels)), reverse=True)
    kept = [t for i, (t, label) in enumerate(down) if i in (0, size - 1) or down[i + 1][1] != label]
    assert sorted(r.threshold for r in thin.collect() if r.threshold is not None) == sorted(kept)
    assert "_positives" not in plan or "windowspecdefinition(threshold" not in plan


def test_next_rows_reach_over_empty_slices(spark):
    df = spark.createDataFrame([(float(i), i * 10) for i in range(5)], "at double, value int").repartition(3)
    for descending in (False, True):
        got = {r.at: r.following for r in ranking.with_next(df, "at", {"following": "value"}, descending).collect()}
        step = -1 if descending else 1
        assert got == {float(i): (i + step) * 10 if 0 <= i + step < 5 else None for i in range(5)}


def test_areas_without_positives(spark):
    none = spark.createDataFrame([(0.1, 0), (0.2, 0)], SCORED)
    row = curves.area_under_curves(curves.threshold_table(none, "score", "label")).first()
    assert (row.auc_roc, row.auc_pr) == (None, None)


def test_confusion_matrix_has_all_cells(spark):
    df = spark.createDataFrame([(1, 1.0), (0, 0.0), (0, 0.0)], "label int, prediction double")
    got = {(r.label, r.prediction): r.n for r in curves.confusion_matrix(df, "label").collect()}
    assert got == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_classification_metrics(spark):
    df = spark.createDataFrame([(1, 1.0)] * 3 + [(0, 1.0)] * 5 + [(1, 0.0)] * 2 + [(0, 0.0)] * 9, "label int, prediction double")
    assert tuple(curves.classification_metrics(df, "label").first()) == (0.375, 0.6, 0.4615)
    nothing = spark.createDataFrame([(1, 0.0)], "label int, prediction double")
    assert tuple(curves.classification_metrics(nothing, "label").first()) == (0.0, 0.0, 0.0)
