"""Joins and windows on stored buckets, without shuffles."""

import shutil

import pytest
from pyspark.sql import functions as F

from lendsight.operators import model, state
from lendsight.plans import catalog, mapping
from lendsight.sources import buckets
from tests.test_features import same_rows


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_training_set_and_latest_state_meet_without_a_shuffle(spark, data, no_broadcast):
    training = catalog.QUERIES["training_set"](spark, data)
    plan = _plan(training)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    panel, features = mapping.stored_panel(spark, data), mapping.stored_features(spark, data)
    latest = state.latest_per_key(panel, "credit_id", "period", state.PANEL_STATE).join(
        state.latest_per_key(features, "credit_id", "period", state.FEATURE_STATE), "credit_id"
    )
    assert "SortMergeJoin" in _plan(latest) and "Exchange" not in _plan(latest)
    assert "Exchange" not in _plan(mapping.activity_labels(panel))


def test_buckets_hold_the_same_rows(spark, data):
    plain = mapping.activity_features(spark, data)
    stored = mapping.stored_features(spark, data)
    assert same_rows(plain, stored)
    panel = mapping.activity_panel(mapping._with_age(plain), mapping.activity_credits(spark, data))
    expected = model.training_set(plain, mapping.activity_labels(panel), grain=mapping.GRAIN)
    assert same_rows(expected, mapping.activity_training_set(spark, data))


def test_a_table_is_built_once_and_again_when_its_source_changes(spark, data, tmp_path):
    for name in ("events", "orders", "customer", "nation"):
        shutil.copy(f"{data}/{name}.parquet", tmp_path / f"{name}.parquet")
    built = []

    def build(n):
        return lambda: built.append(n) or spark.range(n).select((F.col("id") % 5).alias("credit_id"), F.col("id").alias("period"))

    first = buckets.stored_once(spark, str(tmp_path), "numbers", build(20))
    again = buckets.stored_once(spark, str(tmp_path), "numbers", build(30))
    assert built == [20] and same_rows(first, again)
    shutil.copy(f"{data}/region.parquet", tmp_path / "region.parquet")
    assert buckets.stored_once(spark, str(tmp_path), "numbers", build(40)).count() == 40
