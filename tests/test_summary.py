"""Descriptive aggregates on written-out rows."""

import datetime

import pandas as pd
import pytest

from lendsight.operators import labels, summary

FEATURES = "credit_id string, period date, late_streak bigint, overdraft_ratio_3 double, incident_freq_6 double"
JAN, FEB = datetime.date(2023, 1, 1), datetime.date(2023, 2, 1)


@pytest.fixture(scope="module")
def features(spark):
    rows = [("A", JAN, 2, 0.5, 0.25), ("B", JAN, 1, 0.0, None), ("A", FEB, 3, 1.0, 0.125), ("C", FEB, 0, 1 / 3, 1 / 6), ("Z", FEB, 9, 1.0, 1.0)]
    return spark.createDataFrame(rows, FEATURES)


@pytest.fixture(scope="module")
def owners(spark):
    credits = spark.createDataFrame([("A", "X"), ("B", "X"), ("C", "Y"), ("D", "Y")], "credit_id string, client_id string")
    return credits, spark.createDataFrame([("X", "Togo"), ("Y", "Mali")], "client_id string, country string")


def test_risk_by_country_period(features, owners):
    expected = [("Mali", FEB, 1, 0.1667, 0.0, 0.3333), ("Togo", JAN, 2, 0.25, 1.5, 0.25), ("Togo", FEB, 1, 0.125, 3.0, 1.0)]
    for form in (summary.risk_by_country_period, summary.risk_by_country_period_sql):
        assert [tuple(r) for r in form(features, *owners).collect()] == expected


def test_sql_form_leaves_no_view_behind(spark, features, owners):
    before = spark.catalog.listTables()
    summary.risk_by_country_period_sql(features, *owners)
    assert spark.catalog.listTables() == before and not any(t.isTemporary for t in before)


def test_pivot(features, owners):
    by_country = summary.risk_by_country_period(features, *owners)
    names = summary.country_names(owners[1])
    assert names == sorted(names)
    pivot = summary.incident_pivot(by_country, names)
    assert [(r.period, r.Mali, r.Togo) for r in pivot.collect()] == [(JAN, None, 0.25), (FEB, 0.1667, 0.125)]
    with pytest.raises(Exception, match="country without a column: Togo"):
        summary.incident_pivot(by_country, ["Mali"]).collect()
    plan = summary.incident_pivot(summary.risk_cells(features, *owners), names)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") <= 1


def test_value_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], "v string")
    assert [tuple(r) for r in summary.value_counts(df, "v").collect()] == [("a", 1), ("c", 1), ("b", 2)]


def test_correlation_like_pandas(spark):
    pdf = pd.DataFrame({"up": [1, 2, 3, 4, 9.0], "down": [5, None, 2, 2, 1.0], "flat": [1.0] * 5, "y": [0, 0, 0, 1, 1]})
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    df = spark.createDataFrame(rows, "up double, down double, flat double, y int")
    got = {r.feature: r.correlation for r in summary.label_correlation(df, "y", ["up", "down", "flat"]).collect()}
    expected = pdf.corr()["y"]
    assert got["flat"] is None and list(got) == ["down", "up", "flat"]
    assert (got["up"], got["down"]) == (pytest.approx(expected["up"]), pytest.approx(expected["down"]))


def test_stage_share_prevalence_and_ever_default(spark):
    panel = spark.createDataFrame(
        [("A", JAN, 1), ("B", JAN, 2), ("C", JAN, 3), ("D", JAN, 1), ("A", FEB, 3), ("B", FEB, 1)],
        "credit_id string, statement_date date, stage int",
    )
    assert [tuple(r) for r in summary.stage_share(panel).collect()] == [(JAN, 50.0), (FEB, 50.0)]
    assert tuple(summary.ever_default_rate(panel).first()) == (4, 2, 0.5)
    known = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    assert tuple(summary.label_prevalence(panel, known, "y").first()) == (6, 4, 0.25)


def test_prevalence_in_one_pass(spark):
    rows = [("A", 0, 1), ("A", 1, None), ("A", 2, 3), ("B", 0, 2), ("B", 1, 1)]
    panel = spark.createDataFrame(rows, "credit_id string, month_index int, stage int")
    given = labels.default_labels(panel)
    assert sorted((r.credit_id, r.month_index, r.default_within_3) for r in given.collect()) == [("A", 0, 1), ("A", 1, 1), ("B", 0, 0), ("B", 1, 0)]
    assert tuple(summary.panel_prevalence(panel).first()) == tuple(summary.label_prevalence(panel, given, "default_within_3").first()) == (5, 4, 0.5)
    plan = summary.panel_prevalence(panel)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") == 1


def test_event_partitions(spark):
    df = spark.createDataFrame([("TG", 2022, 1), ("TG", 2022, 1), (None, 2022, 2)], "country_code string, year int, month int")
    got = {tuple(r) for r in summary.event_partitions(df).collect()}
    assert got == {("TG", 2022, 1, 2), (None, 2022, 2, 1)}


def test_facts_of_the_panel_from_one_scan(spark, tmp_path):
    rows = [("A", "2022-01-01", 1), ("A", "2022-02-01", 3), ("B", "2022-01-01", 2), ("B", "2022-02-01", None), ("C", None, 1), (None, "2022-02-01", 2)]
    spark.createDataFrame(rows, "credit_id string, statement_date string, stage int").write.parquet(str(tmp_path / "panel"))
    panel = spark.read.parquet(str(tmp_path / "panel"))
    facts = summary.panel_facts(panel)
    assert facts._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sorted(map(str, summary.stage_share_from(facts).collect())) == sorted(map(str, summary.stage_share(panel).collect()))
    assert summary.ever_default_rate_from(facts).collect() == summary.ever_default_rate(panel).collect()
    labels = spark.createDataFrame([(0,), (1,), (0,), (0,)], "default_within_3 int")
    assert summary.label_prevalence_from(facts, labels, "default_within_3").collect() == summary.label_prevalence(panel, labels, "default_within_3").collect()
    nothing = summary.panel_facts(panel.filter("false"))
    assert nothing.count() == 0 and summary.ever_default_rate_from(nothing).first().n_credits == 0
