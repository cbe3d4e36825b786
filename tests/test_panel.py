"""Panel, labels, default entries and events from written-out credits."""

import datetime

import pytest
from pyspark.sql import functions as F

from lendsight.operators import labels, panel

CREDITS = "credit_id string, client_id string, principal double, term_months int, grant_month int"


@pytest.fixture(scope="module")
def credits(spark):
    return spark.createDataFrame(
        [("A", "X", 1200.0, 12, 0), ("B", "Y", 2400.0, 48, 33), ("C", "X", 500.0, 5, 36), ("D", "Z", 500.0, 0, 3)], CREDITS
    )


def test_active_months_stop_at_the_horizon(credits):
    rows = panel.active_months(credits).collect()
    assert sorted((r.credit_id, r.month_index, r.months_elapsed) for r in rows) == [("A", i, i) for i in range(12)] + [
        ("B", 33 + i, i) for i in range(3)
    ]


def test_statement_dates(spark):
    months = spark.range(36).select(F.col("id").cast("int").alias("m"))
    calendar = [r[0] for r in months.select(panel.statement_date(F.col("m"))).collect()]
    assert calendar[13] == datetime.date(2023, 2, 1) and len({(d.year, d.month) for d in calendar}) == 36
    stepped = [r[0] for r in months.select(panel.statement_date(F.col("m"), thirty_day_steps=True)).collect()]
    assert stepped[1] == datetime.date(2022, 1, 31) and len({(d.year, d.month) for d in stepped}) == 34


def test_panel_rows(spark, credits):
    dpd = spark.createDataFrame(
        [("A", i, [0, 0, 10, 45, 95, 0, 0, 0, 0, 0, 0, 0][i]) for i in range(12)] + [("B", 33, 0), ("B", 34, 0), ("B", 35, 400)],
        "credit_id string, month_index int, dpd int",
    )
    rows = {(r.credit_id, r.month_index): r for r in panel.credit_panel(credits, dpd).collect()}
    assert len(rows) == 15
    assert [rows["A", i].stage for i in range(6)] == [1, 1, 1, 2, 3, 1]
    assert rows["A", 2].outstanding == 1000.0
    assert rows["A", 3].outstanding == 1050.0  # 1200 * (1 - (3 - 1.5) / 12)
    assert rows["B", 35].stage == 3 and rows["B", 35].statement_date == datetime.date(2024, 12, 1)


def test_clustering_does_not_change_the_panel(credits):
    dpd = (F.col("month_index") * 7) % 100
    plain, clustered = panel.credit_panel(credits, dpd), panel.credit_panel(credits, dpd, cluster=True)
    assert plain.exceptAll(clustered).isEmpty() and plain.count() == clustered.count()


def test_clustered_panel_needs_no_second_shuffle(credits):
    labelled = labels.default_labels(panel.credit_panel(credits, F.lit(0), cluster=True))
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


STAGES = {"A": [1, 2, 3, 1, 1, 1, 3], "B": [3, 3], "C": [1, 1, 1, 1, 1, 3]}


@pytest.fixture(scope="module")
def staged(spark):
    rows = [(c, "X", i, s) for c, stages in STAGES.items() for i, s in enumerate(stages)]
    return spark.createDataFrame(rows, "credit_id string, client_id string, month_index int, stage int")


@pytest.mark.parametrize("horizon", [1, 3, 6])
@pytest.mark.parametrize("drop_censored", [False, True])
def test_labels(staged, horizon, drop_censored):
    expected = {
        (c, i, int(3 in stages[i + 1 : i + 1 + horizon]))
        for c, stages in STAGES.items()
        for i, s in enumerate(stages)
        if s != 3 and (not drop_censored or i + horizon < len(stages))
    }
    got = labels.default_labels(staged, horizon, drop_censored=drop_censored).collect()
    assert {(r.credit_id, r.month_index, r[f"default_within_{horizon}"]) for r in got} == expected
    assert all(r.stage != 3 for r in got)


def test_default_entries(staged):
    got = {(r.credit_id, r.month_index) for r in labels.default_entries(staged).collect()}
    assert got == {("A", 2), ("A", 6), ("B", 0), ("C", 5)}


def test_instalment_events(spark, credits):
    clients = spark.createDataFrame([("X", "Togo"), ("Y", "Nowhere"), ("Z", "Mali")], "client_id string, country string")
    codes = spark.createDataFrame([("Togo", "TG"), ("Mali", "ML")], "country string, country_code string")
    dpd = F.when(F.col("month_index") % 3 == 0, 0).when(F.col("month_index") % 3 == 1, 10).otherwise(45)
    overdraft = F.when(F.col("month_index") == 34, 77.0).otherwise(0.0)
    built = panel.credit_panel(credits, dpd, overdraft)
    events = panel.instalment_events(built, credits, clients, codes).collect()
    assert len(events) == 15 + 1 and len({e.event_id for e in events}) == 16
    over = [e for e in events if e.kind == "overdraft"]
    assert [(e.credit_id, e.amount, e.due_status, e.year, e.month, e.country_code) for e in over] == [
        ("B", 77.0, None, 2024, 11, None)
    ]
    first = [e for e in events if e.credit_id == "A" and e.month == 1]
    assert [(e.amount, e.due_status, e.country_code, str(e.event_date)) for e in first] == [(100.0, "on_time", "TG", "2022-01-01")]
    assert {e.due_status for e in events if e.kind == "instalment"} == {"on_time", "late", "unpaid"}


def test_a_month_without_days_past_due_is_an_error(spark, credits):
    dpd = spark.createDataFrame([("A", i, 0) for i in range(12) if i != 4] + [("B", i, 0) for i in (33, 34, 35)], "credit_id string, month_index int, dpd int")
    with pytest.raises(Exception, match="no days past due for credit A in month 4"):
        panel.credit_panel(credits, dpd).collect()


def test_partitions_of_a_clustered_panel_by_argument(spark, credits):
    built = panel.credit_panel(credits, F.lit(0), cluster=5)
    assert built.rdd.getNumPartitions() == 5
