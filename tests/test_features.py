"""Activity and behavioural features on a written-out scenario and on random events."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from lendsight.operators import activity, behaviour

SCHEMA = "event_id string, kind string, credit_id string, event_date date, amount double, due_status string"


def day(text):
    return datetime.date.fromisoformat(text)


# Credit A: on time, late, unpaid, (no instalment in April), missing status, unpaid, late.
# Credit B: one late month with a second, later instalment that must not count.
SCENARIO = [
    ("a1", "instalment", "A", day("2023-01-04"), 250.0, "on_time"),
    ("a2", "movement", "A", day("2023-01-11"), 900.0, None),
    ("a3", "movement", "A", day("2023-01-25"), -300.0, None),
    ("a4", "instalment", "A", day("2023-02-04"), 250.0, "late"),
    ("a5", "movement", "A", day("2023-02-05"), -150.5, None),
    ("a6", "overdraft", "A", day("2023-02-07"), 40.0, None),
    ("a7", "enquiry", "A", day("2023-02-08"), 0.0, None),
    ("a8", "instalment", "A", day("2023-03-04"), 250.0, "unpaid"),
    ("a9", "movement", "A", day("2023-04-09"), 5000.0, None),
    ("a10", "instalment", "A", day("2023-05-04"), 250.0, None),
    ("a11", "movement", "A", day("2023-05-06"), 50.5, None),
    ("a12", "instalment", "A", day("2023-06-04"), 250.0, "unpaid"),
    ("a13", "instalment", "A", day("2023-07-04"), 250.0, "late"),
    ("a14", "overdraft", "A", day("2023-07-05"), 10.0, None),
    ("b2", "instalment", "B", day("2023-03-20"), 80.0, "unpaid"),
    ("b1", "instalment", "B", day("2023-03-02"), 70.0, "late"),
    ("b3", "movement", "B", day("2023-03-03"), -20.0, None),
]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(SCENARIO, SCHEMA)


@pytest.fixture(scope="module")
def features(events):
    rows = behaviour.behaviour_features(events).collect()
    return {(r.credit_id, r.period.strftime("%Y-%m")): r for r in rows}


def test_months_without_instalment_disappear(features):
    assert sorted(features) == [("A", m) for m in ("2023-01", "2023-02", "2023-03", "2023-05", "2023-06", "2023-07")] + [
        ("B", "2023-03")
    ]


def test_late_streak(features):
    streaks = [features["A", m].late_streak for m in ("2023-01", "2023-02", "2023-03", "2023-05", "2023-06", "2023-07")]
    assert streaks == [0, 1, 2, 0, 1, 2]


def test_balance_leaves_out_lost_months(features):
    balances = [features["A", m].balance for m in ("2023-01", "2023-02", "2023-03", "2023-05", "2023-06", "2023-07")]
    assert balances == [600.0, 449.5, 449.5, 500.0, 500.0, 500.0]
    assert features["A", "2023-01"].balance_avg_3 == 600.0
    assert features["A", "2023-03"].balance_avg_3 == pytest.approx((600 + 449.5 + 449.5) / 3)
    assert features["A", "2023-06"].balance_avg_3 == pytest.approx((449.5 + 500 + 500) / 3)
    assert features["A", "2023-07"].balance_avg_6 == pytest.approx((600 + 449.5 * 2 + 1500) / 6)


def test_overdraft_ratio(features):
    assert features["A", "2023-01"].overdraft_ratio_3 == 0
    assert features["A", "2023-02"].overdraft_ratio_3 == 0.5
    assert features["A", "2023-05"].overdraft_ratio_3 == pytest.approx(1 / 3)
    assert features["A", "2023-06"].overdraft_ratio_3 == 0


def test_incident_frequency_skips_missing_status(features):
    assert features["A", "2023-03"].incident_freq_6 == pytest.approx(1 / 3)
    assert features["A", "2023-05"].incident_freq_6 == pytest.approx(1 / 3)
    assert features["A", "2023-06"].incident_freq_6 == 0.5
    assert features["A", "2023-07"].incident_freq_6 == pytest.approx(2 / 5)


def test_first_instalment_of_a_month_counts(events, features):
    assert features["B", "2023-03"].due_status == "late"
    row = activity.period_activity(events).filter("credit_id = 'B'").first()
    assert (row.due_amount, row.net_movement, row.overdraft_amount) == (70.0, -20.0, 0.0)


def test_unknown_status_counts_as_late_but_not_unpaid(spark):
    rows = [("x", "instalment", "C", day("2023-01-01"), 5.0, "disputed")]
    row = behaviour.behaviour_features(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row.due_status, row.late_streak, row.incident_freq_6) == ("disputed", 1, 0.0)


def test_unknown_status_is_an_error_where_only_known_ones_are_expected(spark):
    rows = [("x", "instalment", "C", day("2023-01-01"), 5.0, "disputed")]
    with pytest.raises(Exception, match="unknown status of an instalment: disputed"):
        activity.period_activity(spark.createDataFrame(rows, SCHEMA), known_only=True).collect()
    plan = activity.period_activity(spark.createDataFrame(rows, SCHEMA), known_only=True)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_status_of_the_first_instalment_is_kept_among_known_and_unknown_ones(spark):
    rows = [
        ("a", "instalment", "C", day("2023-01-03"), 5.0, "disputed"), ("b", "instalment", "C", day("2023-01-02"), 6.0, "late"),
        ("c", "instalment", "C", day("2023-02-01"), 7.0, "waived"), ("d", "instalment", "C", day("2023-02-02"), 8.0, None),
    ]
    for form in (activity.period_activity, activity.period_activity_joined):
        got = form(spark.createDataFrame(rows, SCHEMA)).orderBy("period").collect()
        assert [(r.due_status, r.due_amount) for r in got] == [("late", 6.0), ("waived", 7.0)]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_a_duplicated_event_with_another_amount_gives_one_answer(spark, partitions):
    rows = [("x", "instalment", "C", day("2023-01-01"), float(a), "late") for a in (50, 20, 90, 30)]
    events = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    for known_only in (True, False):
        assert activity.period_activity(events, known_only=known_only).first().due_amount == 20.0


def test_instalments_without_an_order_key_come_last_and_wide_keys_are_errors(spark):
    rows = [("1", "instalment", "C", day("2023-01-01"), 5.0, "late"), (None, "instalment", "C", day("2023-01-01"), 1.0, "unpaid"),
            (None, "instalment", "D", day("2023-01-01"), 2.0, "unpaid")]
    events = spark.createDataFrame(rows, SCHEMA)
    got = {r.credit_id: r.due_amount for r in activity.period_activity(events, order_by=F.col("event_id").cast("bigint")).collect()}
    assert got == {"C": 5.0, "D": 2.0}
    for wide in (2**60, -1):
        with pytest.raises(Exception, match="order key outside"):
            activity.period_activity(events, order_by=F.lit(wide)).collect()


def test_large_amounts_are_summed_exactly(spark):
    rows = [("a", "instalment", "C", day("2023-01-01"), 2e15, "late"), ("b", "movement", "C", day("2023-01-02"), 3e17, None),
            ("c", "movement", "C", day("2023-01-03"), 9e16, None), ("d", "movement", "C", day("2023-01-04"), -3e17, None)]
    row = activity.period_activity(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row.due_amount, row.net_movement) == (2e15, 9e16)


def test_all_statuses_missing_gives_null_frequency(spark):
    rows = [("x", "instalment", "C", day("2023-01-01"), 5.0, None)]
    row = behaviour.behaviour_features(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row.late_streak, row.incident_freq_6) == (0, None)


def random_events(n, credits, seed=3, hot_share=0.0):
    rng = random.Random(seed)
    kinds = ["instalment", "movement", "movement", "overdraft", "enquiry"]
    rows = []
    for i in range(n):
        kind = rng.choice(kinds)
        credit = "hot" if rng.random() < hot_share else f"C{rng.randrange(credits)}"
        status = rng.choice(["on_time", "late", "unpaid", None]) if kind == "instalment" else None
        date = datetime.date(2022, 1, 1) + datetime.timedelta(days=rng.randrange(900))
        rows.append((f"E{i}", kind, credit, date, round(rng.uniform(-500, 500), 2), status))
    return rows


@pytest.fixture(scope="module")
def many(spark):
    return spark.createDataFrame(random_events(6000, 40, hot_share=0.35), SCHEMA).repartition(7)


def same_rows(left, right):
    columns = left.columns
    return left.exceptAll(right.select(columns)).isEmpty() and right.select(columns).exceptAll(left).isEmpty()


@pytest.mark.parametrize("grain", ["month", "day"])
def test_one_scan_equals_three_joined_aggregates(many, grain):
    assert same_rows(activity.period_activity(many, grain), activity.period_activity_joined(many, grain))


def test_streak_equals_rank_in_run(many):
    daily = activity.period_activity(many, "day")
    runs = behaviour.with_status_islands(behaviour.with_late_streak(daily))
    by_run = F.when(F.coalesce(F.col("due_status") != "on_time", F.lit(False)), F.col("island_rank")).otherwise(0)
    assert runs.filter(F.col("late_streak") != by_run).isEmpty()


def test_partitioning_does_not_change_features(many):
    features = behaviour.behaviour_features(many)
    assert same_rows(features, behaviour.behaviour_features(many.orderBy(F.rand(1)).repartition(3)))


def test_features_equal_a_plain_loop(many):
    statuses = {(r.credit_id, r.period): r.due_status for r in activity.period_activity(many).collect()}
    rows = {}
    for r in many.collect():
        if r.kind != "enquiry":
            rows.setdefault((r.credit_id, r.event_date.replace(day=1)), []).append(r)
    expected = {}
    for credit in {c for c, _ in rows}:
        history, balance, streak = [], 0, 0
        for period in sorted(p for c, p in rows if c == credit):
            due = [r for r in rows[credit, period] if r.kind == "instalment"]
            if not due:
                continue
            status = statuses[credit, period]
            assert status in {r.due_status for r in due}
            balance += sum(round(r.amount * 100) for r in rows[credit, period] if r.kind == "movement")
            streak = streak + 1 if status in ("late", "unpaid") else 0
            over = sum(round(r.amount * 100) for r in rows[credit, period] if r.kind == "overdraft") > 0
            history.append((status, balance, over))
            known = [s == "unpaid" for s, _, _ in history[-6:] if s is not None]
            mean = lambda n: sum(b for _, b, _ in history[-n:]) / (100 * len(history[-n:]))
            expected[credit, period] = (
                status, streak, balance / 100, mean(3), mean(6), mean(12),
                sum(o for _, _, o in history[-3:]) / len(history[-3:]),
                sum(known) / len(known) if known else None,
            )
    actual = {(r.credit_id, r.period): tuple(r)[2:] for r in behaviour.behaviour_features(many).collect()}
    assert actual == expected


def test_invariants(many):
    features = behaviour.behaviour_features(many)
    bad = features.filter(
        "late_streak < 0 or not overdraft_ratio_3 between 0 and 1 or not coalesce(incident_freq_6, 0) between 0 and 1"
    )
    assert bad.isEmpty()
    assert features.groupBy("credit_id", "period").count().filter("count > 1").isEmpty()


def test_one_shuffle_per_key_and_partial_sums(many):
    plan = behaviour.behaviour_features(many, known_only=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(credit_id") == 2  # (credit, period) for the sums, credit for all windows
    assert "SortAggregate" not in plan and "partial_min" in plan
    assert plan.count("Sort [credit_id") == 1
