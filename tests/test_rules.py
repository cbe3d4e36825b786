"""Every credit rule on hand-written inputs."""

import random

import pytest
from pyspark.sql import functions as F

from lendsight.functions import keys, rules


def values(spark, rows, schema, expression):
    """The expression on each row, in row order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"i int, {schema}")
    return [r.v for r in df.select("i", expression.alias("v")).orderBy("i").collect()]


def test_stage_from_dpd(spark):
    rows = [(0,), (29,), (30,), (89,), (90,), (400,), (None,)]
    assert values(spark, rows, "dpd int", rules.stage_from_dpd(F.col("dpd"))) == [1, 1, 2, 2, 3, 3, None]


def test_due_status_from_dpd(spark):
    rows = [(0,), (1,), (29,), (30,), (90,), (None,)]
    assert values(spark, rows, "dpd int", rules.due_status_from_dpd(F.col("dpd"))) == [
        "on_time", "late", "late", "unpaid", "unpaid", None,
    ]


def test_instalment_amount_rounds_half_to_even(spark):
    rows = [(1000.0, 12), (5.0, 2), (7.0, 2)]
    assert values(spark, rows, "p double, d int", rules.instalment_amount(F.col("p"), F.col("d"))) == [83.0, 2.0, 4.0]


def test_outstanding_balance(spark):
    rule = rules.outstanding_balance(F.col("p"), F.col("d"), F.col("m"), F.col("dpd"))
    rows = [
        (1e6, 12, 0, 0), (1e6, 12, 12, 0), (1e6, 12, 6, 0), (1e6, 12, 6, 10), (1e6, 12, 6, 45),
        (1e6, 12, 0, 45),  # arrears on top of the whole principal
        (1e6, 12, 30, 90),  # never negative
    ]
    assert values(spark, rows, "p double, d int, m int, dpd int", rule) == [1e6, 0.0, 5e5, 5e5, 625000.0, 1125000.0, 0.0]


def test_expected_loss(spark):
    rule = rules.expected_loss(F.col("b"), F.col("s"))
    assert values(spark, [(1000.0, 1), (1000.0, 2), (1000.0, 3), (2000.0, 3)], "b double, s int", rule) == [10.0, 100.0, 600.0, 1200.0]
    for stage in (0, 4, None):
        with pytest.raises(Exception, match="no provision rate"):
            values(spark, [(1000.0, stage)], "b double, s int", rule)


def test_downgraded_stage(spark):
    assert values(spark, [(1,), (2,), (3,)], "s int", rules.downgraded_stage(F.col("s"))) == [2, 3, 3]


def test_entered_default(spark):
    rule = rules.entered_default(F.col("a"), F.col("b"))
    assert values(spark, [(2, 3), (1, 3), (1, 2), (3, 3), (3, 2)], "a int, b int", rule) == [True, True, False, False, False]


def test_balance_trend_subscore(spark):
    rule = rules.balance_trend_subscore(F.col("a"), F.col("b"))
    rows = [(50.0, 100.0), (75.0, 100.0), (10.0, 100.0), (100.0, 100.0), (120.0, 100.0), (-10.0, 0.0), (-30.0, -10.0)]
    assert values(spark, rows, "a double, b double", rule) == [1.0, 0.5, 1.0, 0.0, 0.0, 0.0, 0.0]


SCORE = "streak bigint, b3 double, b12 double, overdraft double, incident double"


def score():
    return rules.risk_score(*[F.col(c) for c in ("streak", "b3", "b12", "overdraft", "incident")])


def test_risk_score(spark):
    rows = [
        (0, 100.0, 100.0, 0.0, 0.0),
        (6, 10.0, 100.0, 1.0, 1.0),
        (60, -500.0, 100.0, 3.0, 3.0),
        (3, 100.0, 100.0, 0.0, 0.0),
        (0, 75.0, 100.0, 0.0, 0.0),
        (0, 100.0, 100.0, 1 / 3, 0.5),
        (0, 100.0, 100.0, 0.0, None),
    ]
    assert values(spark, rows, SCORE, score()) == [0.0, 1.0, 1.0, 0.175, 0.125, 0.1667, None]


def test_risk_score_equals_plain_arithmetic(spark):
    rng = random.Random(5)
    rows = [
        (rng.randint(0, 9), rng.uniform(-100, 900), rng.uniform(-100, 900), rng.randint(0, 3) / 3, rng.randint(0, 6) / 6)
        for _ in range(3000)
    ]

    def plain(streak, b3, b12, overdraft, incident):
        trend = min((b3 - b12) / abs(b12) / -0.5, 1.0) if b12 > 0 and b3 < b12 else 0.0
        return round(0.35 * min(streak / 6, 1.0) + 0.25 * trend + 0.2 * overdraft + 0.2 * incident, 4)

    assert values(spark, rows, SCORE, score()) == [plain(*row) for row in rows]


def test_alert_level(spark):
    rows = [(0.1,), (0.2999,), (0.3,), (0.5999,), (0.6,), (1.0,), (None,)]
    assert values(spark, rows, "s double", rules.alert_level(F.col("s"))) == [
        "low", "low", "medium", "medium", "high", "high", "low",
    ]


def test_variation_pct(spark):
    rule = rules.variation_pct(F.col("a"), F.col("b"))
    assert values(spark, [(100.0, 150.0), (3.0, 4.0), (0.0, 10.0)], "a double, b double", rule) == [50.0, 33.33, 0.0]


def test_clipped_rate(spark):
    rows = [(3.0,), (99.0,), (12.3456,), (None,)]
    assert values(spark, rows, "r double", rules.clipped_rate(F.col("r"), 5, 24)) == [5.0, 24.0, 12.35, None]


def test_period_keys(spark):
    day = F.col("d").cast("date")
    rows = [("2022-03-31",), ("2022-04-01",)]
    assert values(spark, rows, "d string", keys.period_label(keys.period_of(day))) == ["2022-03", "2022-04"]
    assert values(spark, rows, "d string", keys.period_label(keys.period_of(day, "day"), "day")) == ["2022-03-31", "2022-04-01"]
    back = keys.period_from_label(keys.period_label(keys.period_of(day)))
    assert [str(v) for v in values(spark, rows, "d string", back)] == ["2022-03-01", "2022-04-01"]
    with pytest.raises(ValueError):
        keys.period_of(day, "week")


def test_stable_id_and_bucket(spark):
    rows = [("C1", 1), ("C1", 2), ("C1", 1)]
    ids = values(spark, rows, "c string, m int", keys.stable_id("EVT", F.col("c"), F.col("m")))
    assert ids[0] == ids[2] != ids[1] and all(i.startswith("EVT") and len(i) == 35 for i in ids)
    buckets = values(spark, [(f"C{i}",) for i in range(2000)], "c string", keys.split_bucket(F.col("c")))
    assert set(buckets) <= set(range(100)) and 0.7 < sum(b < 75 for b in buckets) / 2000 < 0.8


def test_cents_are_exact(spark):
    rows = [(29.27,), (-0.07,), (1.005,), (1e12,), (2e30,)]
    assert values(spark, rows, "a double", keys.cents(F.col("a"))) == [2927, -7, 100, 10**14, 2 * 10**32]
