"""State, scores, watch list, provisions and stress against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lendsight.operators import portfolio
from lendsight.operators.state import latest_per_key, portfolio_state

STATE = (
    "credit_id string, stage int, outstanding double, late_streak bigint, balance_avg_3 double, balance_avg_12 double, "
    "overdraft_ratio_3 double, incident_freq_6 double, client_id string, credit_type string, country string"
)
RATES = {1: 0.01, 2: 0.10, 3: 0.60}


def make_state(n, seed, hot_share=0.4):
    """Many credits share one and the same score."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        streak = 2 if rng.random() < hot_share else rng.randint(0, 7)
        country = rng.choice(["Togo", "Mali", "Niger", None])
        ratio = 0.0 if streak == 2 else rng.randint(0, 3) / 3
        rows.append(
            (f"C{i}", rng.randint(1, 3), float(rng.randint(0, 10**6)), streak, 50.0, 60.0, ratio, 0.0, f"K{i}", "Habitat", country)
        )
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_state(1500, 11)


@pytest.fixture(scope="module")
def state(spark, rows):
    return spark.createDataFrame(rows, STATE).repartition(6)


@pytest.fixture(scope="module")
def scores(state):
    return {r.credit_id: r.score for r in portfolio.score_table(state).collect()}


def loss(balance, stage):
    return round(balance * RATES[stage], 0)


def test_latest_state(spark):
    panel = spark.createDataFrame(
        [("A", 1, 1, 10.0), ("A", 3, 2, 30.0), ("A", 2, 3, 20.0), ("B", 9, 1, 1.0), ("C", 1, 1, 5.0)],
        "credit_id string, month_index int, stage int, outstanding double",
    )
    features = spark.createDataFrame(
        [("A", "2022-01", 0, 1.0, 2.0, 0.0, None), ("A", "2022-05", 4, 3.0, 4.0, 0.5, 0.25), ("C", "2022-01", 1, 7.0, 8.0, 0.0, 0.0)],
        "credit_id string, period string, late_streak bigint, balance_avg_3 double, balance_avg_12 double, "
        "overdraft_ratio_3 double, incident_freq_6 double",
    )
    credits = spark.createDataFrame([("A", "X", "Habitat"), ("B", "X", "Habitat")], "credit_id string, client_id string, credit_type string")
    clients = spark.createDataFrame([("X", "Togo")], "client_id string, country string")
    got = {r.credit_id: r for r in portfolio_state(panel, features, credits, clients).collect()}
    assert set(got) == {"A", "C"}
    assert tuple(got["A"]) == ("A", 2, 30.0, 4, 3.0, 4.0, 0.5, 0.25, "X", "Habitat", "Togo")
    assert got["C"].country is None and got["C"].credit_type is None
    assert latest_per_key(panel, "credit_id", "month_index", ["stage"]).count() == 3


def test_overview_adds_up(state, rows, scores):
    row = portfolio.overview(state).first()
    assert row.n_credits == len(rows) == row.n_low + row.n_medium + row.n_high
    assert row.n_high == sum(s >= 0.6 for s in scores.values())
    assert row.total_ecl == sum(loss(r[2], r[1]) for r in rows)


def test_loss_by_country_leaves_out_unknown(state, rows):
    got = portfolio.loss_by_country(state).collect()
    expected = {}
    for r in rows:
        if r[10]:
            n, total = expected.get(r[10], (0, 0.0))
            expected[r[10]] = (n + 1, total + loss(r[2], r[1]))
    assert {r.country: (r.n_credits, r.ecl) for r in got} == expected
    assert [r.ecl for r in got] == sorted((r.ecl for r in got), reverse=True)


def test_empty_portfolio(state):
    row = portfolio.overview(state.limit(0)).first()
    assert (row.n_credits, row.n_low, row.total_ecl) == (0, 0, 0.0)


@pytest.mark.parametrize("limit", [1, 100, 5000])
def test_watch_list(state, scores, limit):
    expected = sorted((-s, c) for c, s in scores.items() if s >= 0.3)[:limit]
    got = [(-r.score, r.credit_id) for r in portfolio.watch_list(state, limit).collect()]
    assert got == expected


def test_credit_score(state, scores):
    row = portfolio.credit_score(state, "C42").first()
    assert (row.credit_id, row.score) == ("C42", scores["C42"])
    assert portfolio.credit_score(state, "nobody").isEmpty()


def test_credit_scores(spark, state, scores):
    wanted = spark.createDataFrame([("C1",), ("C2",), ("nobody",)], "credit_id string")
    assert {r.credit_id: r.score for r in portfolio.credit_scores(state, wanted).collect()} == {c: scores[c] for c in ("C1", "C2")}


def test_display_headings(state):
    shown = portfolio.watch_list_display(portfolio.watch_list(state), {"credit_id": "No.", "stage": "Stage (IFRS 9)"})
    assert shown.columns == ["No." if c == "credit_id" else "Stage (IFRS 9)" if c == "stage" else c for c in portfolio.WATCH_LIST_COLUMNS]


def brute_force(rows, scores, part):
    ranked = sorted(rows, key=lambda r: (-(scores[r[0]] if scores[r[0]] is not None else -1), r[0]))
    k = math.floor(len(rows) * part)
    before = sum(loss(r[2], r[1]) for r in rows)
    after = sum(loss(r[2], min(r[1] + 1, 3) if i < k else r[1]) for i, r in enumerate(ranked))
    return {r[0] for r in ranked[:k]}, before, after


@pytest.mark.parametrize("part", [0.0, 0.001, 0.1, 0.29, 0.5, 0.77, 0.999, 1.0])
def test_stress_picks_exactly_the_riskiest_share(state, rows, scores, part):
    scored = portfolio.with_score(state)
    chosen, before, after = brute_force(rows, scores, part)
    picked = scored.filter(portfolio.riskiest_share(scored, part)).select("credit_id").collect()
    assert {r.credit_id for r in picked} == chosen
    row = portfolio.provision_stress(scored, part).first()
    assert (row.n_downgraded, row.ecl_before, row.ecl_after) == (len(chosen), before, after)
    assert row.variation_pct == pytest.approx((after - before) / before * 100, abs=0.005)


def test_stress_is_monotone(state):
    scored = portfolio.with_score(state)
    changes = [portfolio.provision_stress(scored, p).first().variation_pct for p in (0.0, 0.2, 0.4, 0.9)]
    assert changes[0] == 0 and changes == sorted(changes)


def test_stress_when_all_scores_are_equal_or_unknown(spark):
    for score in (0.5, None):
        rows = [(f"C{i}", 1, 1000.0) for i in range(300)]
        scored = spark.createDataFrame(rows, "credit_id string, stage int, outstanding double").withColumn(
            "score", F.lit(score).cast("double")
        )
        row = portfolio.provision_stress(scored, 0.29).first()
        assert (row.n_downgraded, row.ecl_before, row.ecl_after) == (87, 3000.0, 3000.0 + 87 * 90)


def test_unknown_scores_rank_last(spark):
    scored = spark.createDataFrame(
        [("A", None, 1, 100.0), ("B", 0.0, 1, 100.0), ("C", 0.4, 1, 100.0), ("D", None, 1, 100.0)],
        "credit_id string, score double, stage int, outstanding double",
    )
    for part, size in ((0.5, 2), (0.75, 3)):
        picked = {r.credit_id for r in scored.filter(portfolio.riskiest_share(scored, part)).collect()}
        assert {"B", "C"} <= picked and len(picked) == size


@pytest.mark.parametrize("part", [-0.1, 1.01, float("nan")])
def test_stress_rejects_a_share_outside_zero_to_one(state, part):
    with pytest.raises(ValueError):
        portfolio.riskiest_share(portfolio.with_score(state), part)


@pytest.mark.parametrize("distinct", [997, 7, 1])
def test_stress_of_scores_that_are_not_rounded(spark, distinct):
    rows = [(f"C{i:04d}", 1 + i % 3, 1000.0 + i, ((i * 7919) % distinct) / 997) for i in range(1000)]
    scored = spark.createDataFrame(rows, "credit_id string, stage int, outstanding double, score double")
    chosen, before, after = brute_force(rows, {r[0]: r[3] for r in rows}, 0.37)
    row = portfolio.provision_stress(scored, 0.37).first()
    assert (row.n_downgraded, row.ecl_before, row.ecl_after) == (len(chosen), before, after)


def test_stress_sorts_and_stores_no_rows(spark, tmp_path, rows, monkeypatch):
    stored = str(tmp_path / "scored")
    spark.createDataFrame([(r[0], r[1], r[2], 0.5) for r in rows], "credit_id string, stage int, outstanding double, score double").write.parquet(stored)
    scored = spark.read.parquet(stored)
    monkeypatch.setattr("lendsight.session.materialise", None)
    plan = scored.filter(portfolio.riskiest_share(scored, 0.3))._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "Window" not in plan


def test_stress_on_nothing(state):
    empty = portfolio.with_score(state.limit(0))
    row = portfolio.provision_stress(empty, 0.5).first()
    assert (row.n_downgraded, row.ecl_before, row.ecl_after, row.variation_pct) == (0, 0.0, 0.0, 0.0)
