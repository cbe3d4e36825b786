"""Features month by month against one run over everything, unusual statuses as numbers, and the job's folders."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from lendsight import schemas
from lendsight.functions.keys import cents
from lendsight.jobs import feature_job
from lendsight.operators import activity, behaviour, incremental
from lendsight.session import materialise
from lendsight.sources import folders, sinks, tables
from tests.test_features import SCHEMA, day, random_events, same_rows


@pytest.fixture(scope="module")
def many(spark):
    return materialise(activity.period_activity(spark.createDataFrame(random_events(3000, 30, hot_share=0.3), SCHEMA)), "activity")


def _month(number):
    return datetime.date(2022 + number // 12, number % 12 + 1, 1)


@pytest.mark.parametrize("cuts", [[*range(0, 14), 31], [0, 31]])
def test_parts_equal_one_run(many, cuts):
    cuts = list(cuts)
    state, parts = incremental.no_state(many), None
    for a, b in zip(cuts, cuts[1:]):
        new = many.filter(F.col("period").between(_month(a), _month(b - 1)))
        rows = materialise(incremental.continued(new, state), "rows")
        features, state = incremental.new_features(rows), materialise(incremental.new_state(rows), "state")
        parts = features if parts is None else parts.unionAll(features)
    assert same_rows(behaviour.features_from_activity(many), parts)
    assert state.count() == many.select("credit_id").distinct().count()
    longest = many.groupBy("credit_id").count().agg(F.max("count")).first()[0]
    assert state.agg(F.max(F.size("recent"))).first()[0] == min(longest, incremental.KEPT)


def test_one_shuffle_and_one_sort(many):
    plan = incremental.continued(many, incremental.no_state(many))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1


def test_a_row_before_the_state_is_an_error(many):
    rows = materialise(incremental.continued(many, incremental.no_state(many)), "rows")
    again = many.filter(F.col("period") == _month(3))
    with pytest.raises(Exception, match="a row is not after the state of credit"):
        incremental.continued(again, incremental.new_state(rows)).collect()


ODD = [
    ("a", "instalment", "C", day("2023-01-03"), 5.0, "disputed"), ("b", "instalment", "C", day("2023-01-02"), 6.0, "late"),
    ("c", "instalment", "C", day("2023-02-01"), 7.0, "waived"), ("d", "instalment", "C", day("2023-02-02"), 8.0, None),
    ("e", "instalment", "D", day("2023-02-02"), 9e16, "é'x"), ("f", "instalment", "E", day("2023-02-02"), -9e16, ""),
    ("g", "movement", "E", day("2023-02-03"), 4.0, "never counted"),
]


def test_listed_statuses_equal_texts(spark):
    events = spark.createDataFrame(ODD, SCHEMA)
    statuses = activity.unusual_statuses(events)
    assert statuses == ["", "disputed", "waived", "é'x"]
    listed = activity.period_activity(events, statuses=statuses)
    assert same_rows(activity.period_activity(events), listed)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    with pytest.raises(Exception, match="unknown status of an instalment: waived"):
        activity.period_activity(events, statuses=["disputed", "", "é'x"]).collect()
    with pytest.raises(Exception, match="unknown status"):
        activity.period_activity(events, statuses=[]).collect()


def test_as_many_statuses_as_there_are_codes(spark):
    most = activity.MOST_STATUSES
    events = spark.range(most).select(
        F.col("id").cast("string").alias("event_id"), F.lit("instalment").alias("kind"), (F.col("id") % 50).alias("credit_id"),
        F.lit(day("2023-01-31")).alias("event_date"), F.col("id").cast("double").alias("amount"),
        F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 4, "0")).alias("due_status"),
    )
    listed = activity.period_activity(events, order_by=F.lit(2**60 - 2) - F.col("event_id").cast("bigint"), statuses=activity.unusual_statuses(events))
    got = {r.credit_id: (r.due_status, r.due_amount) for r in listed.collect()}
    last = {c: max(i for i in range(most) if i % 50 == c) for c in range(50)}
    assert got == {c: (f"s{i:04d}", float(i)) for c, i in last.items()}
    with pytest.raises(ValueError, match="more than"):
        activity.unusual_statuses(events.unionAll(events.limit(1).withColumn("due_status", F.lit("one more"))))


@pytest.fixture()
def event_folder(tmp_path):
    """Events of five months as JSON lines, some of them no events."""
    kinds = {ours: theirs for theirs, ours in schemas.EVENT_KINDS.items()}
    statuses = {ours: theirs for theirs, ours in schemas.DUE_STATUSES.items()}
    root = tmp_path / "events"
    for i, (event, kind, credit, date, amount, status) in enumerate(random_events(900, 12, seed=8)):
        date = datetime.date(2022, 1 + date.month % 5, min(date.day, 28))
        folder = root / f"pays_code=TG/annee=2022/mois={date.month:02d}"
        folder.mkdir(parents=True, exist_ok=True)
        fields = {
            "event_id": event, "event_type": kinds[kind], "credit_id": credit, "client_id": "X", "date_evenement": date.isoformat(),
            "montant_fcfa": amount, "statut": "contested" if i % 9 == 0 and status else statuses.get(status),
        }
        with open(folder / "part.json", "a") as out:
            out.write(json.dumps(fields) + ("\n{broken\n" if i % 100 == 0 else "\n"))
    return str(root)


def _months(n):
    return [f"2022-{m:02d}" for m in range(1, n + 1)]


def test_months_appended_by_the_job_equal_one_run(spark, event_folder, tmp_path):
    whole, parts, states = (str(tmp_path / n) for n in ("whole", "parts", "states"))
    feature_job.run(spark, event_folder, whole)
    expected = tables.read_features(spark, whole)
    assert expected.filter("due_status = 'contested'").count() > 0
    for month in _months(5):
        feature_job.run(spark, event_folder, parts, from_month=month, to_month=month, state=states)
    assert same_rows(expected, tables.read_features(spark, parts))
    assert folders.partition_values(spark, states, schemas.STATE_FOLDER) == _months(5)
    # From a month in the middle to the newest: earlier months stay on disk as they are.
    kept = {p: p.stat().st_mtime_ns for m in _months(3) for p in (tmp_path / "parts" / f"annee_mois={m}").iterdir()}
    feature_job.run(spark, event_folder, parts, from_month="2022-04", state=states)
    assert same_rows(expected, tables.read_features(spark, parts))
    assert all(p.stat().st_mtime_ns == t for p, t in kept.items())
    assert folders.partition_values(spark, states, schemas.STATE_FOLDER) == [*_months(3), "2022-05"]
    # The whole table again, with a state from which months can be appended.
    feature_job.run(spark, event_folder, parts, state=states)
    assert folders.partition_values(spark, states, schemas.STATE_FOLDER) == ["2022-05"]


def test_runs_that_would_spoil_the_table_are_refused(spark, event_folder, tmp_path):
    table, states = str(tmp_path / "table"), str(tmp_path / "states")
    feature_job.run(spark, event_folder, table, state=states)
    before = sorted(tables.read_features(spark, table).collect())
    with pytest.raises(ValueError, match="needs a folder for the state"):
        feature_job.run(spark, event_folder, table, from_month="2022-03")
    with pytest.raises(ValueError, match="a table of their own"):
        feature_job.run(spark, event_folder, table, countries=["TG"])
    with pytest.raises(ValueError, match="rest on those of this run"):
        feature_job.run(spark, event_folder, table, to_month="2022-03", state=states)
    with pytest.raises(ValueError, match="no state is stored after the month 2022-02; run from 2022-01 on"):
        feature_job.run(spark, event_folder, table, from_month="2022-03", state=states)
    assert sorted(tables.read_features(spark, table).collect()) == before


def test_months_that_lost_their_events_go(spark, tmp_path):
    table, states = str(tmp_path / "table"), str(tmp_path / "states")
    rows = [(f"e{m}", "instalment", "C", datetime.date(2022, m, 3), 5.0, "late") for m in (1, 2, 3)]
    feature_job.append_features(spark.createDataFrame(rows, SCHEMA), table, states)
    feature_job.append_features(spark.createDataFrame(rows[:1], SCHEMA), table, states)
    assert [r.late_streak for r in tables.read_features(spark, table).collect()] == [1]
    assert folders.partition_values(spark, table, schemas.FEATURE_FOLDER) == ["2022-01"]


def test_rejected_lines_take_no_second_read(spark, event_folder, tmp_path):
    lines = tables.read_event_lines(spark, event_folder)
    good, bad = tables.split_lines(lines)
    read = {path for df in (good, bad) for path in df.inputFiles()}
    assert read and not any(path.startswith(f"file://{event_folder}") or event_folder in path for path in read)
    assert same_rows(tables.rejected_events(lines), bad) and bad.count() == 9
    assert same_rows(tables.events_from_lines(lines), tables.events_from_lines(good))
    counts = feature_job.run(spark, event_folder, str(tmp_path / "f"), rejected=str(tmp_path / "r"))
    assert counts["lines"] == 909 and counts["rejected"] == 9 == spark.read.text(str(tmp_path / "r")).count()


def test_state_of_a_credit_with_a_number(spark, tmp_path):
    table, states = str(tmp_path / "table"), str(tmp_path / "states")
    rows = [(f"e{m}", "instalment", 7, datetime.date(2022, m, 3), 5.0, "late") for m in (1, 2)]
    for m, row in enumerate(rows, 1):
        event = spark.createDataFrame([row], SCHEMA.replace("credit_id string", "credit_id long"))
        feature_job.append_features(event, table, states, f"2022-0{m}", f"2022-0{m}")
    assert sorted(r.late_streak for r in tables.read_features(spark, table).collect()) == [1, 2]


def test_stored_state(spark, many, tmp_path):
    rows = materialise(incremental.continued(many, incremental.no_state(many)), "rows")
    sinks.write_window_state(incremental.new_state(rows), str(tmp_path / "s"), "2024-06")
    stored, month = tables.read_window_state(spark, str(tmp_path / "s"))
    assert month == "2024-06" and same_rows(incremental.new_state(rows), stored)
    assert tables.read_window_state(spark, str(tmp_path / "s"), before="2024-06")[1] is None


def test_features_take_no_loop_over_frames(many):
    """Means come from running totals, the first instalment from a BIGINT: work per row does not grow with the spans."""
    plan = incremental.continued(many, incremental.no_state(many))._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "aggregate(" not in plan
    frames = [part.split(")")[0] for part in plan.split("specifiedwindowframe(RowFrame, ")[1:]]
    assert f"-{incremental.BALANCE_SPANS[-1] - 1}, currentrow$()" not in plan and frames
    events = many.select(
        F.lit("e").alias("event_id"), F.lit("instalment").alias("kind"), "credit_id", F.col("period").alias("event_date"),
        F.lit(1.0).alias("amount"), "due_status",
    )
    folded = behaviour.behaviour_features(events, "month", F.lit(1), known_only=True)
    text = folded._jdf.queryExecution().optimizedPlan().toString()
    assert "min(first_place" in text and "min(first_due" not in text and "min_by(" not in text


def test_state_rows_count_as_rows_before_the_new_ones(spark):
    """A state of one row, one of eleven rows and none, each followed by a single new row."""
    rows = [(c, _month(m), "unpaid", 1.0, 10.0 * (m + 1), float(m % 2)) for c, n in (("A", 1), ("B", 15), ("C", 0)) for m in range(n)]
    schema = "credit_id string, period date, due_status string, due_amount double, net_movement double, overdraft_amount double"
    before, new = spark.createDataFrame(rows, schema), spark.createDataFrame(
        [(c, _month(20), status, 1.0, -5.0, 2.0) for c, status in (("A", "late"), ("B", None), ("C", "unpaid"))], schema
    )
    state = incremental.new_state(materialise(incremental.continued(before, incremental.no_state(before)), "rows"))
    got = incremental.new_features(incremental.continued(new, state))
    expected = behaviour.features_from_activity(before.unionAll(new)).filter(F.col("period") == _month(20))
    assert same_rows(expected, got) and got.count() == 3
    untouched = incremental.new_state(incremental.continued(new.filter("credit_id = 'C'"), state)).filter("credit_id <> 'C'")
    assert same_rows(state, untouched)


def test_cents_of_any_amount(spark):
    amounts = [0.0, -0.0, 0.005, 1.005, -2.675, 9999999999999.99, 1e13, -1e13, 1.00000000000001e13, 9e16, -9e16, 1e30, 1e40, float("nan"), None]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    old = F.rint(F.col("amount") * 100).try_cast("decimal(38,0)")
    rows = df.filter("amount IS NULL OR abs(amount) < 1e35").select(cents(F.col("amount")).alias("new"), old.alias("old")).collect()
    assert all(r.new == r.old for r in rows) and len(rows) >= 13
