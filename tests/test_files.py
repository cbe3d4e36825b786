"""Files as other programs write and read them, and the jobs from end to end."""

import csv
import datetime
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from lendsight import schemas, session
from lendsight.jobs import dataset_job, feature_job, model_job, portfolio_job, report_job
from lendsight.operators import model, behaviour, labels, panel
from lendsight.operators.state import credit_attributes
from lendsight.plans import catalog, mapping
from lendsight.session import scratch_root
from lendsight.sources import sinks, tables


def line(**fields):
    event = {
        "event_id": "E1", "event_type": "echeance_credit", "credit_id": "A", "client_id": "X",
        "date_evenement": "2022-01-05", "montant_fcfa": 100.0, "statut": "paye_a_temps",
    }
    return json.dumps({**event, **fields}, ensure_ascii=False)


@pytest.fixture(scope="module")
def event_folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("in") / "events"
    files = {
        "pays_code=TG/annee=2022/mois=01": [
            line(),
            line(event_id="E2", event_type="mouvement_compte", montant_fcfa=-40, statut=None),
            line(event_id="E3", event_type="consultation_agence", montant_fcfa=0.0, statut=None),
            "{broken",
            line(event_id="E4", date_evenement="2022-13-40"),
            line(event_id="E5", event_type="something"),
            line(event_id=None),
        ],
        "pays_code=TG/annee=2022/mois=02": [line(event_id="E6", date_evenement="2022-02-05", statut="impaye")],
        "pays_code=NE/annee=2022/mois=01": [
            line(event_id="E7", credit_id="B"),
            line(event_id="E8", credit_id="B", event_type="depassement_decouvert", montant_fcfa=7.5, statut=None),
        ],
    }
    for folder, lines in files.items():
        (root / folder).mkdir(parents=True)
        (root / folder / "part-0000.jsonl").write_text("\n".join(lines), encoding="utf-8")
    return str(root)


def test_events_are_read_and_checked(spark, event_folder):
    events = {r.event_id: r for r in tables.read_events(spark, event_folder).collect()}
    assert set(events) == {"E1", "E2", "E3", "E6", "E7", "E8"}
    assert events["E1"].kind == "instalment" and events["E1"].due_status == "on_time"
    assert events["E1"].event_date == datetime.date(2022, 1, 5)
    assert (events["E6"].country_code, events["E6"].year, events["E6"].month) == ("TG", 2022, 2)
    assert events["E2"].amount == -40.0 and events["E2"].due_status is None
    rejected = tables.rejected_events(tables.read_event_lines(spark, event_folder)).collect()
    assert len(rejected) == 4 and [r._corrupt_record for r in rejected].count("{broken") == 1


def test_folders_are_pruned(spark, event_folder):
    january = tables.read_events(spark, event_folder, countries=["TG"], from_month="2022-01", to_month="2022-01")
    assert {r.event_id for r in january.collect()} == {"E1", "E2", "E3"}
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "pays_code" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.event_id for r in tables.read_events(spark, event_folder, to_month="2022-01").collect()} == {"E1", "E2", "E3", "E7", "E8"}


def test_events_survive_a_round_trip(spark, event_folder, tmp_path):
    events = tables.read_events(spark, event_folder)
    assert sinks.write_events(events, str(tmp_path / "out")) == events.count()
    assert os.path.isdir(tmp_path / "out/pays_code=TG/annee=2022/mois=02")
    again = tables.read_events(spark, str(tmp_path / "out"))
    assert sorted(again.collect()) == sorted(events.collect())
    raw = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert all(list(r) == list(schemas.EVENT_COLUMNS) for r in raw)
    assert any(r["statut"] is None for r in raw)


def test_a_hot_folder_is_split_over_files(spark, tmp_path):
    """A third of all events in one folder: no single task writes them."""
    hot = F.col("id") % 3 == 0
    events = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("E"), F.col("id")).alias("event_id"),
        F.lit("movement").alias("kind"),
        F.concat(F.lit("C"), F.col("id") % 500).alias("credit_id"),
        F.lit("X").alias("client_id"),
        F.lit(datetime.date(2022, 1, 1)).alias("event_date"),
        F.col("id").cast("double").alias("amount"),
        F.lit(None).cast("string").alias("due_status"),
        F.when(hot, "TG").otherwise(F.concat(F.lit("X"), F.col("id") % 40)).alias("country_code"),
        F.lit(2022).alias("year"),
        F.lit(1).alias("month"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        sinks.write_events(events, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    parts = lambda folder: len([f for f in os.listdir(tmp_path / f"out/pays_code={folder}/annee=2022/mois=01") if f.startswith("part")])
    assert parts("TG") > 1
    assert tables.read_events(spark, str(tmp_path / "out")).count() == 60000


def test_wrong_header_is_an_error(spark, tmp_path):
    (tmp_path / "clients.csv").write_text("client_id,type_client,pays\nX,Y,Z\n")
    with pytest.raises(Exception):
        tables.read_clients(spark, str(tmp_path / "clients.csv")).collect()


def test_features_by_month(spark, event_folder, tmp_path):
    features = behaviour.behaviour_features(tables.read_events(spark, event_folder))
    path = str(tmp_path / "features")
    assert sinks.write_features(features, path) == 3
    assert sorted(f for f in os.listdir(path) if "=" in f) == ["annee_mois=2022-01", "annee_mois=2022-02"]
    assert sorted(tables.read_features(spark, path).collect()) == sorted(features.collect())
    february = tables.read_features(spark, path, from_month="2022-02")
    assert [(r.credit_id, r.due_status, r.late_streak) for r in february.collect()] == [("A", "unpaid", 1)]
    # One month again by itself leaves the other one alone; a plain write does not.
    assert sinks.write_features(features.filter("period = date'2022-02-01'"), path, keep_other_periods=True) == 1
    assert tables.read_features(spark, path).count() == 3
    sinks.write_features(features.filter("period = date'2022-02-01'"), path)
    assert tables.read_features(spark, path).count() == 1


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_given_settings_win_over_defaults(spark):
    given = spark.conf.get("spark.sql.session.timeZone")
    force = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(force, None)
    session.DEFAULTS["spark.sql.session.timeZone"] = "Asia/Tokyo"
    try:
        assert session.get_session("test").conf.get("spark.sql.session.timeZone") == given == "UTC"
        assert spark.conf.get(force) == "true"
    finally:
        session.DEFAULTS["spark.sql.session.timeZone"] = "UTC"
        spark.conf.set(force, before) if before is not None else spark.conf.unset(force)


# --- jobs on a small portfolio written as plain CSV files ------------------------------

MONTHS = 24


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Credits of 120 clients; every seventh slides into default, one client holds a third of the credits."""
    folder = tmp_path_factory.mktemp("portfolio")
    countries = [name for name, _ in schemas.COUNTRIES[:7]] + ["Ghana"]
    clients = [(f"K{i}", countries[i % 8], "PME" if i % 3 else "Particulier", 30, 24, 1000.0 * i) for i in range(120)]
    credits = [
        (f"C{i}", "K0" if i % 3 == 0 else f"K{i % 120}", "Habitat" if i % 2 else "Decouvert", 12000.0 + i, MONTHS, 8.5, i % 6)
        for i in range(240)
    ]

    def dpd(i, month):
        if i % 7:
            return 10 if (i + month) % 9 == 0 else 0
        return 0 if month < 14 else min(15 * (month - 14), 95)

    delays = [(f"C{i}", m, dpd(i, m)) for i in range(240) for m in range(i % 6, i % 6 + MONTHS)]
    for name, header, rows in (
        ("clients.csv", schemas.CLIENT_COLUMNS, clients),
        ("credits.csv", schemas.CREDIT_COLUMNS, credits),
        ("dpd.csv", ["credit_id", "mois_relatif", "dpd_jours"], delays),
    ):
        with open(folder / name, "w", newline="", encoding="utf-8") as f:
            writer = csv.writer(f)
            writer.writerow(list(header))
            writer.writerows(rows)
    path = str(folder)
    assert dataset_job.write_panel(spark, path, f"{path}/dpd.csv") == 240 * MONTHS
    return path


@pytest.fixture(scope="module")
def built(spark, root):
    written = dataset_job.write_labels(spark, root)
    assert dataset_job.write_events(spark, root, f"{root}/events") > 0
    counts = feature_job.run(spark, f"{root}/events", f"{root}/features", rejected=f"{root}/rejected")
    assert counts["rejected"] == 0 and counts["lines"] >= counts["rows"]
    results = model_job.run(spark, root, tables_root=root)
    return {"labels": written, "features": counts["rows"], **results}


def test_label_job(spark, root, built):
    given = tables.read_panel(spark, f"{root}/panel_mensuel.csv")
    expected = labels.default_labels(given)
    assert sorted(tables.read_labels(spark, f"{root}/labels.csv").collect()) == sorted(expected.collect())
    assert 0 < built["labels"]["prevalence"] < 0.2


def test_feature_job(spark, root, built):
    assert built["features"] == 240 * MONTHS == tables.read_features(spark, f"{root}/features").count()
    assert spark.read.text(f"{root}/rejected").isEmpty()
    late = tables.read_features(spark, f"{root}/features").filter("due_status <> 'on_time'").count()
    assert late == tables.read_panel(spark, f"{root}/panel_mensuel.csv").filter("dpd > 0").count()


def test_model_job(spark, root, built):
    summary = tables.read_summary(spark, f"{root}/analyse_risque_pays")
    assert summary.count() == built["summary_rows"]
    assert summary.agg(F.sum("n_credits")).first()[0] == built["features"]
    predictions = tables.read_predictions(spark, f"{root}/predictions_test")
    assert predictions.count() == built["test_rows"] > 0 and built["train_rows"] > built["test_rows"]
    assert built["auc_roc"] > 0.7 and 0 <= built["f1_positive"] <= 1
    stored = sinks.load_model(f"{root}/model")
    assert len(stored.stages) == 3
    training = model.training_set(tables.read_features(spark, f"{root}/features"), tables.read_labels(spark, f"{root}/labels.csv"))
    test = model.split_by_key(training)[1]
    again = {(r.credit_id, r.period): r.probability_positive for r in model.prediction_table(stored.transform(test)).collect()}
    assert again == {(r.credit_id, r.period): r.probability_positive for r in predictions.collect()}


def test_portfolio_job(spark, root, built, tmp_path):
    out = str(tmp_path / "answers")
    portfolio_job.run(spark, root, out, part=0.25, limit=10, credit="C7")
    one = spark.read.parquet(f"{out}/credit_score").collect()
    assert [r.credit_id for r in one] == ["C7"]
    overview = spark.read.parquet(f"{out}/overview").first()
    stress = spark.read.parquet(f"{out}/provision_stress").first()
    assert overview.n_credits == 240 and stress.n_downgraded == 60
    assert stress.ecl_before == overview.total_ecl and stress.variation_pct > 0
    assert spark.read.parquet(f"{out}/scores").count() == 240
    watched = spark.read.parquet(f"{out}/watch_list")
    assert watched.count() == 10 and watched.agg(F.min("score")).first()[0] >= 0.3
    by_country = spark.read.parquet(f"{out}/loss_by_country")
    assert by_country.agg(F.sum("ecl")).first()[0] == overview.total_ecl


def test_portfolio_job_checks_keys(spark, root, built):
    given = tables.read_tables(spark, root)
    given["panel"] = given["panel"].unionByName(given["panel"].limit(1))
    with pytest.raises(ValueError, match="panel: more than one row"):
        portfolio_job.check_keys(given)


def test_labels_for_another_horizon(spark, root, tmp_path):
    panel_table = tables.read_panel(spark, f"{root}/panel_mensuel.csv")
    labelled = labels.default_labels(panel_table, horizon=6)
    assert sinks.write_labels(labelled, str(tmp_path / "labels"), horizon=6) == labelled.count()
    again = tables.read_labels(spark, str(tmp_path / "labels"), horizon=6)
    assert again.columns == labelled.columns and sorted(again.collect()) == sorted(labelled.collect())


def test_feature_files_with_narrow_streaks(spark, tmp_path):
    """Streaks stored as INT, as row numbers are, can be read too."""
    schema = schemas.FEATURES.replace("retards_consecutifs bigint", "retards_consecutifs int")
    row = ("A", "2022-03", "impaye", 4, 1.0, 2.0, 3.0, 4.0, 0.5, 0.25)
    spark.createDataFrame([row], schema).write.partitionBy("annee_mois").parquet(str(tmp_path / "features"))
    got = tables.read_features(spark, str(tmp_path / "features")).first()
    assert (got.period, got.due_status, got.late_streak) == (datetime.date(2022, 3, 1), "unpaid", 4)


def test_report_job(spark, root, built, tmp_path):
    out = str(tmp_path / "report")
    report_job.run(spark, root, out)
    read = lambda name: spark.read.parquet(f"{out}/{name}")
    assert read("clients_by_country").agg(F.sum("n")).first()[0] == 120
    assert len(read("incident_pivot").columns) == 9 and "Ghana" in read("incident_pivot").columns
    areas = read("areas").first()
    assert round(areas.auc_roc, 3) == round(built["auc_roc"], 3)
    assert read("confusion_matrix").agg(F.sum("n")).first()[0] == built["test_rows"]
    assert read("ever_default_rate").first().n_defaulted == len(range(0, 240, 7))
    assert read("label_correlation").count() == 5
    assert read("roc_points").agg(F.max("tpr")).first()[0] == 1.0
    assert read("metrics").first().auc_roc == built["auc_roc"]


def test_a_client_with_a_third_of_the_credits(spark, root):
    given = tables.read_tables(spark, root, ["panel", "credits", "clients"])
    joined = panel.enriched_panel(given["panel"], given["credits"], given["clients"], tables.country_dimension(spark))
    assert joined.count() == 240 * MONTHS


def test_a_hot_client_is_split_by_adaptive_execution(spark):
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50000)
    credits = spark.range(0, 600000, 1, 12).select(
        F.concat(F.lit("C"), F.col("id")).alias("credit_id"), hot.alias("client_id"), F.lit("Habitat").alias("credit_type")
    )
    clients = spark.range(50000).select(F.col("id").alias("client_id"), F.lit("Togo").alias("country"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = credit_attributes(credits, clients).select(F.max("credit_id"), F.count(F.lit(1)).alias("n"))
        assert joined.first().n == 600000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


class _Session:
    """Just what scratch_root looks at."""

    def __init__(self, master, configured=None, checkpoint=None):
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: configured or default)})
        self.sparkContext = self
        self.master, self.checkpoint = master, checkpoint

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


def test_scratch_folder_is_never_local_on_a_cluster():
    assert scratch_root(_Session("yarn", "hdfs:///scratch/")) == "hdfs:///scratch"
    assert scratch_root(_Session("yarn", checkpoint="hdfs:///set")) == "hdfs:///set"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(_Session("spark://host:7077"))
    local = _Session("local[4]")
    assert scratch_root(local) == scratch_root(local) == local.checkpoint


def test_large_amounts_are_events_and_only_infinite_ones_are_not(spark, tmp_path):
    folder = tmp_path / "events/pays_code=TG/annee=2022/mois=01"
    folder.mkdir(parents=True)
    line = '{{"event_id":"E{0}","event_type":"mouvement_compte","credit_id":"C","client_id":"K","date_evenement":"2022-01-05","montant_fcfa":{1},"statut":null}}'
    (folder / "a.json").write_text("\n".join(line.format(i, a) for i, a in enumerate(["2e15", "1e30", '"NaN"', '"Infinity"', "null"])))
    lines = tables.read_event_lines(spark, str(tmp_path / "events"))
    assert {r.event_id for r in tables.events_from_lines(lines).collect()} == {"E0", "E1"}
    counted, seen = tables.count_rejected(lines)
    assert tables.events_from_lines(counted).count() == 2
    assert seen.get == {"lines": 5, "rejected": 3}


def test_rejected_lines_of_other_folders_are_not_reported(spark, event_folder, tmp_path):
    counts = feature_job.run(spark, event_folder, str(tmp_path / "f"), from_month="2022-02", rejected=str(tmp_path / "r"))
    all_lines = feature_job.run(spark, event_folder, str(tmp_path / "f"))
    assert counts["lines"] < all_lines["lines"] and counts["rejected"] == spark.read.text(str(tmp_path / "r")).count()


def test_an_unreadable_cell_is_an_error(spark, tmp_path):
    header = ",".join(schemas.PANEL_COLUMNS)
    (tmp_path / "panel.csv").write_text(f"{header}\nA,K,1,zehn,1,5.0,0.0,2022-01-01\n")
    with pytest.raises(Exception):
        tables.read_panel(spark, str(tmp_path / "panel.csv")).collect()


def test_a_job_leaves_no_scratch_behind(spark, root, built):
    import glob

    from lendsight.session import materialise, scratch_root, scratch_run

    base = scratch_root(spark).removeprefix("file:")
    assert not glob.glob(f"{base}/run-*")
    with pytest.raises(ZeroDivisionError), scratch_run(spark):
        assert materialise(spark.range(5)).count() == 5 and glob.glob(f"{base}/run-*/*")
        1 / 0
    assert not glob.glob(f"{base}/run-*")


def test_event_files_are_small_and_whole(spark, tmp_path):
    """The stored events take a fraction of their plain lines, and no line is shuffled on its way to its folder."""
    keys = F.col("id")
    spark.range(900).select(
        keys.alias("o_orderkey"), (keys % 90).alias("o_custkey"), (keys * 10.5 + 900).alias("o_totalprice"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(90).select(
        keys.alias("c_custkey"), F.when(keys % 3 < 2, keys % 3).cast("int").alias("c_nationkey"), F.lit("A").alias("c_mktsegment")
    ).write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(2).select(
        keys.cast("int").alias("n_nationkey"), F.concat(F.lit("NATION_"), keys).alias("n_name"), (keys * 4).cast("int").alias("n_regionkey")
    ).write.parquet(str(tmp_path / "nation.parquet"))
    expected = mapping.order_events(spark, str(tmp_path))
    stored = catalog.QUERIES["roundtrip_jsonl"](spark, str(tmp_path))
    n = expected.count()
    assert n > 5000 and expected.filter("country_code IS NULL").count() > 0
    files = [path.removeprefix("file://") for path in stored.inputFiles()]
    assert sum(os.path.getsize(path) for path in files) < 60 * n
    columns = ["event_id", "kind", "credit_id", "client_id", "amount", "due_status", "country_code", "year", "month"]
    texts = expected.withColumns({c: F.col(c).cast("string") for c in ("credit_id", "client_id")}).select(*columns)
    assert sorted(stored.select(*columns).collect(), key=str) == sorted(texts.collect(), key=str)
    together = mapping.order_events(spark, str(tmp_path), by_folder=True)
    written = sinks.event_lines(together)._jdf.queryExecution().optimizedPlan().toString()
    assert written.index("md5(") < written.index("RebalancePartitions") and written.count("RebalancePartitions") == 1
    assert sinks.write_events(together, str(tmp_path / "plain"), by_folder=True) == n
    assert sorted(tables.read_events(spark, str(tmp_path / "plain")).select(*columns).collect(), key=str) == sorted(texts.collect(), key=str)


def test_event_files_shuffle_credits_and_pack_well(spark, tmp_path):
    """Rows are shuffled before the months are expanded; repeated and missing keys give the rows of the plain join."""
    orders = [(k, k % 7 if k % 11 else None, 900.0 + k * 37.5 if k % 13 else None, "1-URGENT") for k in range(400)]
    orders += [(3, 3, 50_000.0, "2-HIGH"), (3, 3, 70_000.0, "3-MEDIUM"), (5, 2, 8_000.0, None), (None, 1, 9_000.0, "5-LOW")]
    customers = [(k, k % 4 if k else None, "A") for k in range(7)] + [(2, 1, "A"), (None, 1, "A")]
    nations = [(k, f"NATION_{k}", k if k != 1 else 4) for k in range(4)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"),
        ("customer", customers, "c_custkey long, c_nationkey int, c_mktsegment string"),
        ("nation", nations, "n_nationkey int, n_name string, n_regionkey int"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    plain = mapping.order_events(spark, str(tmp_path))
    together = mapping.order_events(spark, str(tmp_path), by_folder=True)
    assert plain.filter("country_code IS NULL").count() > 0 and plain.filter("amount IS NULL").count() > 0
    assert plain.groupBy("event_id").count().filter("count > 3").count() > 0
    assert together.columns == plain.columns
    assert sorted(together.collect(), key=str) == sorted(plain.collect(), key=str)
    plan = sinks.event_lines(together)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Generate explode") < plan.index("RebalancePartitions") and "Join" not in plan[: plan.rindex("Generate explode")]

    writers, size = "spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = [spark.conf.get(key) for key in (writers, size)]
    known = together.filter("amount IS NOT NULL")
    lines = tmp_path / "lines"
    assert sinks.write_events(known, str(lines), compression="gzip", by_folder=True, task_size=panel.CREDITS_OF_A_TASK) == known.count()
    assert [spark.conf.get(key) for key in (writers, size)] == before
    assert tables.read_events(spark, str(lines)).count() == known.count()
    # Digests pack better without short matches.
    files = [file for file in lines.rglob("*.gz") if file.stat().st_size > 2000]
    assert files
    for file in files:
        text = gzip.decompress(file.read_bytes())
        assert file.stat().st_size < len(gzip.compress(text, 6))
        if "pays_code=N" in str(file):
            credits = [json.loads(line)["credit_id"] for line in text.splitlines()]
            assert credits == sorted(credits, key=int)
