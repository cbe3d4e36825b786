"""The registered queries: each maps (spark, folder of tables) to a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lendsight import schemas
from lendsight.functions import rules
from lendsight.functions.keys import period_from_label, period_label, split_bucket
from lendsight.jobs import feature_job
from lendsight.operators import activity, behaviour, curves, labels, model, newton, panel as panels, portfolio, ranking, state, summary
from lendsight.plans import mapping as m
from lendsight.session import materialise, scratch_path
from lendsight.sources import sinks, tables

Query = Callable[[SparkSession, str], DataFrame]

# Headings for the registered form of the watch list.
HEADINGS = {"credit_id": "Credit", "credit_type": "Type of credit", "alert_level": "Alert", "late_streak": "Late in a row"}


def _day(df: DataFrame, column: str = "period") -> DataFrame:
    return df.withColumn(column, period_label(F.col(column), "day"))


# --- features ------------------------------------------------------------------------


def _daily_activity(spark, folder):
    return _day(activity.period_activity(m.activity_events(spark, folder), m.GRAIN, F.col("event_id"), known_only=True))


def _daily_activity_joined(spark, folder):
    return _day(activity.period_activity_joined(m.activity_events(spark, folder), m.GRAIN, F.col("event_id")))


def _on_activity(operator: Callable[[DataFrame], DataFrame], *columns: str) -> Query:
    def query(spark, folder):
        daily = activity.period_activity(m.activity_events(spark, folder), m.GRAIN, F.col("event_id"), known_only=True)
        return _day(operator(daily).select("credit_id", "period", *columns))

    return query


def _odd_status_activity(spark, folder):
    events = m.activity_events(spark, folder, odd_statuses=True)
    return _day(activity.period_activity(events, m.GRAIN, F.col("event_id"), statuses=activity.unusual_statuses(events)))


def _odd_status_features(spark, folder):
    events = m.activity_events(spark, folder, odd_statuses=True)
    return _day(behaviour.behaviour_features(events, m.GRAIN, F.col("event_id"), statuses=activity.unusual_statuses(events)))


def _monthly_history(spark, folder):
    return m.history_features(spark, folder).withColumn("period", period_label(F.col("period"), "month"))


def _behaviour_features(spark, folder):
    return _day(m.activity_features(spark, folder))


def _monthly_features(spark, folder):
    features = behaviour.behaviour_features(m.activity_events(spark, folder), "month", F.col("event_id"), known_only=True)
    return features.withColumn("period", period_label(F.col("period"), "month"))


def _risk_by_country_period(spark, folder):
    return _day(
        summary.risk_by_country_period(m.activity_features(spark, folder), m.accounts(spark, folder), m.clients(spark, folder))
    )


def _risk_by_country_period_sql(spark, folder):
    return _day(
        summary.risk_by_country_period_sql(
            m.activity_features(spark, folder), m.accounts(spark, folder), m.clients(spark, folder)
        )
    )


# --- panel, events, labels -----------------------------------------------------------


def _credit_panel(spark, folder):
    return _day(m.order_panel(spark, folder), "statement_date")


def _credit_panel_thirty_day(spark, folder):
    dates = m.order_panel(spark, folder).select("credit_id", "month_index").withColumn(
        "statement_date", panels.statement_date(F.col("month_index"), thirty_day_steps=True)
    )
    return _day(dates, "statement_date")


def _instalment_events(spark, folder):
    return _day(m.order_events(spark, folder), "event_date")


def _event_partitions(spark, folder):
    return summary.event_partitions(m.order_events(spark, folder))


def _default_labels(spark, folder):
    return _day(labels.default_labels(m.order_panel(spark, folder, cluster=True)), "statement_date")


def _default_labels_uncensored(spark, folder):
    observed = labels.default_labels(m.order_panel(spark, folder, cluster=True), horizon=6, drop_censored=True)
    return _day(observed, "statement_date")


def _default_entries(spark, folder):
    return labels.default_entries(m.order_panel(spark, folder, cluster=True))


# --- portfolio -----------------------------------------------------------------------


def _credit_lookup(spark, folder):
    in_debt = m.table(spark, folder, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("credit_id"))
    return portfolio.credit_scores(m.activity_state(spark, folder), in_debt)


def _credit_score(spark, folder):
    return portfolio.credit_score(m.activity_state(spark, folder), m.ONE_CREDIT)


def _provision_stress(spark, folder):
    scored = portfolio.with_score(m.activity_state(spark, folder)).select("credit_id", "score", "stage", "outstanding")
    return portfolio.provision_stress(materialise(scored, "scored"), m.STRESSED_PART)


def _on_state(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(m.activity_state(spark, folder))


# --- training ------------------------------------------------------------------------


def _training_set(spark, folder):
    return _day(m.activity_training_set(spark, folder))


def _class_weights(spark, folder):
    weighted = model.with_class_weight(materialise(m.activity_training_set(spark, folder), "training"))
    return weighted.groupBy(model.LABEL, "weight").agg(F.count(F.lit(1)).alias("n"))


def _hash_split(spark, folder):
    dataset = m.activity_training_set(spark, folder).withColumn("bucket", split_bucket(F.col("credit_id")))
    return dataset.groupBy("credit_id", "bucket", (F.col("bucket") < 75).cast("int").alias("in_train")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _weighted(spark, folder):
    return materialise(model.with_class_weight(materialise(m.activity_training_set(spark, folder), "training")), "weighted")


def _newton_predictions(weighted):
    train, test = model.split_by_key(weighted)
    return newton.predict(test, newton.fit(train))


def _model_predictions(spark, folder):
    predictions = _newton_predictions(_weighted(spark, folder))
    probability = F.round("probability_positive", 6).alias("probability_positive")
    return _day(predictions.select("credit_id", "period", model.LABEL, probability, "prediction"))


def _model_metrics(spark, folder):
    kept = _newton_predictions(_weighted(spark, folder)).select(model.LABEL, "margin", "prediction")
    return model.evaluate(materialise(kept, "predictions"))


def _roundtrip_model(spark, folder):
    """Predictions of the stored and loaded pipeline beside those of the Newton fit."""
    weighted = _weighted(spark, folder)
    fitted, _, test = model.fit_and_predict(weighted)
    path = scratch_path(spark, "pipeline")
    sinks.write_model(fitted, path)
    ours = _newton_predictions(weighted).select("credit_id", "period", F.col("probability_positive").alias("expected"))
    loaded = model.prediction_table(sinks.load_model(path).transform(test)).join(ours, ["credit_id", "period"])
    agrees = F.abs(F.col("probability_positive") - F.col("expected")) < 1e-4
    return _day(loaded.select("credit_id", "period", model.LABEL, agrees.alias("agrees")))


def _training_side(spark, folder):
    weighted = _weighted(spark, folder)
    fitted, _, _ = model.fit_and_predict(weighted)
    return fitted, model.split_by_key(weighted)[0]


def _scaled_features(spark, folder):
    scaled = model.scaled_features(*_training_side(spark, folder))
    return _day(scaled.withColumns({c: F.round(c, 6) for c in model.MODEL_FEATURES}))


def _model_optimality(spark, folder):
    gradient = model.weighted_gradient(*_training_side(spark, folder))
    return gradient.select("term", F.round(F.abs("gradient"), 5).alias("gradient"))


def _stored_predictions(spark, folder):
    _, predictions, _ = model.fit_and_predict(_weighted(spark, folder))
    path = scratch_path(spark, "predictions")
    sinks.write_predictions(model.prediction_table(predictions), path)
    return tables.read_predictions(spark, path)


def _model_test_rows(spark, folder):
    return _day(_stored_predictions(spark, folder).select("credit_id", "period", model.LABEL))


# Months at which the history is cut: whole years first, a single month, and the rest.
CUTS = [(None, "1996-12"), ("1997-01", "1997-01"), ("1997-02", None)]


def _appended_features(spark, folder):
    """History appended to one table part by part, each part going on from the state stored after the one before."""
    path, states = scratch_path(spark, "features"), scratch_path(spark, "states")
    events = materialise(m.history_events(spark, folder), "events")
    for first, last in CUTS:
        own = events
        if first:
            own = own.filter(F.col("event_date") >= period_from_label(F.lit(first)))
        if last:
            own = own.filter(F.col("event_date") < F.add_months(period_from_label(F.lit(last)), 1))
        feature_job.append_features(own, path, states, first or "0000-01", last, F.col("event_id"))
    return tables.read_features(spark, path).withColumn("period", period_label(F.col("period"), "month"))


def _roundtrip_predictions(spark, folder):
    path = scratch_path(spark, "predictions")
    scored = m.labelled_scores(spark, folder).withColumnRenamed("score", "probability_positive")
    sinks.write_predictions(scored.withColumn("prediction", F.col("prediction").cast("double")), path)
    read = tables.read_predictions(spark, path)
    return read.withColumn("period", period_label(F.col("period"), "month"))


def _roundtrip_metrics(spark, folder):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(model.evaluate(materialise(m.labelled_scores(spark, folder), "scores"), score="score"), path)
    return tables.read_metrics(spark, path)


# --- reports -------------------------------------------------------------------------


def _stage_share(spark, folder):
    return _day(summary.stage_share(m.order_panel(spark, folder)), "statement_date")


def _panel_facts(spark, folder):
    return _day(summary.panel_facts(m.order_panel(spark, folder)), "statement_date")


def _panel_report(spark, folder):
    """The report on the panel from one scan: share of stages by date, defaults ever, rows and labels."""
    panel = m.order_panel(spark, folder, cluster=True)
    facts = materialise(summary.panel_facts(panel), "panel-facts")
    shares = _day(summary.stage_share_from(facts), "statement_date").select(
        F.concat(F.lit("pct_degraded "), F.col("statement_date")).alias("figure"), F.col("pct_degraded").alias("value")
    )
    ever = summary.ever_default_rate_from(facts).unpivot([], ["n_credits", "n_defaulted", "default_rate"], "figure", "value")
    prevalence = summary.label_prevalence_from(facts, labels.default_labels(panel), model.LABEL)
    return shares.unionAll(ever).unionAll(prevalence.unpivot([], ["n_panel", "n_labels", "prevalence"], "figure", "value"))


def _label_correlation(spark, folder):
    correlations = summary.label_correlation(m.activity_training_set(spark, folder), model.LABEL)
    return correlations.withColumn("correlation", F.round("correlation", 6))


def _incident_pivot(spark, folder):
    clients = m.clients(spark, folder)
    cells = summary.risk_cells(m.activity_features(spark, folder), m.accounts(spark, folder), clients)
    return _day(summary.incident_pivot(cells, summary.country_names(clients)))


def _label_prevalence(spark, folder):
    return summary.panel_prevalence(m.order_panel(spark, folder, cluster=True))


def _confusion_matrix(spark, folder):
    return curves.confusion_matrix(m.labelled_scores(spark, folder), model.LABEL)


def _alert_metrics(spark, folder):
    return curves.classification_metrics(m.labelled_scores(spark, folder), model.LABEL)


def _thresholds(spark, folder):
    # The curves read the table twice; it has at most 10 001 rows.
    return materialise(curves.threshold_table(m.labelled_scores(spark, folder), "score", model.LABEL, rules.SCORE_DECIMALS), "thresholds")


def _roc_points(spark, folder):
    return curves.roc_points(_thresholds(spark, folder))


def _roc_points_thinned(spark, folder):
    return curves.roc_points(_thresholds(spark, folder), drop_collinear=True)


def _balance_thresholds(spark, folder):
    # A score that is not rounded: the lower the balance, the greater the risk.
    dataset = m.activity_training_set(spark, folder).select((F.lit(0.0) - F.col("balance_avg_12")).alias("score"), model.LABEL)
    return materialise(curves.threshold_table(dataset, "score", model.LABEL), "thresholds")


def _roc_points_unrounded(spark, folder):
    return curves.roc_points(_balance_thresholds(spark, folder), drop_collinear=True)


def _pr_points(spark, folder):
    return curves.pr_points(_thresholds(spark, folder))


def _auc_exact(spark, folder):
    table = curves.threshold_table(m.labelled_scores(spark, folder), "score", model.LABEL, rules.SCORE_DECIMALS)
    areas = curves.area_under_curves(table)
    return areas.select(F.round("auc_roc", 6).alias("auc_roc"), F.round("auc_pr", 6).alias("auc_pr"))


# --- ranks and rates -----------------------------------------------------------------


def _pct_rank_avg_ties(spark, folder):
    amounts = m.table(spark, folder, "orders").select("o_orderkey", F.floor(F.col("o_totalprice") / 100).alias("hundreds"))
    return ranking.with_percent_rank(amounts, "hundreds", "pct_rank")


def _risk_percentile_scaled(spark, folder):
    risk = ranking.latent_risk(m.client_profile(spark, folder))
    return risk.select("client_id", F.round("latent_risk", 9).alias("latent_risk"))


def _rate_clip(spark, folder):
    lines = m.table(spark, folder, "lineitem")
    rate = F.col("l_extendedprice") / 1000
    return lines.select("l_orderkey", "l_linenumber", rules.clipped_rate(rate, 5, 45).alias("annual_rate_pct"))


# --- files ---------------------------------------------------------------------------


def _roundtrip_summary(spark, folder):
    path = scratch_path(spark, "summary")
    features = behaviour.behaviour_features(m.activity_events(spark, folder), "month", F.col("event_id"), known_only=True)
    sinks.write_summary(summary.risk_by_country_period(features, m.accounts(spark, folder), m.clients(spark, folder)), path)
    return tables.read_summary(spark, path).withColumn("period", period_label(F.col("period"), "month"))


def _roundtrip_labels(spark, folder):
    path = scratch_path(spark, "labels")
    sinks.write_labels(labels.default_labels(m.order_panel(spark, folder, cluster=True)), path)
    return _day(tables.read_labels(spark, path), "statement_date")


def _roundtrip_jsonl(spark, folder):
    path = scratch_path(spark, "events")
    events = m.order_events(spark, folder, by_folder=True)
    sinks.write_events(events, path, compression="gzip", by_folder=True, task_size=panels.CREDITS_OF_A_TASK)
    return _day(tables.read_events(spark, path), "event_date")


def _roundtrip_csv(spark, folder):
    path = scratch_path(spark, "panel")
    sinks.write_panel(m.order_panel(spark, folder), path)
    return _day(tables.read_panel(spark, path), "statement_date")


def _roundtrip_parquet(spark, folder):
    path = scratch_path(spark, "features")
    sinks.write_features(behaviour.behaviour_features(m.activity_events(spark, folder), "month", F.col("event_id"), known_only=True), path)
    features = tables.read_features(spark, path)
    return features.withColumn("period", period_label(F.col("period"), "month"))


def _write_portfolio(spark, folder, root):
    """The four portfolio tables as files; returns the rows that the writers counted."""
    client = m.client_profile(spark, folder).join(m.clients(spark, folder), "client_id").withColumn("age_years", F.lit(30))
    terms = m.order_credits(spark, folder).withColumn("annual_rate_pct", F.lit(8.5))
    monthly = behaviour.behaviour_features(m.activity_events(spark, folder), "month", F.col("event_id"), known_only=True)
    at = {name: f"{root}/{place}" for name, place in schemas.LAYOUT.items()}
    return {
        "clients": sinks.write_clients(client, at["clients"]),
        "credits": sinks.write_credits(terms, at["credits"]),
        "panel": sinks.write_panel(m.order_panel(spark, folder), at["panel"]),
        "features": sinks.write_features(monthly, at["features"]),
    }


def _portfolio_from_files(spark, folder):
    root = scratch_path(spark, "portfolio")
    _write_portfolio(spark, folder, root)
    given = tables.read_tables(spark, root)
    return state.portfolio_state(given["panel"], given["features"], given["credits"], given["clients"])


def _report_files(spark, folder):
    """Rows of all eight report tables as counted while they were written, and as read back."""
    root = scratch_path(spark, "report")
    written = _write_portfolio(spark, folder, root)
    scored = m.labelled_scores(spark, folder).withColumnRenamed("score", "probability_positive")
    scored = materialise(scored.withColumn("prediction", F.col("prediction").cast("double")), "scored")
    cells = summary.risk_cells(m.activity_features(spark, folder), m.accounts(spark, folder), m.clients(spark, folder))
    written |= {
        "labels": sinks.write_labels(labels.default_labels(m.order_panel(spark, folder, cluster=True)), f"{root}/{schemas.LAYOUT['labels']}"),
        "summary": sinks.write_summary(cells, f"{root}/{schemas.LAYOUT['summary']}"),
        "predictions": sinks.write_predictions(scored, f"{root}/{schemas.LAYOUT['predictions']}"),
    }
    sinks.write_metrics(model.evaluate(scored, score="probability_positive"), f"{root}/{schemas.LAYOUT['metrics']}")
    read = None
    for name, found in tables.read_tables(spark, root, tables.READERS).items():
        counted = F.lit(written.get(name)).cast("bigint").alias("n_written")
        row = found.agg(F.lit(name).alias("name"), counted, F.count(F.lit(1)).alias("n_read"))
        read = row if read is None else read.unionAll(row)
    return read


def _roundtrip_history(spark, folder):
    path = scratch_path(spark, "features")
    sinks.write_features(m.history_features(spark, folder), path)
    features = tables.read_features(spark, path, from_month="1994-03", to_month="1996-08")
    return features.withColumn("period", period_label(F.col("period"), "month"))


QUERIES: dict[str, Query] = {
    "daily_activity": _daily_activity,
    "daily_activity_joined": _daily_activity_joined,
    "late_streak": _on_activity(behaviour.with_late_streak, "due_status", "late_streak"),
    "status_islands": _on_activity(behaviour.with_status_islands, "changed", "island", "island_rank"),
    "balance_trend": _on_activity(
        behaviour.with_balance_trend, "balance", "balance_avg_3", "balance_avg_6", "balance_avg_12"
    ),
    "overdraft_ratio": _on_activity(behaviour.with_overdraft_ratio, "overdraft_ratio_3"),
    "incident_frequency": _on_activity(behaviour.with_incident_frequency, "incident_freq_6"),
    "behaviour_features": _behaviour_features,
    "monthly_features": _monthly_features,
    "odd_status_activity": _odd_status_activity,
    "odd_status_features": _odd_status_features,
    "monthly_history_features": _monthly_history,
    "appended_features": _appended_features,
    "risk_by_country_period": _risk_by_country_period,
    "risk_by_country_period_sql": _risk_by_country_period_sql,
    "credit_panel": _credit_panel,
    "credit_panel_thirty_day": _credit_panel_thirty_day,
    "instalment_events": _instalment_events,
    "event_partitions": _event_partitions,
    "default_labels": _default_labels,
    "default_labels_uncensored": _default_labels_uncensored,
    "default_entries": _default_entries,
    "latest_panel": m.latest_order_state,
    "portfolio_state": m.activity_state,
    "risk_score": _on_state(portfolio.score_table),
    "credit_lookup": _credit_lookup,
    "credit_score": _credit_score,
    "at_risk_top": _on_state(portfolio.watch_list),
    "at_risk_display": _on_state(lambda scored: portfolio.watch_list_display(portfolio.watch_list(scored), HEADINGS)),
    "portfolio_overview": _on_state(portfolio.overview),
    "ecl_by_country": _on_state(portfolio.loss_by_country),
    "provision_stress": _provision_stress,
    "training_set": _training_set,
    "class_weights": _class_weights,
    "hash_split": _hash_split,
    "stage_share": _stage_share,
    "client_counts": lambda spark, folder: summary.value_counts(m.clients(spark, folder), "country"),
    "credit_type_counts": lambda spark, folder: summary.value_counts(m.order_credits(spark, folder), "credit_type"),
    "panel_facts": _panel_facts,
    "panel_report": _panel_report,
    "label_correlation": _label_correlation,
    "incident_pivot": _incident_pivot,
    "label_prevalence": _label_prevalence,
    "ever_default_rate": lambda spark, folder: summary.ever_default_rate(m.order_panel(spark, folder, cluster=True)),
    "confusion_matrix": _confusion_matrix,
    "alert_metrics": _alert_metrics,
    "roc_points": _roc_points,
    "roc_points_thinned": _roc_points_thinned,
    "roc_points_unrounded": _roc_points_unrounded,
    "pr_points": _pr_points,
    "auc_exact": _auc_exact,
    "pct_rank_avg_ties": _pct_rank_avg_ties,
    "risk_percentile_scaled": _risk_percentile_scaled,
    "rate_clip": _rate_clip,
    "model_predictions": _model_predictions,
    "model_metrics": _model_metrics,
    "scaled_features": _scaled_features,
    "model_optimality": _model_optimality,
    "model_test_rows": _model_test_rows,
    "roundtrip_model": _roundtrip_model,
    "roundtrip_jsonl": _roundtrip_jsonl,
    "roundtrip_csv": _roundtrip_csv,
    "roundtrip_labels": _roundtrip_labels,
    "roundtrip_summary": _roundtrip_summary,
    "roundtrip_parquet": _roundtrip_parquet,
    "roundtrip_history": _roundtrip_history,
    "portfolio_from_files": _portfolio_from_files,
    "report_files": _report_files,
    "roundtrip_predictions": _roundtrip_predictions,
    "roundtrip_metrics": _roundtrip_metrics,
}
