"""spark-submit job: the tables behind the descriptive report.

    python -m lendsight.jobs.report_job --root <folder> --output <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lendsight.operators import curves, model, summary
from lendsight.session import get_session, materialise, scratch_run
from lendsight.sources import tables


def run(spark: SparkSession, root: str, output: str) -> None:
    with scratch_run(spark):
        _run(spark, root, output)


def _run(spark: SparkSession, root: str, output: str) -> None:
    given = tables.read_tables(spark, root, tables.READERS)
    training = model.training_set(given["features"], given["labels"])
    # The panel and the clients are scanned once each; their reports are read from what is counted then.
    facts = materialise(summary.panel_facts(given["panel"]), "panel-facts")
    clients_by_country = materialise(summary.value_counts(given["clients"], "country"), "clients")
    countries = summary.country_names(clients_by_country)
    thresholds = materialise(curves.threshold_table(given["predictions"], "probability_positive", model.LABEL), "thresholds")
    reports = {
        "clients_by_country": clients_by_country.orderBy("n", "country"),
        "credits_by_type": summary.value_counts(given["credits"], "credit_type"),
        "stage_share": summary.stage_share_from(facts),
        "label_correlation": summary.label_correlation(training, model.LABEL),
        "incident_pivot": summary.incident_pivot(given["summary"], countries),
        "label_prevalence": summary.label_prevalence_from(facts, given["labels"], model.LABEL),
        "ever_default_rate": summary.ever_default_rate_from(facts),
        "confusion_matrix": curves.confusion_matrix(given["predictions"], model.LABEL),
        "roc_points": curves.roc_points(thresholds),
        "pr_points": curves.pr_points(thresholds),
        "areas": curves.area_under_curves(thresholds),
        "metrics": given["metrics"],
    }
    for name, report in reports.items():
        report.write.mode("overwrite").parquet(f"{output}/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of all portfolio, model and summary tables")
    parser.add_argument("--output", required=True)
    args = parser.parse_args()
    spark = get_session("lendsight-report")
    try:
        run(spark, args.root, args.output)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
