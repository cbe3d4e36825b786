"""spark-submit job: risk summary, training set, model, test predictions and metrics.

    python -m lendsight.jobs.model_job --root <folder>

Reads ``features`` below the root and labels, credits and clients below ``--tables``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from lendsight import schemas
from lendsight.operators import model, summary
from lendsight.session import get_session, materialise, scratch_run
from lendsight.sources import sinks, tables


def run(spark: SparkSession, root: str, tables_root: str | None = None, by_row: bool = False) -> dict:
    """Write all results below ``root``; returns row counts, those of the training side too, and metrics."""
    with scratch_run(spark):
        return _run(spark, root, tables_root, by_row)


def _run(spark: SparkSession, root: str, tables_root: str | None, by_row: bool) -> dict:
    at = {name: f"{root}/{folder}" for name, folder in schemas.LAYOUT.items()}
    features = tables.read_features(spark, at["features"])
    given = tables.read_tables(spark, tables_root or f"{root}/synthetic", ("labels", "credits", "clients"))

    summary_rows = sinks.write_summary(
        summary.risk_by_country_period_sql(features, given["credits"], given["clients"]), at["summary"]
    )

    dataset = materialise(model.training_set(features, given["labels"]), "training")
    fitted, predictions, _ = model.fit_and_predict(model.with_class_weight(dataset), by_row=by_row)
    kept = materialise(
        model.with_margin(predictions).select("credit_id", "period", model.LABEL, "margin", "probability", "prediction"),
        "predictions",
    )
    test_rows = sinks.write_predictions(model.prediction_table(kept), at["predictions"])
    sinks.write_metrics(model.evaluate(kept), at["metrics"])
    sinks.write_model(fitted, at["model"])
    metrics = tables.read_metrics(spark, at["metrics"]).first().asDict()
    return {"summary_rows": summary_rows, "train_rows": dataset.count() - test_rows, "test_rows": test_rows, **metrics}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the feature table and of the results")
    parser.add_argument("--tables", help="folder of labels, credits and clients; <root>/synthetic by default")
    parser.add_argument("--split-rows", action="store_true", help="split rows at random instead of whole credits")
    args = parser.parse_args()
    spark = get_session("lendsight-model")
    try:
        for name, value in run(spark, args.root, args.tables, args.split_rows).items():
            print(f"{name}: {value}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
