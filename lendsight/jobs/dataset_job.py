"""spark-submit job: panel, labels and events derived from one another.

    python -m lendsight.jobs.dataset_job panel  --root <folder> --dpd <csv: credit_id, mois_relatif, dpd_jours>
    python -m lendsight.jobs.dataset_job labels --root <folder>
    python -m lendsight.jobs.dataset_job events --root <folder> --output <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession, functions as F

from lendsight import schemas
from lendsight.operators import labels, panel
from lendsight.session import get_session
from lendsight.sources import sinks, tables

DPD_SCHEMA = "credit_id string, mois_relatif int, dpd_jours int"


def write_panel(spark: SparkSession, root: str, dpd_path: str, thirty_day_steps: bool = False) -> int:
    """Panel of the credits with days past due taken from a table."""
    credits = tables.read_tables(spark, root, ["credits"])["credits"]
    dpd = (
        spark.read.schema(DPD_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(dpd_path)
        .withColumnsRenamed(schemas.PANEL_COLUMNS)
    )
    built = panel.credit_panel(credits, dpd, thirty_day_steps=thirty_day_steps)
    return sinks.write_panel(built, f"{root}/{schemas.LAYOUT['panel']}")


def write_labels(
    spark: SparkSession, root: str, drop_censored: bool = False, horizon: int = labels.LABEL_HORIZON
) -> dict:
    """Labels of the panel; returns their number and the share of positive ones."""
    given = tables.read_tables(spark, root, ["panel"])["panel"]
    path = f"{root}/{schemas.LAYOUT['labels']}"
    rows = sinks.write_labels(labels.default_labels(given, horizon, drop_censored=drop_censored), path, horizon=horizon)
    prevalence = tables.read_labels(spark, path, horizon).agg(F.avg(f"default_within_{horizon}")).first()[0]
    return {"rows": rows, "prevalence": prevalence}


def write_events(spark: SparkSession, root: str, output: str, compression: str = "none") -> int:
    """Events of the panel as partitioned JSON lines; returns the number of events."""
    given = tables.read_tables(spark, root, ["clients", "credits", "panel"])
    countries = tables.country_dimension(spark)
    built = panel.instalment_events(given["panel"], given["credits"], given["clients"], countries, by_folder=True)
    return sinks.write_events(built, output, compression=compression, by_folder=True)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    steps = parser.add_subparsers(dest="step", required=True)
    for name in ("panel", "labels", "events"):
        steps.add_parser(name).add_argument("--root", required=True)
    steps.choices["panel"].add_argument("--dpd", required=True)
    steps.choices["panel"].add_argument("--thirty-day-steps", action="store_true")
    steps.choices["labels"].add_argument("--drop-censored", action="store_true")
    steps.choices["labels"].add_argument("--horizon", type=int, default=labels.LABEL_HORIZON, help="months ahead")
    steps.choices["events"].add_argument("--output", required=True)
    steps.choices["events"].add_argument("--compression", default="none", help="none or gzip")
    args = parser.parse_args()
    spark = get_session("lendsight-dataset")
    try:
        if args.step == "panel":
            print("panel rows:", write_panel(spark, args.root, args.dpd, args.thirty_day_steps))
        elif args.step == "labels":
            print(write_labels(spark, args.root, args.drop_censored, args.horizon))
        else:
            print("events:", write_events(spark, args.root, args.output, args.compression))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
