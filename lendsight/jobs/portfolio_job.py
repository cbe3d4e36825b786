"""spark-submit job: state of the portfolio and the answers read from it.

    python -m lendsight.jobs.portfolio_job --root <folder> --output <folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from lendsight.operators import portfolio
from lendsight.operators.state import portfolio_state
from lendsight.operators.summary import duplicate_keys
from lendsight.session import get_session, scratch_run
from lendsight.sources import tables


def check_keys(given: dict[str, DataFrame]) -> None:
    """Fail on two rows for one credit and month, or two credits or clients with one id."""
    keys = {"panel": ["credit_id", "month_index"], "features": ["credit_id", "period"], "credits": ["credit_id"], "clients": ["client_id"]}
    for name, columns in keys.items():
        example = duplicate_keys(given[name], *columns).first()
        if example:
            raise ValueError(f"{name}: more than one row for {example.asDict()}")


def run(
    spark: SparkSession,
    root: str,
    output: str,
    part: float = 0.1,
    limit: int = portfolio.WATCH_LIST_SIZE,
    checked: bool = True,
    credit: str | None = None,
) -> None:
    """Write the scored state once, then answer every question from that table.

    ``credit`` asks for the score of one credit besides.
    """
    with scratch_run(spark):
        _run(spark, root, output, part, limit, checked, credit)


def _run(spark: SparkSession, root: str, output: str, part: float, limit: int, checked: bool, credit: str | None) -> None:
    given = tables.read_tables(spark, root)
    if checked:
        check_keys(given)
    state = portfolio_state(given["panel"], given["features"], given["credits"], given["clients"])
    scored = portfolio.with_score(state)
    scored.write.mode("overwrite").parquet(f"{output}/state")
    stored = spark.read.schema(scored.schema).parquet(f"{output}/state")

    bare = stored.drop("score", "alert_level")
    answers = {
        "scores": portfolio.score_table(bare),
        "watch_list": portfolio.watch_list(bare, limit),
        "overview": portfolio.overview(bare),
        "loss_by_country": portfolio.loss_by_country(bare),
        "provision_stress": portfolio.provision_stress(stored, part),
    }
    if credit is not None:
        answers["credit_score"] = portfolio.credit_score(bare, credit)
    for name, answer in answers.items():
        answer.write.mode("overwrite").parquet(f"{output}/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--root", required=True, help="folder of clients, credits, panel and features")
    parser.add_argument("--output", required=True)
    parser.add_argument("--part", type=float, default=0.1, help="share of credits downgraded in the stress")
    parser.add_argument("--unchecked", action="store_true", help="do not look for duplicate keys first")
    parser.add_argument("--credit", help="credit whose score is written to credit_score")
    parser.add_argument("--limit", type=int, default=portfolio.WATCH_LIST_SIZE, help="length of the watch list")
    args = parser.parse_args()
    spark = get_session("lendsight-portfolio")
    try:
        run(spark, args.root, args.output, args.part, args.limit, not args.unchecked, args.credit)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
