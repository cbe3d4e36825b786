"""spark-submit job: raw events to the feature table.

    python -m lendsight.jobs.feature_job --input <events> --output <features>
    python -m lendsight.jobs.feature_job --input <events> --output <features> --state <states> --from-month 2024-03
"""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from lendsight import schemas
from lendsight.functions.keys import period_label
from lendsight.operators.activity import is_unusual, period_activity, unusual_statuses
from lendsight.operators.incremental import continued, new_features, new_state, no_state
from lendsight.session import get_session, materialise, scratch_run
from lendsight.sources import folders, sinks, tables


def _rows(events: DataFrame, state: DataFrame, order_by: Column | None) -> DataFrame:
    """New rows continued from ``state``, stored.

    Unusual statuses are looked for while the events are read for the rows.
    Only where there are some is a list of them made and the rows computed
    again with it, so that texts never become aggregation buffers.
    """
    seen = Observation()
    unusual = is_unusual(F.col("kind"), F.col("due_status"))
    watched = events.observe(seen, F.count_if(unusual).alias("unusual"))
    usual = watched.withColumn("due_status", F.when(~unusual, F.col("due_status")))
    rows = materialise(continued(period_activity(usual, order_by=order_by, known_only=True), state), "rows")
    if seen.get["unusual"]:
        rows = materialise(continued(period_activity(events, order_by=order_by, statuses=unusual_statuses(events)), state), "rows")
    return rows


def _state_before(
    events: DataFrame, path: str, stored: list[str], from_month: str | None, to_month: str | None
) -> tuple[DataFrame | None, list[str]]:
    """The state that a run goes on from (None for none), and the months whose states it replaces."""
    spark, credit_type = events.sparkSession, events.schema["credit_id"].dataType.simpleString()
    states = folders.partition_values(spark, path, schemas.STATE_FOLDER)
    if to_month and any(m > to_month for m in states):
        raise ValueError(f"the months up to {states[-1]} rest on those of this run; leave out its end, {to_month}")
    if from_month is None:
        return None, states
    before, as_of = tables.read_window_state(spark, path, from_month, credit_type)
    skipped = [m for m in stored if m < from_month and (as_of is None or m > as_of)]
    if skipped:
        raise ValueError(f"no state is stored after the month {skipped[-1]}; run from {skipped[0]} on")
    return (None if as_of is None else before), [m for m in states if m >= from_month]


def append_features(
    events: DataFrame,
    output: str,
    state: str | None = None,
    from_month: str | None = None,
    to_month: str | None = None,
    order_by: Column | None = None,
) -> int:
    """Write the features of ``events``, which hold the months from ``from_month`` to ``to_month`` alone; returns the rows.

    With ``state``, a folder, the months go on from the state stored there for
    the months before them, their own state is stored after them, and months
    before them stay as they are. Months are appended, or computed again from
    one of them up to the newest; a gap, or newer months that would be left
    resting on replaced ones, is an error. Without ``state`` a run is the whole
    table: one limited to some months is refused where a table is already
    there. States that a run replaces go first and its own is written last, so
    that a run that broke off can be repeated and none can build upon it. For
    ``order_by`` see :func:`period_activity`.
    """
    spark = events.sparkSession
    stored = folders.partition_values(spark, output, schemas.FEATURE_FOLDER)
    if state is None:
        if stored and (from_month or to_month):
            raise ValueError(f"{output} holds months already; a run for some months needs a folder for the state")
        return sinks.write_features(new_features(_rows(events, no_state(events), order_by)), output)
    before, replaced = _state_before(events, state, stored, from_month, to_month)
    rows = _rows(events, no_state(events) if before is None else before, order_by)
    label = period_label(F.col("period"))
    months = {row[0] for row in rows.filter("_is_new").select(label).distinct().collect()}
    for month in replaced:
        folders.remove(spark, f"{state}/{schemas.STATE_FOLDER}={month}")
    for month in stored:
        if (from_month is None or month >= from_month) and month not in months:
            folders.remove(spark, f"{output}/{schemas.FEATURE_FOLDER}={month}")
    written = sinks.write_features(new_features(rows), output, keep_other_periods=from_month is not None)
    as_of = to_month or max([*months, *replaced], default=None)
    if as_of:
        sinks.write_window_state(new_state(rows), state, as_of)
    return written


def run(
    spark: SparkSession,
    source: str,
    output: str,
    countries: list[str] | None = None,
    from_month: str | None = None,
    to_month: str | None = None,
    rejected: str | None = None,
    state: str | None = None,
) -> dict[str, int]:
    """Write the features of the events below ``source``; returns the rows written and the lines read and rejected.

    Lines that are no event are counted in the pass that makes the features,
    over the same folders. ``rejected`` names a folder for them: the lines are
    then split in one read, by way of the scratch folder. For ``state`` and the
    months see :func:`append_features`. ``countries`` makes a table of their
    credits alone and is refused where a table is already there.
    """
    if countries and folders.partition_values(spark, output, schemas.FEATURE_FOLDER):
        raise ValueError(f"{output} holds months already; some countries need a table of their own")
    lines = tables.pruned_lines(spark, source, countries, from_month, to_month)
    counted, seen = tables.count_rejected(lines)
    with scratch_run(spark):
        if rejected:
            counted, others = tables.split_lines(counted)
            others.write.mode("overwrite").json(rejected)
        rows = append_features(tables.events_from_lines(counted), output, state, from_month, to_month)
    return {"rows": rows, "lines": seen.get["lines"], "rejected": seen.get["rejected"]}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder of the partitioned events")
    parser.add_argument("--output", required=True, help="folder of the feature table")
    parser.add_argument("--countries", nargs="*", help="country codes to read, for a table of their own")
    parser.add_argument("--from-month", help="first month, yyyy-MM")
    parser.add_argument("--to-month", help="last month, yyyy-MM")
    parser.add_argument("--rejected", help="folder for lines that are no valid event")
    parser.add_argument("--state", help="folder of the window states, to append months to the table")
    args = parser.parse_args()
    spark = get_session("lendsight-features")
    try:
        counts = run(spark, args.input, args.output, args.countries, args.from_month, args.to_month, args.rejected, args.state)
        print(f"feature rows written: {counts['rows']:,}; lines rejected: {counts['rejected']:,} of {counts['lines']:,}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
