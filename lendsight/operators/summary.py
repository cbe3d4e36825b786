"""Descriptive aggregates over features, panel and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lendsight.operators.labels import LABEL_HORIZON, in_default, with_label

CORRELATED = ["late_streak", "balance_avg_3", "balance_avg_12", "overdraft_ratio_3", "incident_freq_6"]


def credit_country(credits: DataFrame, clients: DataFrame) -> DataFrame:
    return credits.select("credit_id", "client_id").join(clients.select("client_id", "country"), "client_id").select(
        "credit_id", "country"
    )


# Summary column: feature averaged, decimals.
RISK_AVERAGES = {
    "avg_incident_freq": ("incident_freq_6", 4),
    "avg_late_streak": ("late_streak", 2),
    "avg_overdraft_ratio": ("overdraft_ratio_3", 4),
}


_SUMMARISED = ["credit_id", "period", *[feature for feature, _ in RISK_AVERAGES.values()]]


def risk_cells(features: DataFrame, credits: DataFrame, clients: DataFrame) -> DataFrame:
    """Credits, incident frequency, late streak and overdraft ratio per country and period, in no order."""
    averages = [F.round(F.avg(feature), digits).alias(name) for name, (feature, digits) in RISK_AVERAGES.items()]
    located = features.select(*_SUMMARISED).join(credit_country(credits, clients), "credit_id")
    return located.groupBy("country", "period").agg(F.count(F.lit(1)).alias("n_credits"), *averages)


def risk_by_country_period(features: DataFrame, credits: DataFrame, clients: DataFrame) -> DataFrame:
    """``risk_cells`` ordered by country and period."""
    return risk_cells(features, credits, clients).orderBy("country", "period")


def risk_by_country_period_sql(features: DataFrame, credits: DataFrame, clients: DataFrame) -> DataFrame:
    """The same summary as a SQL query over the DataFrames, without names in the catalogue."""
    averages = ", ".join(f"round(sum_{name} / known_{name}, {digits}) AS {name}" for name, (_, digits) in RISK_AVERAGES.items())
    sums = ", ".join(
        f"sum({feature}) AS sum_{name}, count({feature}) AS known_{name}" for name, (feature, _) in RISK_AVERAGES.items()
    )
    return features.sparkSession.sql(
        f"WITH totals AS (SELECT country, period, count(1) AS n_credits, {sums} "
        "FROM {credit_country} JOIN {features} USING (credit_id) GROUP BY ALL) "
        f"SELECT country, period, n_credits, {averages} FROM totals ORDER BY country, period",
        features=features.select(*_SUMMARISED),
        credit_country=credit_country(credits, clients),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per known value of a column, smallest first."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy("n", column)


def stage_share(panel: DataFrame, date: str = "statement_date") -> DataFrame:
    """Percentage of the portfolio in stage 2 or 3 at each date."""
    return (
        panel.groupBy(date).agg((F.avg((F.col("stage") >= 2).cast("double")) * 100).alias("pct_degraded")).orderBy(date)
    )


def label_correlation(training: DataFrame, label: str, features: list[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of each feature with the label, over the rows where both are known, lowest first.

    NULL for a feature or label that never varies; one pass for all features.
    """
    sums = []
    for name in features:
        both = F.col(name).isNotNull() & F.col(label).isNotNull()
        x, y = F.when(both, F.col(name).cast("double")), F.when(both, F.col(label).cast("double"))
        sums.append(F.struct(F.covar_pop(x, y).alias("cov"), (F.stddev_pop(x) * F.stddev_pop(y)).alias("spread")).alias(name))
    correlations = [F.when(F.col(n)["spread"] > 0, F.col(n)["cov"] / F.col(n)["spread"]).alias(n) for n in features]
    return (
        training.agg(*sums)
        .select(*correlations)
        .unpivot([], features, "feature", "correlation")
        .orderBy(F.asc_nulls_last("correlation"), "feature")
    )


def country_names(clients: DataFrame) -> list[str]:
    """The known countries of a clients table, sorted: a distinct over one small column."""
    return [row[0] for row in clients.select("country").distinct().filter("country IS NOT NULL").orderBy("country").collect()]


def incident_pivot(cells: DataFrame, countries: list[str]) -> DataFrame:
    """Incident frequency with one row per period and one column per country.

    ``cells`` has one row per country and period. ``countries`` should come
    from ``country_names``; a country in ``cells`` that it leaves out is an
    error and not a lost column. Cells without a country have no column.
    """
    unlisted = F.raise_error(F.concat(F.lit("country without a column: "), F.col("country")))
    known = F.when(F.col("country").isNull() | F.col("country").isin(countries), F.col("country")).otherwise(unlisted.cast("string"))
    checked = cells.select("period", known.alias("country"), "avg_incident_freq")
    return checked.groupBy("period").pivot("country", countries).agg(F.max("avg_incident_freq")).orderBy("period")


def label_prevalence(panel: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Panel rows, label rows and share of positive labels of two stored tables."""
    n_panel = panel.agg(F.count(F.lit(1)).alias("n_panel")).scalar()
    return labels.agg(
        F.count(F.lit(1)).alias("n_labels"), F.avg(F.col(label).cast("double")).alias("prevalence")
    ).select(n_panel.alias("n_panel"), "n_labels", "prevalence")


def panel_prevalence(panel: DataFrame, horizon: int = LABEL_HORIZON) -> DataFrame:
    """The same of the labels that a panel gives, counted in the pass that makes them."""
    label = F.when(~in_default(), F.col(f"default_within_{horizon}"))
    return with_label(panel, horizon).agg(
        F.count(F.lit(1)).alias("n_panel"), F.count(label).alias("n_labels"), F.avg(label.cast("double")).alias("prevalence")
    )


def ever_default_rate(panel: DataFrame) -> DataFrame:
    """Share of credits that were in stage 3 at least once."""
    ever = panel.groupBy("credit_id").agg(F.max((F.col("stage") == 3).cast("int")).alias("ever"))
    return ever.agg(
        F.count(F.lit(1)).alias("n_credits"),
        F.sum("ever").alias("n_defaulted"),
        F.avg(F.col("ever").cast("double")).alias("default_rate"),
    )


def panel_facts(panel: DataFrame, date: str = "statement_date") -> DataFrame:
    """Rows, rows in stage 2 or 3 and whether there is one in stage 3, per date and per credit, from one scan.

    ``by`` is ``date`` or ``credit`` and says which of the two keys a row is
    about. Both groupings are folded on the map side, so only their partial
    sums are shuffled. What the report says of the panel is read from here, and
    so this is best stored.
    """
    degraded = F.count_if(F.col("stage") >= 2)
    known = F.count(F.col("stage"))
    sets = panel.groupingSets([[date], ["credit_id"]], date, "credit_id").agg(
        F.when(F.grouping(date) == 0, "date").otherwise("credit").alias("by"), F.count(F.lit(1)).alias("n"),
        known.alias("n_staged"), degraded.alias("n_degraded"), F.max((F.col("stage") == 3).cast("int")).alias("ever_default"),
    )
    return sets.select("by", date, "credit_id", "n", "n_staged", "n_degraded", "ever_default")


def stage_share_from(facts: DataFrame, date: str = "statement_date") -> DataFrame:
    """:func:`stage_share` of the panel that the facts are about."""
    share = F.when(F.col("n_staged") > 0, F.col("n_degraded") / F.col("n_staged")) * 100
    return facts.filter("by = 'date'").select(date, share.alias("pct_degraded")).orderBy(date)


def ever_default_rate_from(facts: DataFrame) -> DataFrame:
    """:func:`ever_default_rate` of the panel that the facts are about."""
    return facts.filter("by = 'credit'").agg(
        F.count(F.lit(1)).alias("n_credits"), F.sum("ever_default").alias("n_defaulted"),
        F.avg(F.col("ever_default").cast("double")).alias("default_rate"),
    )


def label_prevalence_from(facts: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """:func:`label_prevalence` of the panel that the facts are about and its labels."""
    n_panel = facts.filter("by = 'date'").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_panel")).scalar()
    return labels.agg(
        F.count(F.lit(1)).alias("n_labels"), F.avg(F.col(label).cast("double")).alias("prevalence")
    ).select(n_panel.alias("n_panel"), "n_labels", "prevalence")


def event_partitions(events: DataFrame) -> DataFrame:
    """Events in each country, year and month partition."""
    return events.groupBy("country_code", "year", "month").agg(F.count(F.lit(1)).alias("n_events"))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, which the windows and joins on them take for granted not to exist."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
