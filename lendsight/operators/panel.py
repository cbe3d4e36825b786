"""Monthly panel of a credit's life, and the events that follow from it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from lendsight.functions import rules
from lendsight.functions.keys import period_of, stable_id

# Fixed values.
PANEL_START = "2022-01-01"
PANEL_MONTHS = 36

PANEL_TABLE = [
    "credit_id",
    "client_id",
    "month_index",
    "dpd",
    "stage",
    "outstanding",
    "overdraft_amount",
    "statement_date",
]
# Shuffled bytes of credits that a task expands: each credit becomes events of up to PANEL_MONTHS months.
CREDITS_OF_A_TASK = "4m"
# What an event is made of.
EVENT_SOURCE = [
    "credit_id",
    "client_id",
    "month_index",
    "dpd",
    "overdraft_amount",
    "statement_date",
    "principal",
    "term_months",
    "country_code",
]


def active_months(credits: DataFrame, horizon: int = PANEL_MONTHS) -> DataFrame:
    """One row per credit and month in which it runs, with the months elapsed since the grant."""
    end = F.least(F.col("grant_month") + F.col("term_months"), F.lit(horizon))
    return (
        credits.filter(end > F.col("grant_month"))
        .withColumn("month_index", F.explode(F.sequence(F.col("grant_month"), end - 1)))
        .withColumn("months_elapsed", F.col("month_index") - F.col("grant_month"))
    )


def statement_date(month_index: Column, start: str = PANEL_START, thirty_day_steps: bool = False) -> Column:
    """Statement date of a month: the calendar month by default, or fixed steps of thirty days.

    Thirty-day steps put two statements into some calendar months and none into others.
    """
    first = F.to_date(F.lit(start))
    return F.date_add(first, month_index * 30) if thirty_day_steps else F.add_months(first, month_index)


def credit_panel(
    credits: DataFrame,
    dpd: Column | DataFrame,
    overdraft_amount: Column | None = None,
    start: str = PANEL_START,
    horizon: int = PANEL_MONTHS,
    thirty_day_steps: bool = False,
    cluster: bool | int = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Days past due, stage and balance of every credit in every month it runs.

    ``dpd`` is an expression over the credit and ``month_index``, or a table
    (credit_id, month_index, dpd), which must have a row for every month of a
    credit: a month without one is an error, since a gap would shift every
    later window. ``cluster`` shuffles the credits before the expansion, so
    that later windows and joins per credit need no shuffle of the many panel
    rows; a number asks for that many partitions, True for the session's
    number of shuffle partitions. Up to ``horizon`` rows come of each credit,
    so size the partitions by the panel, not by the credits. ``keep`` names
    further columns of the credits that every month shows.
    """
    if cluster:
        # A fixed number: adaptive execution sizes partitions by the credits it
        # shuffles and would merge what the expansion then multiplies.
        given = credits.sparkSession.conf.get("spark.sql.shuffle.partitions")
        credits = credits.repartition(int(given) if cluster is True else cluster, "credit_id")
    months = active_months(credits, horizon)
    if isinstance(dpd, DataFrame):
        # Spark takes the expanded months for as small as the credits and might
        # broadcast them; a merge join never does.
        days = dpd.select("credit_id", "month_index", "dpd")
        missing = F.concat_ws(" ", F.lit("no days past due for credit"), F.col("credit_id").cast("string"), F.lit("in month"), F.col("month_index").cast("string"))
        months = months.hint("merge").join(days, ["credit_id", "month_index"], "left")
        months = months.withColumn("dpd", F.coalesce("dpd", F.raise_error(missing).cast("int")))
    else:
        months = months.withColumn("dpd", dpd.cast("int"))
    months = months.withColumn("stage", rules.stage_from_dpd(F.col("dpd"))).withColumn(
        "outstanding",
        rules.outstanding_balance(F.col("principal"), F.col("term_months"), F.col("months_elapsed"), F.col("dpd")),
    )
    overdraft = F.lit(0.0) if overdraft_amount is None else overdraft_amount
    return (
        months.withColumn("overdraft_amount", overdraft.cast("double"))
        .withColumn("statement_date", statement_date(F.col("month_index"), start, thirty_day_steps))
        .select(*PANEL_TABLE, *keep)
    )


def credit_terms(credits: DataFrame, clients: DataFrame, countries: DataFrame) -> DataFrame:
    """Terms of every credit with the client's country and country code; NULL for a country that ``countries`` does not list."""
    located = clients.select("client_id", "country").join(countries.select("country", "country_code"), "country", "left")
    terms = credits.select("credit_id", "client_id", "principal", "term_months").join(located, "client_id")
    return terms.drop("client_id")


def enriched_panel(panel: DataFrame, credits: DataFrame, clients: DataFrame, countries: DataFrame) -> DataFrame:
    """Panel rows with the credit's terms and the client's country and country code.

    Countries meet clients and clients meet credits before the panel is joined:
    the keys that few values share (country, client) are then joined at one row
    per client or credit, and the panel only on the credit, which repeats at
    most once a month. A country that ``countries`` does not list has a NULL code.
    """
    return panel.join(credit_terms(credits, clients, countries), "credit_id")


def expanded_panel(
    expand: Callable[..., DataFrame], credits: DataFrame, clients: DataFrame, countries: DataFrame, by_country: bool = False
) -> DataFrame:
    """Panel that ``expand`` makes of the credits, with terms and country code: the rows of ``enriched_panel``.

    The credits are joined before they are expanded, so that no row of the panel
    is shuffled. ``by_country`` brings the credits of a country together, in order.
    """
    terms = credit_terms(credits, clients, countries)
    terms = terms.select("credit_id", F.struct("principal", "term_months").alias("terms"), "country_code")
    joined = credits.join(terms, "credit_id")
    if by_country:
        joined = joined.hint("rebalance", "country_code").sortWithinPartitions("country_code", "credit_id")
    return expand(joined, keep=("terms", "country_code")).select(*PANEL_TABLE, "terms.*", "country_code")


def instalment_events(
    panel: DataFrame | Callable[..., DataFrame],
    credits: DataFrame,
    clients: DataFrame,
    countries: DataFrame,
    by_folder: bool = False,
) -> DataFrame:
    """Instalment event of every panel row, plus an overdraft event where the panel shows one.

    ``panel`` is a table or a function that makes it of the credits and keeps
    the columns named by ``keep``, as ``credit_panel`` does.
    ``by_folder`` brings the rows of a country and month together for ``write_events``.
    The panel's numbers are shuffled for that and not the events, whose ids no
    codec makes smaller; before an expansion it is the credits, by country, and
    a task then makes the events of all months of its credits.
    """
    both = F.array(F.lit("instalment"), F.lit("overdraft"))
    one = F.array(F.lit("instalment"))
    due = F.col("kind") == "instalment"
    if isinstance(panel, DataFrame):
        rows = enriched_panel(panel, credits, clients, countries).select(*EVENT_SOURCE)
        if by_folder:
            rows = rows.withColumn("period", period_of(F.col("statement_date"))).hint("rebalance", "country_code", "period")
    else:
        rows = expanded_panel(panel, credits, clients, countries, by_country=by_folder).select(*EVENT_SOURCE)
    if by_folder:
        # One number as the key, and no text in the rows but the code: a task then writes folder after folder.
        rows = rows.sortWithinPartitions("statement_date")
    return (
        rows.withColumn("kind", F.explode(F.when(F.col("overdraft_amount") > 0, both).otherwise(one)))
        .select(
            stable_id("EVT", F.col("credit_id"), F.col("month_index"), F.col("kind")).alias("event_id"),
            "kind",
            "credit_id",
            "client_id",
            F.col("statement_date").alias("event_date"),
            F.when(due, rules.instalment_amount(F.col("principal"), F.col("term_months")))
            .otherwise(F.col("overdraft_amount"))
            .alias("amount"),
            F.when(due, rules.due_status_from_dpd(F.col("dpd"))).alias("due_status"),
            "country_code",
            F.year("statement_date").alias("year"),
            F.month("statement_date").alias("month"),
        )
    )
