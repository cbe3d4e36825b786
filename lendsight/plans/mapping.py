"""The star-schema tables seen as credits.

Two views are used. *Activity*: a credit is a user of ``events`` and a period is
a day. *Monthly*: a credit is a row of ``orders`` and runs for some months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from lendsight.functions import rules
from lendsight.operators import behaviour, labels, model, panel as panels, portfolio, state
from lendsight.sources.buckets import stored_once

GRAIN = "day"
STRESSED_PART = 0.1
ONE_CREDIT = 7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- activity view -------------------------------------------------------------------


def activity_events(spark: SparkSession, folder: str, odd_statuses: bool = False) -> DataFrame:
    """Events in our vocabulary; signups, which no feature uses, are left out at the scan.

    ``odd_statuses`` gives some instalments no status and some one that is not among the usual three.
    """
    raw, digit = F.col("event_type"), F.col("digit")
    used = table(spark, folder, "events").filter(raw.isin("purchase", "click", "view", "error"))
    # A column of its own, so that the JSON is parsed once and only for instalments.
    parsed = F.when(raw == "purchase", F.get_json_object("props", "$.k").cast("int") % 10)
    return used.withColumn("digit", parsed).select(
        "event_id",
        F.when(raw == "purchase", "instalment")
        .when(raw == "error", "overdraft")
        .otherwise("movement")
        .alias("kind"),
        F.col("user_id").alias("credit_id"),
        F.to_date("ts").alias("event_date"),
        F.when(raw == "view", -F.col("value")).otherwise(F.col("value")).alias("amount"),
        (
            F.when(digit < 5, "on_time").when(digit == 5, "disputed").when(digit.isin(7, 8), "late").when(digit == 9, "unpaid")
            if odd_statuses
            else F.when(digit < 7, "on_time").when(digit < 9, "late").when(digit == 9, "unpaid")
        ).alias("due_status"),
    )


def activity_features(spark: SparkSession, folder: str) -> DataFrame:
    return behaviour.behaviour_features(activity_events(spark, folder), GRAIN, F.col("event_id"), known_only=True)


def history_events(spark: SparkSession, folder: str) -> DataFrame:
    """Seven years of events of customers: an instalment per order, account movements and overdrafts per line.

    Customers have months without any order, months with several, and orders without a status.
    """
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    orders = table(spark, folder, "orders")
    instalments = orders.select(
        (F.col("o_orderkey") * 8).alias("event_id"),
        F.lit("instalment").alias("kind"),
        F.col("o_custkey").alias("credit_id"),
        F.to_date("o_orderdate").alias("event_date"),
        F.col("o_totalprice").alias("amount"),
        F.when(number == 1, "unpaid").when(number == 2, "late").when(number > 3, "on_time").alias("due_status"),
    )
    owners = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("credit_id"))
    lines = table(spark, folder, "lineitem").join(owners, "l_orderkey").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("event_id"),
        F.when(F.col("l_linenumber") == 7, "overdraft").otherwise("movement").alias("kind"),
        "credit_id",
        F.to_date("l_shipdate").alias("event_date"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("amount"),
        F.lit(None).cast("string").alias("due_status"),
    )
    return instalments.unionByName(lines)


def history_features(spark: SparkSession, folder: str) -> DataFrame:
    return behaviour.behaviour_features(history_events(spark, folder), "month", F.col("event_id"), known_only=True)


def clients(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return (
        table(spark, folder, "customer")
        .join(nation, "c_nationkey")
        .select(F.col("c_custkey").alias("client_id"), "country", F.col("c_mktsegment").alias("client_type"))
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """One credit per customer, without terms."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(key.alias("credit_id"), key.alias("client_id"))


def activity_credits(spark: SparkSession, folder: str) -> DataFrame:
    """One credit per customer with orders, with the terms of the first order.

    The credit type is the digit its priority begins with: a number aggregates
    in a hash map where a text would need a sort.
    """
    user, first = F.col("o_custkey"), F.col("o_orderkey")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    return (
        table(spark, folder, "orders")
        .groupBy(user)
        .agg(F.min_by("o_totalprice", first).alias("principal"), F.min_by(digit, first).alias("digit"))
        .select(
            user.alias("credit_id"),
            user.alias("client_id"),
            "principal",
            F.concat(F.lit("P"), F.col("digit")).alias("credit_type"),
            (F.lit(6) + user % 31).alias("term_months"),
        )
    )


def _with_age(features: DataFrame) -> DataFrame:
    """Rows of a credit counted from 0; the window is the one of the features."""
    return features.withColumn("months_elapsed", F.row_number().over(Window.partitionBy("credit_id").orderBy("period")) - 1)


def stored_features(spark: SparkSession, folder: str) -> DataFrame:
    """Daily features in buckets of the credit."""
    return stored_once(spark, folder, "daily_features", lambda: _with_age(activity_features(spark, folder)))


def stored_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Daily panel in the same buckets."""
    return stored_once(
        spark, folder, "daily_panel", lambda: activity_panel(stored_features(spark, folder), activity_credits(spark, folder))
    )


def stored_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of the daily panel in the same buckets."""
    return stored_once(spark, folder, "daily_labels", lambda: activity_labels(stored_panel(spark, folder)))


def activity_panel(aged: DataFrame, credits: DataFrame) -> DataFrame:
    """Stage and balance per credit and day: thirty days past due for every late instalment in a row."""
    return _valued(aged.select("credit_id", "period", _days_late().alias("dpd"), "months_elapsed").join(credits, "credit_id"))


def _days_late() -> Column:
    return (30 * F.col("late_streak")).cast("int")


def _valued(rows: DataFrame) -> DataFrame:
    return rows.select(
        "credit_id",
        "client_id",
        "period",
        F.col("period").alias("statement_date"),
        "dpd",
        rules.stage_from_dpd(F.col("dpd")).alias("stage"),
        rules.outstanding_balance(F.col("principal"), F.col("term_months"), F.col("months_elapsed"), F.col("dpd")).alias("outstanding"),
    )


def activity_state(spark: SparkSession, folder: str) -> DataFrame:
    """State of every user, from the stored panel and features bucket by bucket."""
    panel, features = stored_panel(spark, folder), stored_features(spark, folder)
    return state.portfolio_state(panel, features, activity_credits(spark, folder), clients(spark, folder), panel_order="period")


def activity_labels(panel: DataFrame) -> DataFrame:
    return labels.default_labels(panel, order="period")


def activity_training_set(spark: SparkSession, folder: str) -> DataFrame:
    """Features and labels joined bucket by bucket."""
    return model.training_set(stored_features(spark, folder), stored_labels(spark, folder), grain=GRAIN)


def labelled_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Rule score, label and the alert taken as a prediction, per credit and day."""
    scored = portfolio.with_score(activity_training_set(spark, folder))
    return scored.select(
        "credit_id", "period", "score", model.LABEL, (F.col("score") >= rules.MEDIUM_ALERT).cast("int").alias("prediction")
    )


# --- monthly view --------------------------------------------------------------------


def order_credits(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias("credit_id"),
        F.col("o_custkey").alias("client_id"),
        F.col("o_totalprice").alias("principal"),
        F.col("o_orderpriority").alias("credit_type"),
        (F.lit(6) + key % 31).cast("int").alias("term_months"),
        ((key * 7) % 36).cast("int").alias("grant_month"),
    )


def latest_order_state(spark: SparkSession, folder: str) -> DataFrame:
    """Last panel row of every order with its expected loss."""
    last = state.latest_per_key(order_panel(spark, folder), "credit_id", "month_index", ["month_index", *state.PANEL_STATE])
    return last.withColumn("ecl", rules.expected_loss(F.col("outstanding"), F.col("stage")))


def _draw() -> Column:
    return (F.col("credit_id") * 13 + F.col("month_index") * 29) % 100


def panel_of(credits: DataFrame, cluster: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    draw = _draw()
    dpd = F.when(draw < 80, 0).when(draw < 92, 10).when(draw < 98, 45).otherwise(95)
    overdraft = F.when(draw % 7 == 0, F.rint(F.col("outstanding") * 0.25)).otherwise(0.0)
    return panels.credit_panel(credits, dpd, overdraft, cluster=cluster, keep=keep)


def order_panel(spark: SparkSession, folder: str, cluster: bool = False) -> DataFrame:
    return panel_of(order_credits(spark, folder), cluster)


def country_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of the nations of four regions; the fifth region has none on purpose, for events without a country folder."""
    code = F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    return (
        table(spark, folder, "nation")
        .filter(F.col("n_regionkey") < 4)
        .select(F.col("n_name").alias("country"), code.alias("country_code"))
    )


def order_events(spark: SparkSession, folder: str, by_folder: bool = False) -> DataFrame:
    # Spark takes the expanded panel for as small as the orders it comes from
    # and might broadcast it; a merge join never does.
    panel = panel_of if by_folder else order_panel(spark, folder, cluster=True).hint("merge")
    return panels.instalment_events(
        panel, order_credits(spark, folder), clients(spark, folder), country_codes(spark, folder), by_folder
    )


def client_profile(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("client_id"),
        F.col("c_acctbal").alias("monthly_income"),
        (1 + key % 180).cast("int").alias("bank_tenure_months"),
    )
