"""Raw events folded into one row per credit and period.

Events come with ``event_id, kind, credit_id, event_date, amount, due_status``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lendsight.functions.keys import cents, from_cents, period_of

USED_KINDS = ("instalment", "movement", "overdraft")

# The order of an instalment and its status are one BIGINT; where its amount is asked for, that is part of a wider number.
# A status travels through the aggregation as one of eight codes.
_STATUS_CODES = {"on_time": 0, "late": 1, "unpaid": 2}
_MISSING, _OTHER = 3, 4
_SLOTS = 8

LAST = 2**60 - 1
# Below the order and the status, the amount: of instalments with one order key the smallest amount is first.
_AMOUNTS = 10**19

# With a list of unusual statuses each has a code of its own. The number then gives the status two more digits and
# the amount, which only decides between equal order keys, two fewer.
_LISTED_SLOTS = 864
_LISTED_AMOUNTS = 10**17
MOST_STATUSES = _LISTED_SLOTS - _OTHER


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(20,0)")


def _is_other(status: Column) -> Column:
    return status.isNotNull() & ~status.isin(*_STATUS_CODES)


def _status_code(status: Column, other: Column | None) -> Column:
    """Code of a status; ``other`` is the code of an unusual one, and one without a code is an error."""
    code = F.when(status.isNull(), F.lit(_MISSING))
    for name, number in _STATUS_CODES.items():
        code = code.when(status == name, F.lit(number))
    unknown = F.raise_error(F.concat(F.lit("unknown status of an instalment: "), status)).cast("int")
    return code.otherwise(unknown if other is None else F.coalesce(other, unknown))


def _status_name(code: Column) -> Column:
    name = None
    for text, number in _STATUS_CODES.items():
        name = F.when(code == number, F.lit(text)) if name is None else name.when(code == number, F.lit(text))
    return name


def _arrival_order() -> Column:
    # Earliest day of the period first; within a day a stable order by hashed id.
    return F.dayofmonth("event_date").cast("bigint") * F.lit(2**52) + F.pmod(F.xxhash64("event_id"), F.lit(2**52))


def _checked_order(order_by: Column | None) -> Column:
    """The order of instalments; one without a key comes last, one outside the range is an error."""
    order = _arrival_order() if order_by is None else order_by.cast("bigint")
    outside = F.raise_error(F.concat(F.lit("order key outside 0..2**60 - 2: "), order.cast("string"))).cast("bigint")
    return F.when(order.isNull(), F.lit(LAST)).when((order >= 0) & (order < LAST), order).otherwise(outside)


def _first_place(order_by: Column | None, other: Column | None) -> Column:
    """Order and status of an instalment in one BIGINT, at most 2**63 - 1."""
    return _checked_order(order_by) * _SLOTS + _status_code(F.col("due_status"), other)


def _first_due(order_by: Column | None, other: Column | None, slots: int = _SLOTS, amounts: int = _AMOUNTS) -> Column:
    """Order, status and amount of an instalment in one number, so that min() yields one row's values."""
    if slots == _SLOTS:
        place = _first_place(order_by, other).cast("decimal(19,0)")
    else:
        order, code = _checked_order(order_by), _status_code(F.col("due_status"), other)
        place = (order.cast("decimal(19,0)") * _whole(slots) + code.cast("decimal(4,0)")).cast("decimal(21,0)")
    bound = amounts // 2 - 1
    amount = F.least(F.greatest(F.col("amount_cents"), _whole(-bound)), _whole(bound)).cast("decimal(20,0)")
    return (place * _whole(amounts) + (amount + _whole(bound + 1)).cast("decimal(20,0)")).cast("decimal(38,0)")


def _listed_code() -> Column:
    slots, amounts = _LISTED_SLOTS, _LISTED_AMOUNTS
    return F.expr(f"(first_due % CAST('{slots * amounts}' AS DECIMAL(21,0))) div CAST('{amounts}' AS DECIMAL(20,0))")


def _first_status(other: Column | None) -> Column:
    code = F.col("first_place") % _SLOTS
    name = _status_name(code)
    return name if other is None else name.when(code == _OTHER, other)


def is_unusual(kind: Column, status: Column) -> Column:
    """True for an instalment whose status is none of the three usual ones and is not missing."""
    return (kind == "instalment") & F.coalesce(_is_other(status), F.lit(False))


def unusual_statuses(events: DataFrame) -> list[str]:
    """The statuses of instalments outside the three usual ones, in order; more than ``MOST_STATUSES`` are an error.

    Reads two columns of ``events`` and sends one row per different status to the driver, at most the limit and one.
    """
    others = events.filter(is_unusual(F.col("kind"), F.col("due_status"))).select("due_status").distinct()
    found = sorted(row[0] for row in others.limit(MOST_STATUSES + 1).collect())
    if len(found) > MOST_STATUSES:
        raise ValueError(f"more than {MOST_STATUSES} different statuses of instalments")
    return found


def _status_list(events: DataFrame, statuses: list[str]) -> DataFrame:
    """(text, code) of the listed statuses, a few hundred rows at most."""
    if len(set(statuses)) > MOST_STATUSES:
        raise ValueError(f"more than {MOST_STATUSES} different statuses")
    listed = events.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(s) for s in sorted(set(statuses))])).alias("at", "text"))
    return F.broadcast(listed.select("text", (F.col("at") + _OTHER).alias("code")))


def _activity_by_list(events: DataFrame, grain: str, order_by: Column | None, statuses: list[str]) -> DataFrame:
    """Activity with the listed statuses as numbers within the aggregation and as texts after it."""
    listed = _status_list(events, statuses)
    kind, width = F.col("kind"), (_LISTED_SLOTS, _LISTED_AMOUNTS)
    used = events.filter(kind.isin(*USED_KINDS))
    coded = used.join(listed.withColumnsRenamed({"text": "_text", "code": "_code"}), F.col("due_status") == F.col("_text"), "left")
    prepared = coded.withColumn("period", period_of(F.col("event_date"), grain)).withColumn("amount_cents", cents(F.col("amount")))
    prepared = prepared.withColumn("first_due", F.when(kind == "instalment", _first_due(order_by, F.col("_code"), *width)))
    folded = _folded(prepared, "first_due").withColumn("_first", _listed_code().cast("int"))
    named = folded.join(listed.withColumnRenamed("code", "_first"), "_first", "left")
    return _activity_columns(named, F.coalesce(_status_name(F.col("_first")), F.col("text")))


def _folded(prepared: DataFrame, first: str, *more: Column) -> DataFrame:
    """One row per credit and period that has an instalment; ``first`` is the number whose minimum tells the first one."""
    kind = F.col("kind")
    aggregates = [
        F.min(first).alias(first),
        F.min_by("amount_cents", "first_due").alias("due_cents"),
        F.sum(F.when(kind == "movement", F.col("amount_cents"))).alias("movement_cents"),
        F.sum(F.when(kind == "overdraft", F.col("amount_cents"))).alias("overdraft_cents"),
        *more,
    ]
    return prepared.groupBy("credit_id", "period").agg(*aggregates).filter(F.col(first).isNotNull())


def _activity_columns(folded: DataFrame, status: Column) -> DataFrame:
    return folded.select(
        "credit_id",
        "period",
        status.alias("due_status"),
        from_cents(F.col("due_cents")).alias("due_amount"),
        from_cents(F.coalesce("movement_cents", F.lit(0))).alias("net_movement"),
        from_cents(F.coalesce("overdraft_cents", F.lit(0))).alias("overdraft_amount"),
    )


def period_activity(
    events: DataFrame,
    grain: str = "month",
    order_by: Column | None = None,
    known_only: bool = False,
    statuses: list[str] | None = None,
) -> DataFrame:
    """First instalment, net movement and overdraft per credit and period, in one scan and one shuffle.

    A period counts only if it holds an instalment. ``order_by`` is a BIGINT of
    0 to 2**60 - 2 that says which instalment of a period is first; of equal
    ones it is the one with the first status (usual ones, none, others), then
    the smallest amount.

    A status outside the three usual ones keeps its text. ``statuses`` lists
    such texts (see :func:`unusual_statuses`); they travel as numbers, so that
    every aggregation buffer has a fixed width and partial sums run in hash
    maps on the map side. With ``known_only``, the same with an empty list, and
    for a text that is not listed, such a status is an error. Without either
    the text itself is a buffer and makes Spark aggregate by sorting. A credit
    with very many events reaches the shuffle as one row per period and task
    in each case.
    """
    if statuses:
        return _activity_by_list(events, grain, order_by, statuses)
    known_only = known_only or statuses is not None
    kind = F.col("kind")
    unlisted = None if known_only else F.lit(_OTHER)
    prepared = (
        events.filter(kind.isin(*USED_KINDS))
        .withColumn("period", period_of(F.col("event_date"), grain))
        .withColumn("amount_cents", cents(F.col("amount")))
        .withColumn("first_place", F.when(kind == "instalment", _first_place(order_by, unlisted)))
        .withColumn("first_due", F.when(kind == "instalment", _first_due(order_by, unlisted)))
    )
    if known_only:
        return _activity_columns(_folded(prepared, "first_place"), _first_status(None))
    other = F.when(F.col("first_due").isNotNull() & _is_other(F.col("due_status")), F.struct("first_due", "due_status"))
    return _activity_columns(_folded(prepared, "first_place", F.min(other).alias("other")), _first_status(F.col("other.due_status")))


def period_activity_joined(events: DataFrame, grain: str = "month", order_by: Column | None = None) -> DataFrame:
    """The same table as three aggregates and two left joins.

    Reads the events three times; kept for comparison with :func:`period_activity`.
    """
    keys = ["credit_id", "period"]
    dated = events.withColumn("period", period_of(F.col("event_date"), grain)).withColumn(
        "amount_cents", cents(F.col("amount"))
    )
    other = F.when(_is_other(F.col("due_status")), F.struct("first_due", "due_status"))
    instalments = (
        dated.filter(F.col("kind") == "instalment")
        .withColumn("first_place", _first_place(order_by, F.lit(_OTHER)))
        .withColumn("first_due", _first_due(order_by, F.lit(_OTHER)))
        .groupBy(*keys)
        .agg(F.min("first_place").alias("first_place"), F.min_by("amount_cents", "first_due").alias("due_cents"), F.min(other).alias("other"))
        .select(
            *keys, _first_status(F.col("other.due_status")).alias("due_status"), from_cents(F.col("due_cents")).alias("due_amount")
        )
    )

    def total(kind: str, name: str) -> DataFrame:
        return dated.filter(F.col("kind") == kind).groupBy(*keys).agg(from_cents(F.sum("amount_cents")).alias(name))

    return (
        instalments.join(total("movement", "net_movement"), keys, "left")
        .join(total("overdraft", "overdraft_amount"), keys, "left")
        .fillna(0.0, ["net_movement", "overdraft_amount"])
    )
