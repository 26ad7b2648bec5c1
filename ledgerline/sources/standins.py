"""Stand-in inputs derived from the supplied tables.

There is no wallet table in the supplied data; the ``events`` table maps
one-to-one onto change events (one account per ``user_id``, some with two
users, five event types onto five transaction types). Rates are derived from the calendar the
events span, so every input grows with the data it is built from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"

# Stand-in mapping of event types onto transaction types (fixture values).
EVENT_TYPE_MAP = (
    ("signup", "WALLET_CREATED"),
    ("click", "DEPOSIT"),
    ("view", "TRANSFER_IN"),
    ("purchase", "WITHDRAWAL"),
)
OTHER_EVENT_TYPE = "TRANSFER_OUT"
USERS_PER_ACCOUNT_KEY = 50
# Every fourth account has a second user, on every third of its events.
SHARED_ACCOUNT_EVERY, SECOND_USER_EVERY = 4, 3
UNPARSEABLE_RATE_DAY = 17


def cdc_from_events(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    kind = F.when(et == EVENT_TYPE_MAP[0][0], EVENT_TYPE_MAP[0][1])
    for src, dst in EVENT_TYPE_MAP[1:]:
        kind = kind.when(et == src, dst)
    kind = kind.otherwise(OTHER_EVENT_TYPE)
    shared = (F.col("user_id") % SHARED_ACCOUNT_EVERY == 0) & (F.col("event_id") % SECOND_USER_EVERY == 0)
    second = F.when(shared, USERS_PER_ACCOUNT_KEY).otherwise(0)
    amount = F.when(et == "signup", F.lit(0).cast(MONEY)).otherwise(F.col("value").cast(MONEY))
    return events.select(
        F.col("user_id").cast("string").alias("account_id"),
        F.concat(F.lit("u"), (F.col("user_id") % USERS_PER_ACCOUNT_KEY + second).cast("string")).alias("user_id"),
        kind.alias("transaction_type"),
        amount.alias("amount"),
        F.col("ts").alias("event_time"),
        "event_id")


def dirty_cdc(cdc: DataFrame) -> DataFrame:
    """The same rows with NULL keys, NULL amounts, created-with-amount and
    negated amounts sprinkled in by event id, for the quality rules."""
    eid = F.col("event_id")
    amount = (F.when(eid % 103 == 0, F.lit(None).cast(MONEY))
              .when((F.col("transaction_type") == "WALLET_CREATED") & (eid % 7 == 0), F.lit(5).cast(MONEY))
              .when(eid % 11 == 0, -F.col("amount"))
              .otherwise(F.col("amount")))
    return cdc.select(
        F.when(eid % 101 == 0, F.lit(None).cast("string")).otherwise(F.col("account_id")).alias("account_id"),
        "user_id", "transaction_type", amount.alias("amount"), "event_time", "event_id")


def rates_raw_from_events(events: DataFrame) -> DataFrame:
    """One feed row per weekday of the span the events cover, as the feed
    delivers them: day-first date text and a percent as text; one day of
    the month carries an unparseable value."""
    span = events.agg(F.min(F.to_date("ts")).alias("s"), F.max(F.to_date("ts")).alias("e"))
    days = span.select(F.explode(F.sequence("s", "e")).alias("d")).filter(F.weekday("d") < 5)
    valor = F.when(F.dayofmonth("d") == UNPARSEABLE_RATE_DAY, F.lit("n/d")).otherwise(
        F.expr("CAST(CAST(10.40 + 0.05 * (day(d) % 5) AS DECIMAL(6,2)) AS STRING)"))
    return days.select(F.date_format("d", "dd/MM/yyyy").alias("data"), valor.alias("valor"))


def audit_with_gaps(audit_rows: DataFrame) -> DataFrame:
    """Audit projection with missing users, balances and statuses."""
    k = F.col("account_id").cast("bigint")
    return audit_rows.withColumns({
        "user_id": F.when(k % 7 == 0, F.lit(None).cast("string"))
                    .when(k % 7 == 1, F.lit("")).otherwise(F.col("user_id")),
        "relevant_balance": F.when(k % 5 == 0, F.lit(None).cast("double"))
                             .otherwise(F.col("relevant_balance")),
        "process_status": F.when(k % 11 == 0, F.lit(None).cast("string"))
                           .otherwise(F.col("process_status")),
    })
