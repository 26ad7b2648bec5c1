"""Eligibility, interest, payment rows and the audit trail."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import daily_interest, first_non_empty
from ledgerline.plans.broadcast import broadcast_if_bounded

# Upper bound on rate rows that may be broadcast; beyond it the join falls
# back to a shuffle join on the day, whose per-day skew (every account of a
# day meets one rate row) adaptive execution's skew-join handling splits
# (``spark.sql.adaptive.skewJoin.enabled``). Rates hold one row per business
# day, so a run window of decades stays far below the bound.
MAX_BROADCAST_RATE_ROWS = 200_000


def decide(history: DataFrame, rates: DataFrame,
           min_balance: float = K.DEFAULT_MIN_BALANCE,
           decimals: int = K.DEFAULT_DECIMALS,
           broadcast_rates: bool | None = None, unique_rates: bool = False) -> DataFrame:
    """Inner join of history and rates on the day (days without a rate get
    no row), then the eligibility decision for every account-day:
    ``qualified``, ``reason`` and ``interest_amount`` (0.0 when not
    qualified). The decision frame feeds both payments and audit.

    ``broadcast_rates``: None checks the rate rows against
    ``MAX_BROADCAST_RATE_ROWS`` (one small counting job) and broadcasts them
    only below it; True/False force the choice without a job.
    ``unique_rates=True`` fails the run when a day has two rate rows; by
    default each of them pays.
    """
    rates = rates.select("partition_date", "cdi_rate")
    if unique_rates:
        one = F.count(F.lit(1)) == 1
        rates = rates.groupBy("partition_date").agg(F.when(one, F.max("cdi_rate")).otherwise(
            F.raise_error(F.lit("a day has two rates"))).alias("cdi_rate"))
    if broadcast_rates is None:
        rates = broadcast_if_bounded(rates, MAX_BROADCAST_RATE_ROWS)
    elif broadcast_rates:
        rates = F.broadcast(rates)
    joined = history.join(rates, "partition_date", "inner")
    qualified = F.col("immovable_balance") >= F.lit(float(min_balance))
    reason = F.when(qualified, F.lit(K.REASON_QUALIFIED)).otherwise(
        F.lit(K.below_threshold_reason(min_balance)))
    interest = F.when(qualified, daily_interest("immovable_balance", "cdi_rate", decimals)) \
        .otherwise(F.lit(0.0))
    return joined.select(
        "user_id", "account_id", "partition_date",
        F.col("immovable_balance").cast("double").alias("immovable_balance"),
        F.col("cdi_rate").cast("double").alias("cdi_rate"),
        qualified.alias("qualified"), reason.alias("reason"),
        interest.cast("double").alias("interest_amount"))


def payments(decision: DataFrame) -> DataFrame:
    """Payment rows: the rate is the annual fraction, unpaid, no pay date."""
    return decision.select(
        "user_id", "account_id",
        F.col("immovable_balance").alias("eligible_balance"),
        F.col("cdi_rate").alias("interest_rate"),
        "interest_amount",
        F.lit(False).alias("is_paid"),
        F.lit(None).cast("string").alias("payment_date"),
        "partition_date")


def audit_rows(decision: DataFrame) -> DataFrame:
    """Audit projection of the decision, before run stamps and defaults."""
    return decision.select(
        "user_id", "account_id", "qualified", "reason",
        F.col("immovable_balance").alias("relevant_balance"),
        F.col("interest_amount").alias("calculated_interest"),
        F.col("cdi_rate").alias("interest_rate"),
        F.lit(K.STATUS_SUCCESS).alias("process_status"),
        F.lit(None).cast("string").alias("error_description"),
        "partition_date")


def _ts_text(ts: _dt.datetime | str) -> str:
    """Wall-clock text of the run time: independent of any time zone."""
    return ts if isinstance(ts, str) else ts.isoformat(sep=" ")


def with_audit_defaults(rows: DataFrame, job_id: str, job_timestamp: _dt.datetime,
                        partition_date: str | None = None) -> DataFrame:
    """Stamps the run id and time on every row and fills gaps: empty or NULL
    user, account, reason and status take a label, NULL numbers take 0.0.
    ``partition_date`` overrides the day of every row when given.
    Column expressions only, so the step stays inside whole-stage codegen."""
    day = F.col("partition_date") if partition_date is None else F.lit(partition_date).cast("date")
    zero = F.lit(0.0)
    return rows.select(
        F.lit(job_id).alias("job_id"),
        F.lit(_ts_text(job_timestamp)).cast("timestamp_ntz").alias("job_timestamp"),
        first_non_empty("user_id", K.UNKNOWN_USER).alias("user_id"),
        first_non_empty("account_id", K.UNKNOWN_ACCOUNT).alias("account_id"),
        "qualified",
        first_non_empty("reason", K.NO_REASON).alias("reason"),
        F.coalesce(F.col("relevant_balance").cast("double"), zero).alias("relevant_balance"),
        F.coalesce(F.col("calculated_interest").cast("double"), zero).alias("calculated_interest"),
        F.coalesce(F.col("interest_rate").cast("double"), zero).alias("interest_rate"),
        first_non_empty("process_status", K.UNKNOWN_STATUS).alias("process_status"),
        F.col("error_description").cast("string").alias("error_description"),
        day.alias("partition_date"))


def audit(decision: DataFrame, job_id: str, job_timestamp: _dt.datetime,
          partition_date: str | None = None) -> DataFrame:
    return with_audit_defaults(audit_rows(decision), job_id, job_timestamp, partition_date)
