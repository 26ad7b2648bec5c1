"""Change-event operators: signing, quality rules, statement-line balances."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline.functions import event_timestamp, money_sum, signed_amount, summable
from ledgerline.operators.history import MONEY, opening_balances

ACCOUNT = "account_id"


def signed(cdc: DataFrame) -> DataFrame:
    """Adds ``normalized_amount`` (sign from the type), ``event_ts`` and the
    day key ``partition_date``. Row-local: no shuffle, stays in codegen."""
    ts = event_timestamp("event_time", cdc.schema["event_time"].dataType)
    return cdc.select(
        "*",
        signed_amount("amount", "transaction_type").alias("normalized_amount"),
        ts.alias("event_ts"),
        F.to_date(ts).alias("partition_date"))


# --- data-quality rules -----------------------------------------------------

def missing_columns(cdc: DataFrame) -> list[str]:
    return [f for f in K.REQUIRED_FIELDS if f not in cdc.columns]


def _message(template: str, count_col):
    prefix, suffix = template.split("{count}")
    return F.when(count_col > 0, F.concat(F.lit(prefix), count_col.cast("string"), F.lit(suffix)))


def quality_report(cdc: DataFrame) -> DataFrame:
    """All rules in one aggregate over one scan, unpivoted to one row per
    rule: ``rule_id, rule, violations, message`` (message NULL when clean).

    NULL amounts or types never count as a created-with-amount or negative
    inflow violation; only the NULL rule sees them.
    """
    missing = missing_columns(cdc)
    if missing:
        raise ValueError(K.MSG_MISSING_COLUMNS.format(missing=missing))
    t = F.col("transaction_type") if "transaction_type" in cdc.columns else F.lit(None).cast("string")
    a = F.col("amount")
    any_null = reduce(lambda x, y: x | y, [F.col(c).isNull() for c in K.REQUIRED_FIELDS])
    counts = cdc.agg(
        F.count_if((t == K.WALLET_CREATED) & (F.abs(a) > F.lit(K.CREATED_AMOUNT_TOLERANCE))).alias("v1"),
        F.count_if(t.isin(*K.INFLOW_TYPES) & (a < F.lit(0))).alias("v2"),
        F.count_if(any_null).alias("v4"),
    )
    rows = counts.select(F.stack(
        F.lit(3),
        F.lit("V1"), F.lit("created_with_amount"), F.col("v1"),
        F.lit("V2"), F.lit("negative_inflow"), F.col("v2"),
        F.lit("V4"), F.lit("null_required"), F.col("v4"),
    ).alias("rule_id", "rule", "violations"))
    v = F.col("violations")
    message = (F.when(F.col("rule_id") == "V1", _message(K.MSG_CREATED_WITH_AMOUNT, v))
               .when(F.col("rule_id") == "V2", _message(K.MSG_NEGATIVE_INFLOW, v))
               .otherwise(_message(K.MSG_NULL_REQUIRED, v)))
    return rows.withColumn("message", message)


def validate(cdc: DataFrame) -> tuple[bool, list[str]]:
    """``(valid, messages)``; one Spark job, three result rows to the driver."""
    missing = missing_columns(cdc)
    if missing:
        cdc = cdc.withColumns({c: F.lit(None).cast("string" if c != "amount" else "double") for c in missing})
    rows = sorted(quality_report(cdc).collect(), key=lambda r: r["rule_id"])  # three rows
    messages = [r["message"] for r in rows if r["message"] is not None and not (missing and r["rule_id"] == "V4")]
    if missing:  # the value rules report together with it; nulls cannot be judged
        messages.append(K.MSG_MISSING_COLUMNS.format(missing=missing))
    return not messages, messages


def unparsed_times(cdc: DataFrame) -> DataFrame:
    """One row: events whose text time is given but does not parse (``events``).
    They pass the rules and stay in the feed without a day."""
    ts = event_timestamp("event_time", cdc.schema["event_time"].dataType)
    return cdc.agg(F.count_if(F.col("event_time").isNotNull() & ts.isNull()).alias("events"))


def require_valid(cdc: DataFrame) -> DataFrame:
    ok, messages = validate(cdc)
    if not ok:
        raise ValueError("\n".join(messages))
    return cdc


# --- statement-line running balance ----------------------------------------

# Bucket units must nest inside a day, so a bucket never spans two days.
BUCKET_UNITS = ("day", "hour", "minute", "second")

def running_balance(sg: DataFrame, tie: str, bucket: str = "minute",
                    opening: DataFrame | None = None) -> DataFrame:
    """Running balance after every event, ordered by ``(event_ts, tie)``.

    A window partitioned by account alone would put a hot account (up to a
    third of all events) into one task. The prefix sum is split in two:

    1. the events, dealt once by (account, time bucket), get a running sum
       inside their bucket; its last value is the bucket's sum;
    2. the buckets' sums, one row each, get their exclusive prefix per account
       and come back to their events by an equi-join. That window sorts one
       row per active bucket, so a hot account costs at most one row per
       minute of its life, however many events it has.

    One scan and one exchange of the events: both sides of the join read it
    (the local sort names every column, so that both sides need the same
    ones; columns that cannot be sorted would make it two). Select the columns
    you need before. No task ever holds more than one bucket of one account.
    ``bucket`` is a ``date_trunc`` unit no coarser than a day; finer units cut
    hot accounts into smaller pieces. Decimal amounts are summed exactly; the
    balance is returned as a double. Every event keeps its row: those without
    a time come first in their account, those without an account are one
    account.

    ``opening``: a balance state (``history.account_state``); its balance
    starts every account's prefix, so statement lines of the events after
    the state's day need no older events. Events up to the state's day are
    left out (they are already in the state).
    """
    if tie not in sg.columns:
        raise ValueError(f"tie column {tie!r} not in input")
    if bucket not in BUCKET_UNITS:
        raise ValueError(f"bucket must be one of {BUCKET_UNITS}, not {bucket!r}")
    if opening is not None:
        first = opening.select("as_of").first()     # one row: the state's day
        if first is not None and first["as_of"] is not None:
            after = (first["as_of"] + _dt.timedelta(days=1)).isoformat()
            sg = sg.filter(F.col("event_ts") >= F.lit(f"{after} 00:00:00").cast(
                sg.schema["event_ts"].dataType))
    m, _ = summable("normalized_amount", sg.schema["normalized_amount"].dataType)
    # one key for exchange, windows and join; NULL accounts and times are equal in it
    key = F.struct(F.col(ACCOUNT).alias("account"), F.date_trunc(bucket, "event_ts").alias("bucket"))
    ev = sg.withColumns({MONEY: m, "_key": key})
    money, before = ev.schema[MONEY].dataType, Window.unboundedPreceding
    rest = [f.name for f in ev.schema.fields if f.name not in ("_key", "event_ts", tie) and isinstance(
        f.dataType, (T.AtomicType, T.NullType))]
    dealt = ev.repartition("_key").sortWithinPartitions("_key", "event_ts", tie, *rest)
    in_bucket = Window.partitionBy("_key").orderBy("event_ts", tie)
    lines = dealt.withColumns({
        "_sum": money_sum(MONEY, in_bucket.rowsBetween(before, Window.currentRow)),
        "_more": F.lead(F.lit(True)).over(in_bucket)})
    buckets = lines.filter("_more IS NULL").select("_key", "_sum", F.lit(True).alias("_event"))
    if opening is not None:     # the opening balance precedes every bucket
        none = F.lit(None).cast(ev.schema["_key"].dataType["bucket"].dataType)
        buckets = buckets.unionByName(opening_balances(opening, money).select(
            F.struct(F.col(ACCOUNT).alias("account"), none.alias("bucket")).alias("_key"),
            F.col(MONEY).cast(lines.schema["_sum"].dataType).alias("_sum"), F.lit(False).alias("_event")))
    earlier = Window.partitionBy("_key.account").orderBy("_event", "_key.bucket").rowsBetween(before, -1)
    offsets = (buckets.withColumn("_offset", money_sum("_sum", earlier)).filter("_event")
               .select("_key", "_offset"))
    zero = F.lit(0).cast(money)
    out = lines.join(offsets, "_key", "left").withColumn("running_balance", (
        F.coalesce("_offset", zero) + F.coalesce("_sum", zero)).cast("double"))
    return out.select(*sg.columns, "running_balance")
