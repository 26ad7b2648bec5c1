"""Daily rollup, day-over-day balances and the dense daily history."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import calendar, date_lit, immovable, money_sum, summable, validate_dates

ACCOUNT = "account_id"
USER = "user_id"
DAY = "partition_date"
MONEY_OUT = ("balance", "balance_previous", "immovable_balance",
             "total_deposits", "total_withdrawals")
HISTORY_COLUMNS = ("account_id", "user_id", "balance", "balance_previous",
                   "immovable_balance", "last_movement_ts", "total_deposits",
                   "total_withdrawals", "transactions_count", "partition_date")


MONEY = "_money"


def with_money(sg: DataFrame) -> DataFrame:
    """Adds the signed amount ready to be summed (see ``summable``)."""
    m, _ = summable("normalized_amount", sg.schema["normalized_amount"].dataType)
    return sg.select("*", m.alias(MONEY))


def _rollup_measures(n):
    """Per-day measures. Deposits and withdrawals stay NULL (not 0) for a
    side without movement: the immovable rule depends on it."""
    return [
        money_sum(n).alias("net"),
        money_sum(F.when(n > 0, n)).alias("total_deposits"),
        money_sum(F.when(n < 0, n)).alias("total_withdrawals"),
        F.count(F.lit(1)).alias("transactions_count"),
        F.max("event_ts").alias("last_movement_ts"),
    ]


def daily_rollup(sg: DataFrame) -> DataFrame:
    """One row per account and day with movement: ``net``, deposits (>0),
    withdrawals (<0, a negative sum), ``withdrawals_sum`` (positive, 0 when
    none), the event count over all types and the last event time.

    Hash aggregate with map-side combine: a hot account only ever ships one
    partial row per map task and day. Decimal money is summed exactly, with
    all 38 digits; a sum beyond them fails the job.
    """
    ev = with_money(sg)
    n = F.col(MONEY)
    zero = F.lit(0).cast(ev.schema[MONEY].dataType)
    return ev.groupBy(ACCOUNT, DAY).agg(
        *_rollup_measures(n),
        F.coalesce(money_sum(F.when(n < 0, -n)), F.when(F.count(n) > 0, zero)).alias("withdrawals_sum"),
    )


def daily_transaction_counts(sg: DataFrame) -> DataFrame:
    return sg.groupBy(ACCOUNT, DAY).agg(F.count(F.lit(1)).alias("transactions_count"))


def with_balances(daily: DataFrame) -> DataFrame:
    """End-of-day ``balance`` (sum of daily nets so far) and
    ``balance_previous`` (balance of the previous day *with movement*, 0 on
    the first one). Sorting days, not events: a hot account has at most one
    row per day here."""
    w = Window.partitionBy(ACCOUNT).orderBy(DAY)
    before, upto = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    return daily.select(
        "*", money_sum("net", upto).alias("balance"),
        F.coalesce(money_sum("net", before), F.lit(0).cast(daily.schema["net"].dataType)).alias("balance_previous"))


def with_immovable(balances: DataFrame, netting: str = "observed") -> DataFrame:
    return balances.withColumn(
        "immovable_balance",
        immovable("balance_previous", "total_withdrawals", "total_deposits", netting))


def until_day(sg: DataFrame, end: str) -> DataFrame:
    """Events up to the end of ``end``. Stated on the raw event time with a
    literal of the same type, so Parquet gets it as a pushed filter and
    skips row groups of later events."""
    ts_type = next(f.dataType for f in sg.schema.fields if f.name == "event_ts")
    limit = F.lit(f"{end} 00:00:00").cast(ts_type) + F.expr("INTERVAL 1 DAY")
    return sg.filter(F.col("event_ts").isNull() | (F.col("event_ts") < limit))


def _since(sg: DataFrame, start: str) -> DataFrame:
    """Events from the start of ``start`` on (pushed to the scan like
    ``until_day``): incremental runs read only the new days."""
    ts_type = next(f.dataType for f in sg.schema.fields if f.name == "event_ts")
    return sg.filter(F.col("event_ts") >= F.lit(f"{start} 00:00:00").cast(ts_type))


# --- incremental state -------------------------------------------------------

STATE_COLUMNS = ("account_id", "user_id", "balance", "last_movement_ts", "as_of")


def account_state(sg: DataFrame, as_of: str) -> DataFrame:
    """Balance state through the end of ``as_of``: one row per (account,
    user) pair seen so far, with the account's balance and last movement
    time. A later run starting the day after ``as_of`` can begin from it
    instead of re-reading the whole feed (see ``wallet_history(opening=)``)."""
    (as_of, _) = validate_dates(as_of)
    ev = with_money(sg)
    per_pair = until_day(ev, as_of).groupBy(ACCOUNT, USER).agg(
        money_sum(MONEY).alias(MONEY), F.max("event_ts").alias("last_movement_ts"))
    return _state(per_pair, as_of)


def advance_state(state: DataFrame, sg_new: DataFrame, through: str) -> DataFrame:
    """State through ``through`` from the state of an earlier day and the
    events after that day; events up to the state's day (already in it) and
    after ``through`` are ignored, the former by a pushed filter. Reads the
    state (one row per pair) and the new events only."""
    (through, _) = validate_dates(through)
    ev = with_money(sg_new)
    first = state.select("as_of").first()          # one row: the state's day
    if first is not None and first["as_of"] is not None:
        after = (first["as_of"] + _dt.timedelta(days=1)).isoformat()
        ev = _since(ev, after)                      # events the state already holds are skipped
    new = until_day(ev, through).groupBy(ACCOUNT, USER).agg(
        money_sum(MONEY).alias(MONEY), F.max("event_ts").alias("last_movement_ts"))
    money, ts = new.schema[MONEY].dataType, new.schema["last_movement_ts"].dataType
    old = state.select(ACCOUNT, USER, F.lit(None).cast(money).alias(MONEY),
                       F.col("last_movement_ts").cast(ts).alias("last_movement_ts"),
                       F.lit(True).alias("_pair"))
    accounts = opening_balances(state, money).select(
        ACCOUNT, F.lit(None).cast("string").alias(USER), MONEY,
        F.lit(None).cast(ts).alias("last_movement_ts"), F.lit(False).alias("_pair"))
    return _state(new.withColumn("_pair", F.lit(True)).unionByName(old).unionByName(accounts), through)


def _state(per_pair: DataFrame, as_of: str) -> DataFrame:
    """Account balance and last movement on every pair row: sums of the
    account's rows (an earlier state's balance is a row that is no pair),
    combined map-side, joined back to the pairs. An account with very many
    users is a join key, which adaptive execution splits."""
    if "_pair" not in per_pair.columns:
        per_pair = per_pair.withColumn("_pair", F.lit(True))
    zero = F.lit(0).cast(per_pair.schema[MONEY].dataType)
    totals = per_pair.groupBy(F.col(ACCOUNT).alias("_account")).agg(
        F.coalesce(money_sum(MONEY), zero).alias("balance"), F.max("last_movement_ts").alias("last_movement_ts"))
    pairs = per_pair.filter("_pair").select(ACCOUNT, USER).distinct()
    return (pairs.join(totals, pairs[ACCOUNT].eqNullSafe(totals["_account"]))
            .select(ACCOUNT, USER, "balance", "last_movement_ts", date_lit(as_of).alias("as_of")))


def opening_balances(state: DataFrame, money) -> DataFrame:
    """One row per account from a state: the balance (column ``_money``) as
    the type ``money`` of the feed's sums, and the last movement time (all
    pairs of an account carry the same balance)."""
    return state.groupBy(ACCOUNT).agg(F.max(F.col("balance").cast(money)).alias(MONEY),
                                      F.max("last_movement_ts").alias("last_movement_ts"))


def calendar_accounts(sg: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Every (account, user) pair ever seen, whatever its dates, times every
    day of the window. The calendar is a generator on each pair, so there is
    no cartesian join and nothing is broadcast; its length is bounded by the
    validated window."""
    start, end = validate_dates(start, end)
    pairs = sg.select(ACCOUNT, USER).distinct()
    return pairs.select(ACCOUNT, USER, calendar(start, end).alias(DAY))


def pair_dictionary(sg: DataFrame) -> DataFrame:
    """The distinct (account, user) pairs of a feed, to be stored and passed to
    ``wallet_history(pairs=)``; combined map-side."""
    return sg.select(ACCOUNT, USER).distinct()


def wallet_history(sg: DataFrame, start: str, end: str | None = None,
                   netting: str = "observed", quiet_days: str = "zero",
                   opening: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Dense daily history: one row per (account, user, day) of the window.

    ``quiet_days="zero"`` gives days without movement 0 for every amount and
    no last movement time; ``"carry"`` carries the last balance (0 before
    the first event) and the last movement time into them, with immovable
    equal to the carried balance floored at 0. Balances always count the
    history before ``start``.

    ``opening``: the ``account_state`` as of the day before ``start``. The
    feed is then read from ``start`` on only (a pushed filter), so a daily
    run costs one day of events plus one state row per account instead of
    the whole history; the result is the same.

    ``pairs``: a ``pair_dictionary``. It names the pairs first seen after
    ``end``, so no event after ``end`` is read (a pushed filter); with the
    dictionary of the whole feed the result is the same.

    Plan: the feed is rolled up at (account, user, day) grain with map-side
    partial aggregation, days before ``start`` folded into one opening row
    and days after ``end`` into one closing row (they still name the
    account's users). From that small frame come the account's days (at most
    days + 2 rows: running balance and the next day with movement, one
    window) and its distinct pairs. A day's row holds for the interval up to
    the next one; pairs meet intervals in a join on the account, and the
    interval is exploded into days last. The grid is never sorted or
    shuffled, and an account with very many users is a join key, which
    adaptive execution splits.
    """
    start, end = validate_dates(start, end)
    if quiet_days not in ("zero", "carry"):
        raise ValueError(f"quiet_days must be 'zero' or 'carry', not {quiet_days!r}")
    return _intervals(_rollup(sg, start, end, opening, pairs), start, end, netting, quiet_days)


def history_with_state(sg: DataFrame, start: str, end: str | None = None,
                       netting: str = "observed", quiet_days: str = "zero",
                       opening: DataFrame | None = None,
                       pairs: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The history of the window and the balance state through ``end``,
    both from one rollup of the feed. Returns ``(history, state, rollup)``:
    persist ``rollup`` while writing both outputs and the feed is scanned
    once. The state equals ``account_state(feed, end)`` (or
    ``advance_state(opening, feed, end)``)."""
    start, end = validate_dates(start, end)
    if quiet_days not in ("zero", "carry"):
        raise ValueError(f"quiet_days must be 'zero' or 'carry', not {quiet_days!r}")
    rolled = _rollup(sg, start, end, opening, pairs)
    upto = rolled.filter(F.col(DAY).isNull() | (F.col(DAY) <= date_lit(end)))
    per_pair = upto.groupBy(ACCOUNT, USER, "_pair").agg(
        money_sum("net").alias(MONEY), F.max("last_movement_ts").alias("last_movement_ts"))
    return _intervals(rolled, start, end, netting, quiet_days), _state(per_pair, end), rolled


def _rollup(sg: DataFrame, start: str, end: str, opening: DataFrame | None,
            known: DataFrame | None = None) -> DataFrame:
    """(account, user, day) rollup with days before ``start`` folded into
    ``start - 1`` (or the opening state's rows there) and days after
    ``end`` into ``end + 1``; ``_pair`` marks rows that name a real pair.
    ``known`` pairs are rows of ``end + 1``; no event after ``end`` is read then."""
    ev = with_money(sg if known is None else until_day(sg, end))
    s, e = date_lit(start), date_lit(end)
    d = F.col(DAY)
    after = F.when(d > e, F.date_add(e, 1))
    if opening is None:
        key = after.when(d < s, F.date_sub(s, 1)).otherwise(d)
        src = ev
    else:
        key = after.otherwise(d)
        src = _since(ev, start)
    rolled = (src.groupBy(ACCOUNT, USER, key.alias(DAY))
              .agg(*_rollup_measures(F.col(MONEY)))
              .withColumn("_pair", F.lit(True)))
    if opening is not None:
        rolled = rolled.unionByName(_opening_pairs(opening, start, rolled.schema["net"].dataType))
    if known is not None:
        empty = [F.lit(None).cast(rolled.schema[c].dataType).alias(c) for c in (
            "net", "total_deposits", "total_withdrawals", "transactions_count", "last_movement_ts")]
        rolled = rolled.unionByName(known.select(ACCOUNT, USER, F.date_add(e, 1).alias(DAY), *empty,
                                                 F.lit(True).alias("_pair")))
    return rolled


def _opening_pairs(opening: DataFrame, start: str, money) -> DataFrame:
    """State rows at ``start - 1``: every pair (no money), plus one row per
    account (not a pair) that holds the opening balance. A state of another
    day fails the run (checked on each state row, no extra job)."""
    before = F.date_sub(date_lit(start), 1)
    opening = opening.filter(F.assert_true(
        F.col("as_of") == before,
        F.lit(f"opening state must be as of the day before {start}")).isNull())
    day = before.alias(DAY)
    none = F.lit(None).cast(money)
    no_count = F.lit(None).cast("long").alias("transactions_count")
    ts_type = opening.schema["last_movement_ts"].dataType
    sides = (none.alias("total_deposits"), none.alias("total_withdrawals"), no_count)
    pairs = opening.select(ACCOUNT, USER, day, none.alias("net"), *sides,
                           F.lit(None).cast(ts_type).alias("last_movement_ts"), F.lit(True).alias("_pair"))
    accounts = opening_balances(opening, money).select(
        ACCOUNT, F.lit(None).cast("string").alias(USER), day, F.col(MONEY).alias("net"), *sides,
        "last_movement_ts", F.lit(False).alias("_pair"))
    return pairs.unionByName(accounts)


def _intervals(rolled: DataFrame, start: str, end: str, netting: str, quiet_days: str) -> DataFrame:
    """Pairs times the intervals between their account's moving days; see
    ``wallet_history``."""
    s, e = date_lit(start), date_lit(end)
    days = rolled.groupBy(ACCOUNT, DAY).agg(
        money_sum("net").alias("net"), money_sum("total_deposits").alias("total_deposits"),
        money_sum("total_withdrawals").alias("total_withdrawals"),
        F.sum("transactions_count").alias("transactions_count"),
        F.max("last_movement_ts").alias("last_movement_ts"))
    w = Window.partitionBy(ACCOUNT).orderBy(DAY)
    days = (with_immovable(with_balances(days), netting)
            .withColumns({"_next": F.lead(DAY).over(w), "_before": F.lag(F.lit(True)).over(w)}))
    values = ("balance", "balance_previous", "immovable_balance", "last_movement_ts",
              "total_deposits", "total_withdrawals", "transactions_count")
    moving = F.struct(F.col(DAY).alias("day"), *values)
    own = F.struct(F.greatest(F.col(DAY), s).alias("lo"),
                   F.least(F.coalesce(F.date_sub("_next", 1), e), e).alias("hi"), moving.alias("m"))
    # the days before the account's first row, without any movement yet
    lead_in = F.struct(s.alias("lo"), F.least(F.date_sub(F.col(DAY), 1), e).alias("hi"),
                       F.when(F.lit(False), moving).alias("m"))
    both = F.when(F.col("_before").isNull(), F.array(own, lead_in)).otherwise(F.array(own))
    # an undated row (NULL day) sorts first and holds until the first dated one
    spans = days.select(F.col(ACCOUNT).alias("_account"), F.explode(both).alias("i")).select(
        "_account", F.coalesce(F.col("i.lo"), s).alias("_lo"), F.coalesce(F.col("i.hi"), e).alias("_hi"),
        F.col("i.m").alias("_m")).filter("_lo <= _hi")
    pairs = rolled.filter("_pair").select(ACCOUNT, USER).distinct()
    out = pairs.join(spans, pairs[ACCOUNT].eqNullSafe(spans["_account"]))
    out = out.select(ACCOUNT, USER, "_m", F.explode(F.sequence("_lo", "_hi")).alias(DAY))
    m = lambda c: F.col("_m").getField(c)
    # a NULL account never matches its days (an equi-join on the account would
    # not either): its grid rows stay quiet
    known = F.col(ACCOUNT).isNotNull()
    moved = F.coalesce(m("day") == F.col(DAY), F.lit(False)) & known
    m_known = lambda c: F.when(known, m(c))
    zero = F.lit(0).cast(rolled.schema["net"].dataType)
    if quiet_days == "zero":
        quiet = {c: zero for c in MONEY_OUT}
        quiet_ts = F.when(F.lit(False), m("last_movement_ts"))  # a NULL of the column's type
    else:
        carried = F.coalesce(m_known("balance"), zero)
        quiet = {"balance": carried, "balance_previous": carried,
                 "immovable_balance": F.greatest(carried, zero),
                 "total_deposits": zero, "total_withdrawals": zero}
        quiet_ts = m_known("last_movement_ts")
    money = {c: F.when(moved, F.coalesce(m(c), zero)).otherwise(quiet[c]).cast("double").alias(c)
             for c in MONEY_OUT}
    return out.select(
        ACCOUNT, USER, money["balance"], money["balance_previous"], money["immovable_balance"],
        F.when(moved, m("last_movement_ts")).otherwise(quiet_ts).alias("last_movement_ts"),
        money["total_deposits"], money["total_withdrawals"],
        F.when(moved, F.coalesce(m("transactions_count"), F.lit(0))).otherwise(F.lit(0))
        .cast("bigint").alias("transactions_count"),
        DAY)
