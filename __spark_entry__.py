"""

Every query reads ``events`` from the given folder and derives its inputs
from it (``ledgerline.sources.standins``). Histories cover the whole span of
event days, computed from the data; reports and one rates query ask for the
middle half of it, so that rows fall outside their window on both sides.
"""

from __future__ import annotations

import datetime as _dt
import functools
import importlib.util
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import cdc as cdc_ops
from ledgerline.operators import history as hist_ops
from ledgerline.operators import interest as int_ops
from ledgerline.operators import rates as rate_ops
from ledgerline.operators import reports as rep
from ledgerline.plans import jobs
from ledgerline.session import fresh_path
from ledgerline.sources import files, standins

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the registered runs.
JOB_ID = "fixture-run"
JOB_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)
MIN_BALANCE = 100.0
DECIMALS = 8
DETAIL_MIN_BALANCE = 100
DETAIL_MIN_INTEREST = 0.05
DETAIL_K = 100
BINS = 20


# --- Spark side ---------------------------------------------------------------
# Each query reads ``events`` once and derives every input from that frame.

def _events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def _cdc(ev: DataFrame) -> DataFrame:
    return standins.cdc_from_events(ev)


def _signed(ev: DataFrame) -> DataFrame:
    return cdc_ops.signed(_cdc(ev))


def _money(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


class _Run:
    """The stand-in pipeline over one folder's events. The span of event days
    is one small aggregate, run only by the queries that need it."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self.ev = _events(spark, d)

    @functools.cached_property
    def span(self) -> tuple[_dt.date, _dt.date]:
        s, e = files.data_window(self.signed())
        return _dt.date.fromisoformat(s), _dt.date.fromisoformat(e)

    @property
    def start(self) -> str:
        return self.span[0].isoformat()

    @property
    def end(self) -> str:
        return self.span[1].isoformat()

    @property
    def mid(self) -> str:
        s, e = self.span
        return (s + _dt.timedelta(days=(e - s).days // 2)).isoformat()

    @property
    def window(self) -> tuple[str, str]:
        """The middle of the span, for the reports: rows fall outside on both sides."""
        s, e = self.span
        quarter = _dt.timedelta(days=(e - s).days // 4)
        return (s + quarter).isoformat(), (e - quarter).isoformat()

    def signed(self) -> DataFrame:
        return _signed(self.ev)

    def history(self, netting="observed", quiet_days="zero", single_day=False) -> DataFrame:
        if single_day:
            return hist_ops.wallet_history(self.signed(), self.mid, None, netting, quiet_days)
        return hist_ops.wallet_history(self.signed(), self.start, self.end, netting, quiet_days)

    def rates(self) -> DataFrame:
        return rate_ops.normalize(standins.rates_raw_from_events(self.ev))

    def decision(self) -> DataFrame:
        # The stand-in feed has at most one rate per calendar day of the
        # span (built that way), a proven bound: broadcast without a check.
        return int_ops.decide(self.history(), self.rates(), MIN_BALANCE, DECIMALS,
                              broadcast_rates=True)

    def payments(self) -> DataFrame:
        return int_ops.payments(self.decision())

    def audit(self) -> DataFrame:
        return int_ops.audit(self.decision(), JOB_ID, JOB_TS)


def q_signed_amounts(spark, d):
    sg = _Run(spark, d).signed()
    return _money(sg.select("account_id", "user_id", "transaction_type", "amount", "event_time",
                            "event_id", "normalized_amount", "event_ts", "partition_date"),
                  "amount", "normalized_amount")


def q_running_balance(spark, d):
    out = cdc_ops.running_balance(_Run(spark, d).signed(), tie="event_id")
    return _money(out.select("account_id", "event_id", "event_ts", "partition_date",
                             "normalized_amount", "running_balance"),
                  "normalized_amount", "running_balance")


def q_daily_rollup(spark, d):
    out = hist_ops.daily_rollup(_Run(spark, d).signed())
    return _money(out, "net", "total_deposits", "total_withdrawals", "withdrawals_sum")


def q_daily_transaction_counts(spark, d):
    return hist_ops.daily_transaction_counts(_Run(spark, d).signed())


def q_previous_balance(spark, d):
    out = hist_ops.with_balances(hist_ops.daily_rollup(_Run(spark, d).signed()))
    return _money(out.select("account_id", "partition_date", "balance", "balance_previous"),
                  "balance", "balance_previous")


def _immovable(spark, d, netting):
    daily = hist_ops.daily_rollup(_Run(spark, d).signed())
    out = hist_ops.with_immovable(hist_ops.with_balances(daily), netting)
    return _money(out.select("account_id", "partition_date", "balance_previous", "total_deposits",
                             "total_withdrawals", "immovable_balance"),
                  "balance_previous", "total_deposits", "total_withdrawals", "immovable_balance")


def q_immovable_balance(spark, d):
    return _immovable(spark, d, "observed")


def q_immovable_full(spark, d):
    return _immovable(spark, d, "full")


def q_calendar_accounts(spark, d):
    r = _Run(spark, d)
    return hist_ops.calendar_accounts(r.signed(), r.start, r.end)


def q_wallet_history(spark, d):
    return _Run(spark, d).history()


def q_wallet_history_carry(spark, d):
    return _Run(spark, d).history(quiet_days="carry")


def q_wallet_history_full(spark, d):
    return _Run(spark, d).history(netting="full")


def q_history_single_day(spark, d):
    return _Run(spark, d).history(single_day=True)


def q_account_state(spark, d):
    r = _Run(spark, d)
    return _money(hist_ops.account_state(r.signed(), r.end), "balance")


def q_wallet_history_incremental(spark, d):
    """Days from mid-span on, from the state of the day before plus only
    the events from mid-span on."""
    r = _Run(spark, d)
    mid = r.mid
    before = (_dt.date.fromisoformat(mid) - _dt.timedelta(days=1)).isoformat()
    sg = r.signed()
    state = hist_ops.account_state(sg, before)
    new = sg.filter(F.col("partition_date") >= F.lit(mid).cast("date"))
    return hist_ops.wallet_history(new, mid, r.end, opening=state)


def q_cdc_quality_report(spark, d):
    return cdc_ops.quality_report(standins.dirty_cdc(_cdc(_events(spark, d))))


def q_rates_normalized(spark, d):
    return _Run(spark, d).rates()


def q_rates_json_feed(spark, d):
    """The derived feed landed as JSON, one part as an array and one as JSON
    Lines, read back through the feed reader and normalised."""
    raw = standins.rates_raw_from_events(_events(spark, d))
    path = fresh_path(spark, "feed")
    weekday = F.weekday(F.to_date("data", "dd/MM/yyyy"))
    array = raw.filter(weekday % 2 == 0).agg(F.to_json(F.collect_list(F.struct("data", "valor"))).alias("value"))
    array.write.text(f"{path}/array")
    raw.filter(weekday % 2 == 1).coalesce(1).write.json(f"{path}/lines")
    return rate_ops.normalize(files.read_rates_json(spark, [f"{path}/array", f"{path}/lines"]))


def q_rates_in_range(spark, d):
    r = _Run(spark, d)
    path = fresh_path(spark, "rates")
    files.write_rates(r.rates(), path)
    return files.read_rates(spark, path, *r.window)


def q_rates_roundtrip(spark, d):
    """Write all rates, then overwrite the days after mid-span with doubled
    ones: the dynamic overwrite must keep the first half and replace the second."""
    r = _Run(spark, d)
    path = fresh_path(spark, "rates")
    rates = r.rates()
    files.write_rates(rates, path, dynamic=True)
    later = rates.filter(F.col("partition_date") > F.lit(r.mid).cast("date"))
    files.write_rates(later.withColumn("cdi_rate", F.col("cdi_rate") * 2), path, dynamic=True)
    return files.read_rates(spark, path)


def q_interest_payments(spark, d):
    return _Run(spark, d).payments()


def q_interest_audit(spark, d):
    return _Run(spark, d).audit()


def q_audit_defaults(spark, d):
    rows = standins.audit_with_gaps(int_ops.audit_rows(_Run(spark, d).decision()))
    return int_ops.with_audit_defaults(rows, JOB_ID, JOB_TS)


def q_audit_summary(spark, d):
    r = _Run(spark, d)
    return rep.audit_summary(r.audit(), *r.window)


def q_audit_reasons(spark, d):
    r = _Run(spark, d)
    return rep.audit_reasons(r.audit(), *r.window)


def q_payments_by_day(spark, d):
    r = _Run(spark, d)
    return rep.payments_by_day(r.payments(), *r.window)


def q_payments_detail(spark, d):
    r = _Run(spark, d)
    return rep.payments_detail(r.payments(), *r.window,
                               DETAIL_MIN_BALANCE, DETAIL_MIN_INTEREST, DETAIL_K)


def q_payments_distribution(spark, d):
    r = _Run(spark, d)
    return rep.payments_distribution(r.payments(), *r.window)


def q_interest_histogram(spark, d):
    r = _Run(spark, d)
    return rep.interest_histogram(r.payments(), *r.window, bins=BINS)


def q_eligibility_split(spark, d):
    r = _Run(spark, d)
    return rep.eligibility_split(r.audit(), *r.window)


def q_balance_interest_trend(spark, d):
    r = _Run(spark, d)
    return rep.balance_interest_trend(rep.payments_by_day(r.payments(), *r.window, ordered=False))


def q_balance_interest_lowess(spark, d):
    """The fit alone to six places: its sums run in another order in the twin."""
    r = _Run(spark, d)
    out = rep.balance_interest_lowess(rep.payments_by_day(r.payments(), *r.window, ordered=False))
    return out.withColumn("tendencia", F.round("tendencia", 6))


def q_wallet_history_pairs(spark, d):
    """Days up to mid-span, from the events up to mid-span and a stored
    dictionary of all pairs."""
    r = _Run(spark, d)
    sg, path = r.signed(), fresh_path(spark, "pairs")
    files.write_pairs(hist_ops.pair_dictionary(sg), path)
    return hist_ops.wallet_history(sg, r.start, r.mid, pairs=files.read_pairs(spark, path))


def q_history_daily_runs(spark, d):
    """Two days after mid-span, each run with its own day of a stored feed
    alone, on the state of the days before."""
    r = _Run(spark, d)
    path = fresh_path(spark, "daily")
    day = lambda i: (_dt.date.fromisoformat(r.mid) + _dt.timedelta(days=i)).isoformat()
    _cdc(r.ev).withColumn("day", F.to_date("event_time")).write.partitionBy("day").parquet(f"{path}/cdc")
    feed, sink = files.read_cdc(spark, f"{path}/cdc"), jobs.parquet_sink(f"{path}/history")
    jobs.build_history(feed.filter(F.col("day") <= r.mid).drop("day"), r.start, r.mid, sink, state_path=f"{path}/state")
    for i in (1, 2):
        today = feed.filter(F.col("day") == day(i))
        jobs.build_history(today, day(i), None, sink, state_path=f"{path}/state", day_column="day")
    return jobs.read_history(spark, f"{path}/history", day(1), day(2))


def _stored_runs(spark, d, path):
    """History, rates, payments and audit of the whole span through the job API."""
    r = _Run(spark, d)
    built = jobs.build_history(_cdc(r.ev), r.start, r.end, jobs.parquet_sink(f"{path}/history"))
    files.write_rates(r.rates(), f"{path}/rates")
    history, rates = jobs.read_history(spark, f"{path}/history", r.start, r.end), files.read_rates(spark, f"{path}/rates")
    run = lambda start, end, **kw: jobs.calculate_interest(
        history, rates, start, end, jobs.parquet_sink(f"{path}/payments"), jobs.parquet_sink(f"{path}/audit"),
        job_id=JOB_ID, job_timestamp=JOB_TS, decimals=DECIMALS, **kw)
    return r, built, run


def q_job_row_counts(spark, d):
    """Rows that the jobs report to have written."""
    r, built, run = _stored_runs(spark, d, fresh_path(spark, "runs"))
    counts = built.rows | run(r.start, r.end, min_balance=MIN_BALANCE).rows
    return spark.createDataFrame(sorted(counts.items()), "name string, rows long")


def q_interest_rerun(spark, d):
    """A run in which no account qualifies, then one of the window with the
    usual threshold: it replaces the window's days alone."""
    path = fresh_path(spark, "rerun")
    r, _, run = _stored_runs(spark, d, path)
    run(r.start, r.end, min_balance=1e15)
    run(*r.window, min_balance=MIN_BALANCE)
    return jobs.read_payments(spark, f"{path}/payments", r.start, r.end)


def q_cdc_verdict(spark, d):
    """The verdict and the messages of a feed that breaks the rules."""
    ok, messages = cdc_ops.validate(standins.dirty_cdc(_cdc(_events(spark, d))))
    return spark.createDataFrame([(ok, "\n".join(messages))], "valid boolean, messages string")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "signed_amounts": q_signed_amounts,
    "running_balance": q_running_balance,
    "daily_rollup": q_daily_rollup,
    "daily_transaction_counts": q_daily_transaction_counts,
    "previous_balance": q_previous_balance,
    "immovable_balance": q_immovable_balance,
    "immovable_full": q_immovable_full,
    "calendar_accounts": q_calendar_accounts,
    "wallet_history": q_wallet_history,
    "wallet_history_carry": q_wallet_history_carry,
    "wallet_history_full": q_wallet_history_full,
    "history_single_day": q_history_single_day,
    "account_state": q_account_state,
    "wallet_history_incremental": q_wallet_history_incremental,
    "cdc_quality_report": q_cdc_quality_report,
    "rates_normalized": q_rates_normalized,
    "rates_json_feed": q_rates_json_feed,
    "rates_in_range": q_rates_in_range,
    "rates_roundtrip": q_rates_roundtrip,
    "interest_payments": q_interest_payments,
    "interest_audit": q_interest_audit,
    "audit_defaults": q_audit_defaults,
    "audit_summary": q_audit_summary,
    "audit_reasons": q_audit_reasons,
    "payments_by_day": q_payments_by_day,
    "payments_detail": q_payments_detail,
    "payments_distribution": q_payments_distribution,
    "interest_histogram": q_interest_histogram,
    "eligibility_split": q_eligibility_split,
    "balance_interest_trend": q_balance_interest_trend,
    "balance_interest_lowess": q_balance_interest_lowess,
    "wallet_history_pairs": q_wallet_history_pairs,
    "history_daily_runs": q_history_daily_runs,
    "job_row_counts": q_job_row_counts,
    "interest_rerun": q_interest_rerun,
    "cdc_verdict": q_cdc_verdict,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: interest earned by each account on each rated day."""
    return _dates_as_text(q_interest_payments)(spark, SMOKE_DIR)


def _dates_as_text(q: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Registered outputs carry day columns as ISO text (the reference's
    storage type for them), so both engines render them identically."""
    def run(spark: SparkSession, d: str) -> DataFrame:
        df = q(spark, d)
        dates = [f.name for f in df.schema.fields if f.dataType.typeName() == "date"]
        return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df
    run.__name__ = q.__name__
    run.__doc__ = q.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _dates_as_text(q) for k, q in QUERIES.items()} | _llm("QUERIES")


def _llm(name: str) -> dict:
    """The queries or SQL of the ``llm`` subpackage and its pipeline, where they
    are installed. Only their absence is tolerated, never a failing import."""
    if not importlib.util.find_spec("ledgerline.llm") or not importlib.util.find_spec("ledgerline.llm.queries"):
        return {}
    from ledgerline.llm import queries as llm_queries

    return dict(getattr(llm_queries, name))


# --- DuckDB side ----------------------------------------------------------------

_CTE_BASE = """
cdc AS (
  SELECT CAST(user_id AS VARCHAR) AS account_id,
         'u' || CAST(user_id % 50 + CASE WHEN user_id % 4 = 0 AND event_id % 3 = 0 THEN 50 ELSE 0 END AS VARCHAR)
           AS user_id,
         CASE event_type WHEN 'signup' THEN 'WALLET_CREATED' WHEN 'click' THEN 'DEPOSIT'
              WHEN 'view' THEN 'TRANSFER_IN' WHEN 'purchase' THEN 'WITHDRAWAL'
              ELSE 'TRANSFER_OUT' END AS transaction_type,
         CASE WHEN event_type = 'signup' THEN CAST(0 AS DECIMAL(18,2))
              ELSE CAST(value AS DECIMAL(18,2)) END AS amount,
         ts AS event_time, event_id
  FROM events),
sg AS (
  SELECT *, CASE WHEN transaction_type IN ('WITHDRAWAL', 'TRANSFER_OUT') THEN -abs(amount)
                 ELSE abs(amount) END AS normalized_amount,
         event_time AS event_ts, CAST(event_time AS DATE) AS partition_date
  FROM cdc),
win AS (SELECT s, e, s + CAST((e - s) // 4 AS INTEGER) AS ws, e - CAST((e - s) // 4 AS INTEGER) AS we,
               s + CAST((e - s) // 2 AS INTEGER) AS mid
        FROM (SELECT min(partition_date) AS s, max(partition_date) AS e FROM sg)),
daily AS (
  SELECT account_id, partition_date,
         sum(normalized_amount) AS net,
         sum(CASE WHEN normalized_amount > 0 THEN normalized_amount END) AS total_deposits,
         sum(CASE WHEN normalized_amount < 0 THEN normalized_amount END) AS total_withdrawals,
         sum(CASE WHEN normalized_amount < 0 THEN -normalized_amount ELSE 0 END) AS withdrawals_sum,
         count(*) AS transactions_count,
         max(event_ts) AS last_movement_ts
  FROM sg GROUP BY account_id, partition_date),
bal AS (
  SELECT *, sum(net) OVER (PARTITION BY account_id ORDER BY partition_date
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS balance
  FROM daily),
bal2 AS (
  SELECT *, coalesce(lag(balance) OVER (PARTITION BY account_id ORDER BY partition_date), 0)
            AS balance_previous
  FROM bal),
imm AS (
  SELECT *, greatest(balance_previous - greatest(abs(total_withdrawals) - total_deposits, 0), 0)
            AS immovable_balance,
         greatest(balance_previous - greatest(abs(coalesce(total_withdrawals, 0))
                                              - coalesce(total_deposits, 0), 0), 0)
            AS immovable_full
  FROM bal2),
pairs AS (SELECT DISTINCT account_id, user_id FROM sg)
"""

_CTE_CAL = """
cal AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS partition_date
        FROM (SELECT {start} AS s, {end} AS e FROM win))
"""

_CTE_HIST = """
hist AS (
  SELECT p.account_id, p.user_id,
         CAST(coalesce(i.balance, 0) AS DOUBLE) AS balance,
         CAST(coalesce(i.balance_previous, 0) AS DOUBLE) AS balance_previous,
         CAST(coalesce(i.{imm}, 0) AS DOUBLE) AS immovable_balance,
         i.last_movement_ts,
         CAST(coalesce(i.total_deposits, 0) AS DOUBLE) AS total_deposits,
         CAST(coalesce(i.total_withdrawals, 0) AS DOUBLE) AS total_withdrawals,
         CAST(coalesce(i.transactions_count, 0) AS BIGINT) AS transactions_count,
         c.partition_date
  FROM pairs p CROSS JOIN cal c
  LEFT JOIN imm i ON i.account_id = p.account_id AND i.partition_date = c.partition_date)
"""

_CTE_RATES = """
espan AS (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events),
rdays AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS d FROM espan),
rates_raw AS (
  SELECT strftime(d, '%d/%m/%Y') AS data,
         CASE WHEN day(d) = 17 THEN 'n/d'
              ELSE CAST(CAST(10.40 + 0.05 * (day(d) % 5) AS DECIMAL(6,2)) AS VARCHAR) END AS valor
  FROM rdays WHERE isodow(d) < 6),
rates AS (
  SELECT * FROM (
    SELECT CAST(try_strptime(data, '%d/%m/%Y') AS DATE) AS partition_date,
           TRY_CAST(valor AS DOUBLE) / 100 AS cdi_rate
    FROM rates_raw)
  WHERE partition_date IS NOT NULL AND cdi_rate IS NOT NULL)
"""

_CTE_DECISION = """
decision AS (
  SELECT h.user_id, h.account_id, h.partition_date,
         h.immovable_balance, r.cdi_rate,
         h.immovable_balance >= CAST(100.0 AS DOUBLE) AS qualified,
         CASE WHEN h.immovable_balance >= CAST(100.0 AS DOUBLE) THEN 'Califica para interés'
              ELSE 'Saldo inmovilizado menor a $100.0' END AS reason,
         CASE WHEN h.immovable_balance >= CAST(100.0 AS DOUBLE)
              THEN round(h.immovable_balance * (r.cdi_rate / 365), 8)
              ELSE CAST(0 AS DOUBLE) END AS interest_amount
  FROM hist h JOIN rates r ON h.partition_date = r.partition_date),
payments AS (
  SELECT user_id, account_id, immovable_balance AS eligible_balance, cdi_rate AS interest_rate,
         interest_amount, false AS is_paid, CAST(NULL AS VARCHAR) AS payment_date, partition_date
  FROM decision),
audit_raw AS (
  SELECT user_id, account_id, qualified, reason, immovable_balance AS relevant_balance,
         interest_amount AS calculated_interest, cdi_rate AS interest_rate,
         'success' AS process_status, CAST(NULL AS VARCHAR) AS error_description, partition_date
  FROM decision)
"""

_AUDIT_SELECT = """
  SELECT 'fixture-run' AS job_id, TIMESTAMP '2024-02-01 00:00:00' AS job_timestamp,
         coalesce(nullif(user_id, ''), 'UNKNOWN_USER') AS user_id,
         coalesce(nullif(account_id, ''), 'UNKNOWN_ACCOUNT') AS account_id,
         qualified,
         coalesce(nullif(reason, ''), 'No reason provided') AS reason,
         coalesce(CAST(relevant_balance AS DOUBLE), CAST(0 AS DOUBLE)) AS relevant_balance,
         coalesce(CAST(calculated_interest AS DOUBLE), CAST(0 AS DOUBLE)) AS calculated_interest,
         coalesce(CAST(interest_rate AS DOUBLE), CAST(0 AS DOUBLE)) AS interest_rate,
         coalesce(nullif(process_status, ''), 'unknown') AS process_status,
         error_description, partition_date
"""

_IN_WIN = "partition_date BETWEEN (SELECT ws FROM win) AND (SELECT we FROM win)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _free_sum(x: str) -> str:
    """Sum on two binary grids, free of row order (``functions.order_free_sum``)."""
    coarse = f"round_even(({x}) * 1048576.0, 0)"
    fine = f"round_even((({x}) * 1048576.0 - {coarse}) * 1099511627776.0, 0)"
    return (f"(CAST(sum(CAST({coarse} AS DECIMAL(38,0))) AS DOUBLE) * CAST({2.0 ** -20!r} AS DOUBLE)"
            f" + CAST(sum(CAST({fine} AS DECIMAL(20,0))) AS DOUBLE) * CAST({2.0 ** -60!r} AS DOUBLE))")


def _free_avg(x: str) -> str:
    return f"{_free_sum(x)} / nullif(CAST(count({x}) AS DOUBLE), CAST(0 AS DOUBLE))"


def _pipeline(imm: str = "immovable_balance") -> str:
    return _with(_CTE_BASE, _CTE_CAL.format(start="s", end="e"), _CTE_HIST.format(imm=imm),
                 _CTE_RATES, _CTE_DECISION, "audit AS (" + _AUDIT_SELECT + " FROM audit_raw)",
                 f"""by_day AS (
  SELECT partition_date, count(account_id) AS cuentas,
         {_free_sum('interest_amount')} AS interes_total, {_free_avg('eligible_balance')} AS saldo_promedio
  FROM payments WHERE {_IN_WIN} GROUP BY partition_date)""")


_CARRY = _with(_CTE_BASE, _CTE_CAL.format(start="s", end="e"), """
g AS (SELECT a.account_id, c.partition_date
      FROM (SELECT DISTINCT account_id FROM sg) a CROSS JOIN cal c),
ca AS (
  SELECT g.account_id, g.partition_date AS d, i.partition_date AS md, i.balance,
         i.balance_previous, i.immovable_balance, i.last_movement_ts, i.total_deposits,
         i.total_withdrawals, i.transactions_count
  FROM g ASOF LEFT JOIN imm i
    ON g.account_id = i.account_id AND g.partition_date >= i.partition_date)
""") + """
SELECT p.account_id, p.user_id,
       CAST(CASE WHEN md = d THEN balance ELSE coalesce(balance, 0) END AS DOUBLE) AS balance,
       CAST(CASE WHEN md = d THEN balance_previous ELSE coalesce(balance, 0) END AS DOUBLE)
         AS balance_previous,
       CAST(CASE WHEN md = d THEN immovable_balance ELSE greatest(coalesce(balance, 0), 0) END
            AS DOUBLE) AS immovable_balance,
       last_movement_ts,
       CAST(CASE WHEN md = d THEN coalesce(total_deposits, 0) ELSE 0 END AS DOUBLE) AS total_deposits,
       CAST(CASE WHEN md = d THEN coalesce(total_withdrawals, 0) ELSE 0 END AS DOUBLE)
         AS total_withdrawals,
       CAST(CASE WHEN md = d THEN transactions_count ELSE 0 END AS BIGINT) AS transactions_count,
       d AS partition_date
FROM ca JOIN pairs p ON p.account_id = ca.account_id
"""

_DIRTY = """
cdc_dirty AS (
  SELECT CASE WHEN event_id % 101 = 0 THEN NULL ELSE account_id END AS account_id,
         user_id, transaction_type,
         CASE WHEN event_id % 103 = 0 THEN NULL
              WHEN transaction_type = 'WALLET_CREATED' AND event_id % 7 = 0 THEN CAST(5 AS DECIMAL(18,2))
              WHEN event_id % 11 = 0 THEN -amount ELSE amount END AS amount,
         event_time, event_id
  FROM cdc),
counts AS (
  SELECT count(*) FILTER (WHERE transaction_type = 'WALLET_CREATED' AND abs(amount) > 0.001) AS v1,
         count(*) FILTER (WHERE transaction_type IN ('DEPOSIT', 'TRANSFER_IN') AND amount < 0) AS v2,
         count(*) FILTER (WHERE account_id IS NULL OR event_time IS NULL OR amount IS NULL) AS v4
  FROM cdc_dirty)
"""

_GAPS = """
audit_gaps AS (
  SELECT CASE WHEN CAST(account_id AS BIGINT) % 7 = 0 THEN NULL
              WHEN CAST(account_id AS BIGINT) % 7 = 1 THEN '' ELSE user_id END AS user_id,
         account_id, qualified, reason,
         CASE WHEN CAST(account_id AS BIGINT) % 5 = 0 THEN NULL ELSE relevant_balance END
           AS relevant_balance,
         calculated_interest, interest_rate,
         CASE WHEN CAST(account_id AS BIGINT) % 11 = 0 THEN NULL ELSE process_status END
           AS process_status,
         error_description, partition_date
  FROM audit_raw)
"""


def _quality_sql() -> str:
    head = _with(_CTE_BASE, _DIRTY)
    rows = []
    for rule_id, rule, col, prefix, suffix in (
        ("V1", "created_with_amount", "v1", "⚠️ ", " cuentas creadas con monto distinto de cero"),
        ("V2", "negative_inflow", "v2", "⚠️ ", " depósitos/transferencias con monto negativo"),
        ("V4", "null_required", "v4", "⚠️ ", " registros con campos obligatorios nulos"),
    ):
        rows.append(
            f"SELECT '{rule_id}' AS rule_id, '{rule}' AS rule, {col} AS violations, "
            f"CASE WHEN {col} > 0 THEN '{prefix}' || CAST({col} AS VARCHAR) || '{suffix}' END AS message "
            f"FROM counts")
    return head + "\nUNION ALL\n".join(rows)


# Day columns of each registered output (rendered as ISO text, see queries()).
_DATE_COLUMNS = {
    "cdc_quality_report": (), "audit_summary": (), "audit_reasons": (),
    "payments_distribution": (), "interest_histogram": (), "eligibility_split": (),
    "balance_interest_trend": (), "account_state": ("as_of",), "job_row_counts": (), "cdc_verdict": (),
}


def _text_days(key: str, sql: str) -> str:
    cols = _DATE_COLUMNS.get(key, ("partition_date",))
    if not cols:
        return sql
    repl = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


def oracle_sql() -> dict[str, str]:
    return {k: _text_days(k, v) for k, v in _oracle_sql().items()} | _llm("ORACLE_SQL")


def _oracle_sql() -> dict[str, str]:
    base = _with(_CTE_BASE)
    hist_base = _with(_CTE_BASE, _CTE_CAL.format(start="s", end="e"), _CTE_HIST.format(imm="immovable_balance"))
    hist_full = _with(_CTE_BASE, _CTE_CAL.format(start="s", end="e"), _CTE_HIST.format(imm="immovable_full"))
    hist_day = _with(_CTE_BASE, _CTE_CAL.format(start="mid", end="mid"), _CTE_HIST.format(imm="immovable_balance"))
    pipe = _pipeline()
    rates = _with(_CTE_RATES)
    return {
        "signed_amounts": base + """
SELECT account_id, user_id, transaction_type, CAST(amount AS DOUBLE) AS amount, event_time, event_id,
       CAST(normalized_amount AS DOUBLE) AS normalized_amount, event_ts, partition_date
FROM sg""",
        "running_balance": base + """
SELECT account_id, event_id, event_ts, partition_date,
       CAST(normalized_amount AS DOUBLE) AS normalized_amount,
       CAST(sum(normalized_amount) OVER (PARTITION BY account_id ORDER BY event_ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_balance
FROM sg""",
        "daily_rollup": base + """
SELECT account_id, partition_date, CAST(net AS DOUBLE) AS net,
       CAST(total_deposits AS DOUBLE) AS total_deposits,
       CAST(total_withdrawals AS DOUBLE) AS total_withdrawals,
       transactions_count, last_movement_ts,
       CAST(withdrawals_sum AS DOUBLE) AS withdrawals_sum
FROM daily""",
        "daily_transaction_counts": base + """
SELECT account_id, partition_date, count(*) AS transactions_count FROM sg
GROUP BY account_id, partition_date""",
        "previous_balance": base + """
SELECT account_id, partition_date, CAST(balance AS DOUBLE) AS balance,
       CAST(balance_previous AS DOUBLE) AS balance_previous
FROM bal2""",
        "immovable_balance": base + """
SELECT account_id, partition_date, CAST(balance_previous AS DOUBLE) AS balance_previous,
       CAST(total_deposits AS DOUBLE) AS total_deposits,
       CAST(total_withdrawals AS DOUBLE) AS total_withdrawals,
       CAST(immovable_balance AS DOUBLE) AS immovable_balance
FROM imm""",
        "immovable_full": base + """
SELECT account_id, partition_date, CAST(balance_previous AS DOUBLE) AS balance_previous,
       CAST(total_deposits AS DOUBLE) AS total_deposits,
       CAST(total_withdrawals AS DOUBLE) AS total_withdrawals,
       CAST(immovable_full AS DOUBLE) AS immovable_balance
FROM imm""",
        "calendar_accounts": _with(_CTE_BASE, _CTE_CAL.format(start="s", end="e")) + """
SELECT p.account_id, p.user_id, c.partition_date FROM pairs p CROSS JOIN cal c""",
        "wallet_history": hist_base + "SELECT * FROM hist",
        "wallet_history_carry": _CARRY,
        "wallet_history_full": hist_full + "SELECT * FROM hist",
        "history_single_day": hist_day + "SELECT * FROM hist",
        "account_state": base + """
SELECT p.account_id, p.user_id, CAST(b.bal AS DOUBLE) AS balance, b.last_ts AS last_movement_ts,
       (SELECT e FROM win) AS as_of
FROM pairs p
JOIN (SELECT account_id, sum(normalized_amount) AS bal, max(event_ts) AS last_ts
      FROM sg GROUP BY account_id) b ON b.account_id = p.account_id""",
        "wallet_history_incremental": _with(
            _CTE_BASE, _CTE_CAL.format(start="mid", end="e"),
            _CTE_HIST.format(imm="immovable_balance")) + "SELECT * FROM hist",
        "cdc_quality_report": _quality_sql(),
        "rates_normalized": rates + "SELECT partition_date, cdi_rate FROM rates",
        "rates_json_feed": rates + "SELECT partition_date, cdi_rate FROM rates",
        "rates_in_range": rates + """
SELECT partition_date, cdi_rate FROM rates, espan
WHERE partition_date BETWEEN s + CAST((e - s) // 4 AS INTEGER) AND e - CAST((e - s) // 4 AS INTEGER)""",
        "rates_roundtrip": rates + """
SELECT partition_date, CASE WHEN partition_date > s + CAST((e - s) // 2 AS INTEGER) THEN cdi_rate * 2 ELSE cdi_rate END AS cdi_rate
FROM rates, espan""",
        "interest_payments": pipe + "SELECT * FROM payments",
        "interest_audit": pipe + "SELECT * FROM audit",
        "audit_defaults": _with(pipe[len("WITH "):], _GAPS) + _AUDIT_SELECT + " FROM audit_gaps",
        "audit_summary": pipe + f"""
SELECT count(*) AS total_registros,
       CAST(sum(CASE WHEN qualified THEN 1 ELSE 0 END) AS BIGINT) AS cuentas_calificadas,
       {_free_avg('relevant_balance')} AS saldo_promedio,
       CAST(sum(CASE WHEN process_status = 'error' THEN 1 ELSE 0 END) AS DOUBLE) * CAST(100.0 AS DOUBLE)
         / CAST(nullif(count(*), 0) AS DOUBLE) AS tasa_error
FROM audit WHERE {_IN_WIN}""",
        "audit_reasons": pipe + f"""
SELECT reason, count(*) AS count FROM audit WHERE {_IN_WIN} AND NOT qualified
GROUP BY reason ORDER BY count DESC, reason""",
        "payments_by_day": pipe + """
SELECT partition_date, cuentas, interes_total, saldo_promedio
FROM by_day ORDER BY partition_date""",
        "payments_detail": pipe + f"""
SELECT user_id, account_id, eligible_balance, interest_rate, interest_amount, partition_date
FROM payments
WHERE {_IN_WIN} AND eligible_balance >= 100 AND interest_amount >= 0.05
ORDER BY interest_amount DESC, account_id, user_id, partition_date
LIMIT 100""",
        "payments_distribution": pipe + f"SELECT interest_amount FROM payments WHERE {_IN_WIN}",
        "interest_histogram": _with(pipe[len("WITH "):], f"""
v AS (SELECT interest_amount AS v FROM payments WHERE {_IN_WIN} AND interest_amount IS NOT NULL),
st AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
cnt AS (
  SELECT CAST(CASE WHEN hi - lo = 0 THEN 1
                   ELSE least(floor((v - lo) * CAST(20 AS DOUBLE) / (hi - lo)) + 1, 20) END AS INTEGER) AS bin,
         count(*) AS count
  FROM v CROSS JOIN st GROUP BY 1),
edges AS (
  SELECT CAST(b AS INTEGER) AS bin,
         lo + CAST(b - 1 AS INTEGER) * ((hi - lo) / CAST(20 AS DOUBLE)) AS bin_lo,
         lo + CAST(b AS INTEGER) * ((hi - lo) / CAST(20 AS DOUBLE)) AS bin_hi
  FROM st CROSS JOIN range(1, 21) t(b) WHERE lo IS NOT NULL)""") + """
SELECT e.bin, e.bin_lo, e.bin_hi, CAST(coalesce(c.count, 0) AS BIGINT) AS count
FROM edges e LEFT JOIN cnt c ON c.bin = e.bin ORDER BY e.bin""",
        "eligibility_split": _with(pipe[len("WITH "):], f"""
t AS (SELECT count(*) AS total, CAST(sum(CASE WHEN qualified THEN 1 ELSE 0 END) AS BIGINT) AS yes
      FROM audit WHERE {_IN_WIN})""") + """
SELECT 'Calificadas' AS estado, CAST(coalesce(yes, 0) AS BIGINT) AS cantidad,
       CAST(coalesce(yes, 0) AS DOUBLE) / CAST(nullif(total, 0) AS DOUBLE) AS share FROM t
UNION ALL
SELECT 'No Calificadas' AS estado, CAST(total - coalesce(yes, 0) AS BIGINT) AS cantidad,
       CAST(total - coalesce(yes, 0) AS DOUBLE) / CAST(nullif(total, 0) AS DOUBLE) AS share FROM t""",
        "balance_interest_trend": _with(pipe[len("WITH "):], f"""
pts AS (SELECT * FROM by_day WHERE saldo_promedio IS NOT NULL AND interes_total IS NOT NULL),
means AS (SELECT {_free_avg('saldo_promedio')} AS mx, {_free_avg('interes_total')} AS my FROM pts),
sums AS (SELECT max(mx) AS mx, max(my) AS my,
                {_free_sum('(saldo_promedio - mx) * (saldo_promedio - mx)')} AS sxx,
                {_free_sum('(interes_total - my) * (interes_total - my)')} AS syy,
                {_free_sum('(saldo_promedio - mx) * (interes_total - my)')} AS sxy
         FROM pts, means)""") + """
SELECT (SELECT count(*) FROM by_day) AS n_days,
       sxy / nullif(sqrt(sxx * syy), 0) AS correlation, sxy / nullif(sxx, 0) AS slope,
       my - sxy / nullif(sxx, 0) * mx AS intercept
FROM sums""",
        "balance_interest_lowess": pipe + _lowess_sql(rounds=3),
        "wallet_history_pairs": _with(
            _CTE_BASE, _CTE_CAL.format(start="s", end="mid"),
            _CTE_HIST.format(imm="immovable_balance")) + "SELECT * FROM hist",
        "history_daily_runs": _with(
            _CTE_BASE, _CTE_CAL.format(start="mid + 1", end="mid + 2"),
            _CTE_HIST.format(imm="immovable_balance")) + """
SELECT h.* FROM hist h
JOIN (SELECT account_id, user_id, min(partition_date) AS first FROM sg GROUP BY account_id, user_id) f
  ON f.account_id = h.account_id AND f.user_id = h.user_id AND f.first <= h.partition_date""",
        "job_row_counts": pipe + """
SELECT 'audit' AS name, count(*) AS rows FROM audit UNION ALL
SELECT 'payments' AS name, count(*) AS rows FROM payments UNION ALL
SELECT 'wallet_history' AS name, count(*) AS rows FROM hist""",
        "interest_rerun": pipe + f"""
SELECT * REPLACE (CASE WHEN {_IN_WIN} THEN interest_amount ELSE CAST(0 AS DOUBLE) END AS interest_amount) FROM payments""",
        "cdc_verdict": f"""
SELECT count(message) = 0 AS valid, coalesce(string_agg(message, chr(10) ORDER BY rule_id), '') AS messages
FROM ({_quality_sql()}) AS r""",
    }


def _lowess_sql(rounds: int) -> str:
    """Local lines through the nearest two thirds of the days, ``rounds`` times
    reweighted by the residuals."""
    ctes = ["""
lw_pt AS (SELECT partition_date, saldo_promedio AS x, interes_total AS y,
                 row_number() OVER (ORDER BY saldo_promedio, interes_total, partition_date) AS i,
                 count(*) OVER () AS n
          FROM by_day WHERE saldo_promedio IS NOT NULL AND interes_total IS NOT NULL),
lw_k AS (SELECT *, greatest(CAST(floor(n * CAST(2 AS DOUBLE) / 3 + 1e-10) AS INTEGER), least(n, 2)) AS k FROM lw_pt),
lw_mid AS (SELECT a.i, (a.x + b.x) / 2 AS m FROM lw_k a JOIN lw_k b ON b.i = a.i + a.k),
lw_first AS (SELECT p.*, 1 + (SELECT count(*) FROM lw_mid WHERE p.x > m) AS first FROM lw_k p),
lw_near AS (SELECT p.i, p.x, q.i AS j, q.x AS xj, q.y AS yj,
                   max(abs(q.x - p.x)) OVER (PARTITION BY p.i) AS h
            FROM lw_first p JOIN lw_k q ON q.i BETWEEN p.first AND p.first + p.k - 1),
lw_w0 AS (SELECT i, CAST(1 AS DOUBLE) AS w FROM lw_pt)"""]
    for r in range(rounds + 1):
        ctes.append(f"""
lw_t{r} AS (SELECT a.*, w * CASE WHEN h > 0 THEN pow(1 - pow(least(abs(xj - x) / h, 1), 3), 3) ELSE 1 END AS t
            FROM lw_near a JOIN lw_w{r} b ON b.i = a.j),
lw_m{r} AS (SELECT i, x, sum(t) AS sw, sum(t * xj) / nullif(sum(t), 0) AS mx, sum(t * yj) / nullif(sum(t), 0) AS my
            FROM lw_t{r} GROUP BY i, x),
lw_s{r} AS (SELECT m.i, m.x, m.sw, m.mx, m.my, sum(t * (xj - mx) * (xj - mx)) / nullif(sw, 0) AS sxx,
                   sum(t * (xj - mx) * (yj - my)) / nullif(sw, 0) AS sxy
            FROM lw_t{r} t JOIN lw_m{r} m ON m.i = t.i GROUP BY m.i, m.x, m.sw, m.mx, m.my),
lw_f{r} AS (SELECT p.*, CASE WHEN sw > 0 THEN my + CASE WHEN sxx > 1e-12 THEN (s.x - mx) * sxy / sxx ELSE 0 END
                             ELSE p.y END AS fit
            FROM lw_pt p JOIN lw_s{r} s ON s.i = p.i),
lw_w{r + 1} AS (SELECT i, pow(1 - pow(least(CASE WHEN six > 0 THEN res / six ELSE sign(res) END, 1), 2), 2) AS w
            FROM (SELECT i, abs(y - fit) AS res, 6 * median(abs(y - fit)) OVER () AS six FROM lw_f{r}))""")
    return ",".join([""] + ctes) + f"""
SELECT partition_date, x AS saldo_promedio, y AS interes_total, round(fit, 6) AS tendencia FROM lw_f{rounds}"""


