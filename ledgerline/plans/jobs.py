"""End-to-end runs: history, rates, interest with audit.

Each run is one declarative plan per sink. Row counts for run logs come
from ``observe`` on the written frame (no extra scan); emptiness guards look
at the cheapest input that decides them (``isEmpty`` reads one row).
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import constants as K
from ledgerline.functions import event_timestamp, in_window, validate_dates
from ledgerline.operators import cdc as cdc_ops
from ledgerline.operators import history as hist_ops
from ledgerline.operators import interest as int_ops
from ledgerline.operators import rates as rate_ops
from ledgerline.operators import reports as rep
from ledgerline.session import require_utc
from ledgerline.sources import files, jdbc

# A sink writes a frame, counting the rows it wrote into the observation,
# attached right before the write so that sampling or emptiness jobs of the
# sink are not counted. It returns whether it wrote anything (``obs.get``
# would wait forever for a write that never ran).
Sink = Callable[[DataFrame, Observation], bool]


@dataclass
class ParquetSink:
    """Day-partitioned Parquet table as a sink. With ``replaces`` a run writes
    its window's days to a staging folder first (``stage``) and puts them in
    place when everything is written (``commit``): a run that fails before
    leaves the table as it was, and a commit that was interrupted is finished
    by the next write."""
    path: str
    dynamic: bool = True
    mode: str = "overwrite"

    @property
    def replaces(self) -> bool:
        return self.mode == "overwrite" and self.dynamic

    def __call__(self, df: DataFrame, obs: Observation) -> bool:
        files.write_by_day(df, self.path, mode=self.mode, dynamic=self.dynamic, observation=obs)
        return True

    def stage(self, df: DataFrame, obs: Observation) -> str:
        files.finish_commits(df.sparkSession, self.path)
        return files.stage_by_day(df, self.path, observation=obs)

    def commit(self, spark: SparkSession, staged: str | None, start: str, end: str) -> list[str]:
        return files.commit_days(spark, self.path, staged, start, end)

    def drop(self, spark: SparkSession, staged: str) -> None:
        files.drop_staged(spark, self.path, staged)


def parquet_sink(path: str, dynamic: bool = True, mode: str = "overwrite") -> ParquetSink:
    """Day-partitioned Parquet; ``dynamic`` overwrite replaces only the days of
    the run's window, by a staged commit. ``mode="append"`` keeps every run's
    rows (an audit log whose runs are told apart by ``job_id``)."""
    return ParquetSink(path, dynamic, mode)


def jdbc_sink(url: str, table: str, properties: dict[str, str], mode: str = "overwrite",
              truncate: bool = False, writers: int = K.MIN_JDBC_WRITERS,
              decides: DataFrame | None = None) -> Sink:
    """JDBC table; skipped when ``decides`` is given and empty."""
    def write(df: DataFrame, obs: Observation) -> bool:
        return jdbc.write_table(df, url, table, properties, mode=mode, truncate=truncate,
                                writers=writers, observation=obs, decides=decides)
    return write


def _write_window(spark: SparkSession, frames: list[tuple[str, DataFrame, Sink]], start: str,
                  end: str) -> tuple[dict[str, int], list[str]]:
    """Writes each (name, frame, sink). Sinks that replace days are staged
    first and committed once all frames are written, so a failure before that
    leaves every such table as it was. Returns the rows written by name and
    the earlier days replaced or removed."""
    rows: dict[str, int] = {}
    staged: list[tuple[ParquetSink, str]] = []
    try:
        for name, df, sink in frames:
            obs, wrote = Observation(name), True
            if getattr(sink, "replaces", False):
                staged.append((sink, sink.stage(df, obs)))
            else:
                wrote = sink(df, obs)
            rows[name] = int(obs.get.get("rows", 0)) if wrote else 0
    except Exception:
        for sink, folder in staged:
            sink.drop(spark, folder)
        raise
    return rows, sorted({d for sink, folder in staged for d in sink.commit(spark, folder, start, end)})


@dataclass
class RunResult:
    written: bool
    rows: dict[str, int] = field(default_factory=dict)
    job_id: str | None = None
    cleared: list[str] = field(default_factory=list)   # days of an earlier run that were replaced or removed
    undated: int = 0    # events whose text time does not parse: they have no day


def build_history(cdc: DataFrame, start: str, end: str | None, sink: Sink,
                  netting: str = "observed", quiet_days: str = "zero",
                  state_path: str | None = None, pairs_path: str | None = None,
                  day_column: str | None = None) -> RunResult:
    """Quality rules, then the dense history of the window into ``sink``.

    Raises ValueError with every rule message when the feed is invalid.
    Writes nothing when the feed has no events (the history would be
    empty: it has one row per account ever seen and day). Events whose text
    time does not parse are counted in ``RunResult.undated``.

    With ``state_path``, balances are carried between runs: from the latest
    stored state before ``start`` (advanced over any skipped days), only
    events after that state's day are checked and read (older days are
    skipped by a pushed filter), and the state through ``end`` is written
    for the next run. Without any earlier state the whole feed is used and
    the state is written. Runs are idempotent per day; after re-running an
    earlier day with corrected events, the later days must be re-run too,
    since their balances build on it.

    Late events: a ledger of events per day is stored beside the state. The
    feed may hold only the new days, or older ones too. Its row count, which
    Parquet footers give without reading a row, less the new events says how
    many older ones it has: none, or exactly as many as the ledger holds, is
    right. Otherwise the feed's older days are counted one by one, from the
    event time alone; a day with another number than the ledger's raises (an
    event arrived late, or was withdrawn) and nothing is written: run again
    without the state then.

    ``pairs_path``: stored dictionary of (account, user) pairs. It names the
    grid rows of accounts not seen up to ``end``, so events after ``end`` are
    skipped by a pushed filter; the first run builds it from two columns of
    the feed, every run adds the new pairs of the events it read.

    ``day_column``: partition column of the feed that equals the event's day;
    older partitions are pruned then. An event in another day's partition
    counts as a late one.
    """
    start, end = validate_dates(start, end)
    spark = cdc.sparkSession
    require_utc(spark)
    opening, since, ledger = None, start, {}
    if state_path is not None:
        before = (_dt.date.fromisoformat(start) - _dt.timedelta(days=1)).isoformat()
        earlier = [d for d in files.state_days(spark, state_path) if d <= before]
        if earlier:
            opening = files.read_state(spark, state_path, earlier[-1])
            since = (_dt.date.fromisoformat(earlier[-1]) + _dt.timedelta(days=1)).isoformat()
            ledger = files.read_day_ledger(spark, state_path, earlier[-1])
    feed = cdc if opening is None else cdc.filter(_from_day(cdc, since, day_column))
    cdc_ops.require_valid(feed)
    new: dict[str | None, int] = {}
    if state_path is not None:
        new = _events_by_day(feed)
        if opening is not None and ledger is not None:
            _require_ledger(cdc, since, day_column, new, ledger, earlier[-1])
    if opening is None and (not new if state_path is not None else feed.isEmpty()):
        return RunResult(False)
    undated = 0 if _is_timestamp(cdc) else cdc_ops.unparsed_times(feed).first()["events"]
    sg = cdc_ops.signed(feed)
    pairs = None
    if pairs_path is not None:
        pairs = files.read_pairs(spark, pairs_path)
        if pairs is None:
            files.write_pairs(hist_ops.pair_dictionary(cdc_ops.signed(cdc)), pairs_path)
            pairs = files.read_pairs(spark, pairs_path)
    if opening is not None and since != start:
        # days skipped since the stored state: bring it up to the day before start
        opening = hist_ops.advance_state(opening, sg, before)
    if state_path is None:
        history = hist_ops.wallet_history(sg, start, end, netting, quiet_days, pairs=pairs)
        rows, cleared = _write_window(spark, [("wallet_history", history, sink)], start, end)
    else:
        # history and next state from one rollup, persisted while both are
        # written: the feed is scanned once for them (lost blocks are recomputed)
        history, state, rollup = hist_ops.history_with_state(sg, start, end, netting, quiet_days,
                                                             opening=opening, pairs=pairs)
        rollup.persist(StorageLevel.DISK_ONLY)
        try:
            rows, cleared = _write_window(spark, [("wallet_history", history, sink)], start, end)
            if ledger is not None:
                held = ledger | {d: n + ledger.get(d, 0) for d, n in new.items() if d is None or d <= end}
                files.write_day_ledger(spark, state_path, end, held)
            files.write_state(state, state_path)
        finally:
            rollup.unpersist()
    if pairs is not None:
        # only rows of two columns of the events read; an append of what is new
        seen = hist_ops.pair_dictionary(hist_ops.until_day(sg, end))
        same = pairs["account_id"].eqNullSafe(seen["account_id"]) & pairs["user_id"].eqNullSafe(seen["user_id"])
        files.write_pairs(seen.join(pairs, same, "left_anti"), pairs_path)
    return RunResult(True, rows, cleared=cleared, undated=undated)


def _is_timestamp(cdc: DataFrame) -> bool:
    return isinstance(cdc.schema["event_time"].dataType, (T.TimestampType, T.TimestampNTZType))


def _event_ts(cdc: DataFrame):
    return event_timestamp("event_time", cdc.schema["event_time"].dataType)


def _events_by_day(cdc: DataFrame) -> dict[str | None, int]:
    """Events per day (None: undated) from the event time alone; one row per
    calendar day comes back."""
    day = F.to_date(_event_ts(cdc)).cast("string").alias("day")
    return {r["day"]: r["events"] for r in cdc.groupBy(day).agg(F.count(F.lit(1)).alias("events")).collect()}


def _require_ledger(cdc: DataFrame, since: str, day_column: str | None, new: dict, ledger: dict, as_of: str) -> None:
    """Raises when the feed's events before ``since`` are not those of the ledger."""
    # no column is asked for, so the count comes from the files' footers
    older = cdc.count() - sum(n for d, n in new.items() if d is not None)
    if older in (0, sum(ledger.values())):
        return
    changed = {d: n for d, n in _events_by_day(cdc.filter(~_from_day(cdc, since, day_column))).items()
               if ledger.get(d) != n}
    if changed:
        raise ValueError(f"events up to {as_of} changed after its state was stored, on "
                         f"{', '.join(sorted(map(str, changed)))}: rebuild the history without the state")


def _from_day(cdc: DataFrame, start: str, day_column: str | None = None):
    """Events from ``start`` on (and those without a time, which the rules
    reject), stated on the raw event time so the scan skips older row groups,
    and on the partition column, if there is one, so it skips older folders.
    Text times that do not parse belong to no day and count as older."""
    ts_type = cdc.schema["event_time"].dataType
    if _is_timestamp(cdc):
        newer = F.col("event_time") >= F.lit(f"{start} 00:00:00").cast(ts_type)
    else:
        newer = F.coalesce(F.to_date(_event_ts(cdc)) >= F.lit(start).cast("date"), F.lit(False))
    newer = F.col("event_time").isNull() | newer
    if day_column is not None:
        newer &= F.col(day_column).cast("date") >= F.lit(start).cast("date")
    return newer


def fetch_rates(spark: SparkSession, raw_path: str, output_path: str,
                start: str | None = None, end: str | None = None,
                dynamic: bool = True) -> RunResult:
    """Landed feed files (JSON arrays or JSON Lines) -> normalised rates ->
    day-partitioned Parquet, optionally only the days of ``start``..``end``.
    Returns ``written=False`` when no row survives."""
    require_utc(spark)
    rates = rate_ops.normalize(files.read_rates_json(spark, raw_path))
    if start is not None:
        start, end = validate_dates(start, end)
        rates = rate_ops.in_range(rates, start, end)
    if rates.isEmpty():
        return RunResult(False)
    obs = Observation("rates")
    files.write_rates(rates, output_path, dynamic, observation=obs)
    return RunResult(True, {"rates": int(obs.get.get("rows", 0))})


def calculate_interest(history: DataFrame, rates: DataFrame, start: str, end: str | None,
                       payments_sink: Sink, audit_sink: Sink | None = None,
                       min_balance: float = K.DEFAULT_MIN_BALANCE,
                       decimals: int = K.DEFAULT_DECIMALS,
                       job_id: str | None = None,
                       job_timestamp: _dt.datetime | None = None) -> RunResult:
    """History and rates of the window (one day when ``end`` is None) ->
    payments and audit rows.

    Both outputs are projections of one decision frame. When both sinks
    run, the decision is persisted to executor disk so the history is read
    once; a lost executor's blocks are recomputed from the plan. ``history``
    is meant to be a stored table (``read_history``): the emptiness check
    reads one row of it.
    """
    require_utc(history.sparkSession)
    job_id = job_id or str(uuid.uuid4())
    job_timestamp = job_timestamp or _dt.datetime.now()
    spark, window = history.sparkSession, validate_dates(start, end)
    history = history.filter(in_window("partition_date", start, end))
    rates = rate_ops.in_range(rates, start, end)
    # one bounded count answers both "any rates?" and "small enough to broadcast?"
    n_rates = rates.limit(int_ops.MAX_BROADCAST_RATE_ROWS + 1).count()
    if n_rates == 0 or history.isEmpty():
        sinks = [s for s in (payments_sink, audit_sink) if getattr(s, "replaces", False)]
        cleared = sorted({d for s in sinks for d in s.commit(spark, None, *window)})
        return RunResult(False, job_id=job_id, cleared=cleared)
    decision = int_ops.decide(history, rates, min_balance, decimals,
                              broadcast_rates=n_rates <= int_ops.MAX_BROADCAST_RATE_ROWS)
    if audit_sink is not None:
        decision = decision.persist(StorageLevel.DISK_ONLY)
    frames = [("audit", int_ops.audit(decision, job_id, job_timestamp), audit_sink)] if audit_sink is not None else []
    try:
        rows, cleared = _write_window(spark, [*frames, ("payments", int_ops.payments(decision), payments_sink)],
                                      *window)
    finally:
        decision.unpersist()
    return RunResult(True, rows, job_id, cleared)


def read_history(spark: SparkSession, path: str, start: str, end: str | None = None) -> DataFrame:
    """History written by ``parquet_sink``, pruned to the window (the files'
    own schema, so zoned and local movement times both read back)."""
    return files.read_by_day(spark, path, None, start, end)


def read_payments(spark: SparkSession, path: str, start: str, end: str | None = None) -> DataFrame:
    """Payments written by ``parquet_sink``, pruned to the window."""
    return files.read_by_day(spark, path, None, start, end)


def read_audit(spark: SparkSession, path: str, start: str, end: str | None = None) -> DataFrame:
    """Audit rows written by ``parquet_sink``, pruned to the window."""
    return files.read_by_day(spark, path, None, start, end)


def reports(payments: DataFrame, audit: DataFrame, start: str, end: str,
            detail_min_balance: float = K.DETAIL_MIN_BALANCE,
            detail_min_interest: float = K.DETAIL_MIN_INTEREST,
            detail_k: int = K.DETAIL_LIMIT, bins: int = K.HISTOGRAM_BINS) -> dict[str, DataFrame]:
    """Every reporting query of the window, by name: lazy frames, no job runs
    until one of them is used."""
    start, end = validate_dates(start, end)
    by_day = rep.payments_by_day(payments, start, end)
    return {
        "audit_summary": rep.audit_summary(audit, start, end),
        "audit_reasons": rep.audit_reasons(audit, start, end),
        "eligibility_split": rep.eligibility_split(audit, start, end),
        "payments_by_day": by_day,
        "payments_detail": rep.payments_detail(payments, start, end, detail_min_balance,
                                               detail_min_interest, detail_k),
        "payments_distribution": rep.payments_distribution(payments, start, end),
        "interest_histogram": rep.interest_histogram(payments, start, end, bins),
        "balance_interest_trend": rep.balance_interest_trend(rep.payments_by_day(payments, start, end, ordered=False)),
        "balance_interest_lowess": rep.balance_interest_lowess(rep.payments_by_day(payments, start, end, ordered=False)),
    }
