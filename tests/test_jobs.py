"""End-to-end runs through Parquet sinks: history -> rates -> interest + audit."""

import datetime as dt
import json

import pytest

from ledgerline.plans import jobs
from ledgerline.sources import files
from tests.helpers import cdc

ROWS = [
    ("acc1", "user1", "WALLET_CREATED", 0, "2024-01-01 09:00"),
    ("acc1", "user1", "DEPOSIT", 300, "2024-01-01 10:00"),
    ("acc2", "user2", "DEPOSIT", 50, "2024-01-01 10:00"),
    ("acc1", "user1", "WITHDRAWAL", 50, "2024-01-02 12:00"),
]


def test_full_run(spark, tmp_path):
    hist_path, rates_path = str(tmp_path / "history"), str(tmp_path / "rates")
    pay_path, audit_path = str(tmp_path / "payments"), str(tmp_path / "audit")
    res = jobs.build_history(cdc(spark, ROWS), "2024-01-01", "2024-01-03", jobs.parquet_sink(hist_path))
    assert res.written and res.rows == {"wallet_history": 6}

    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.json").write_text(json.dumps([{"data": f"0{d}/01/2024", "valor": "36.5"} for d in (1, 2, 3)]))
    assert jobs.fetch_rates(spark, str(feed), rates_path).rows == {"rates": 3}

    history = jobs.read_history(spark, hist_path, "2024-01-02", "2024-01-03")
    rates = files.read_rates(spark, rates_path)
    res = jobs.calculate_interest(history, rates, "2024-01-02", "2024-01-03",
                                  jobs.parquet_sink(pay_path), jobs.parquet_sink(audit_path),
                                  job_id="run-1", job_timestamp=dt.datetime(2024, 1, 4))
    assert res.rows == {"audit": 4, "payments": 4}
    pay = {(r.account_id, str(r.partition_date)): r.interest_amount
           for r in spark.read.parquet(pay_path).collect()}
    # acc1 on 01-02: previous 300, withdrawal-only day -> immovable 300; 300 * 0.365/365
    assert pay[("acc1", "2024-01-02")] == 0.3
    assert pay[("acc2", "2024-01-02")] == 0.0
    assert pay[("acc1", "2024-01-03")] == 0.0          # quiet day: zero balance
    audit = spark.read.parquet(audit_path)
    assert {r.job_id for r in audit.collect()} == {"run-1"}


def test_invalid_feed_stops_the_history_run(spark, tmp_path):
    bad = ROWS + [("acc3", "u", "DEPOSIT", -5, "2024-01-01 10:00")]
    with pytest.raises(ValueError, match="monto negativo"):
        jobs.build_history(cdc(spark, bad), "2024-01-01", None, jobs.parquet_sink(str(tmp_path / "h")))


def test_empty_inputs_write_nothing(spark, tmp_path):
    res = jobs.build_history(cdc(spark, []), "2024-01-01", None, jobs.parquet_sink(str(tmp_path / "h")))
    assert not res.written
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.json").write_text(json.dumps([{"data": "x", "valor": "y"}]))
    assert not jobs.fetch_rates(spark, str(feed), str(tmp_path / "r")).written


def test_daily_runs_carry_state(spark, tmp_path):
    """Day-by-day runs that read only each day's events equal one full run."""
    import __spark_entry__ as E
    feed = E._cdc(E._events(spark, "/root/testdata/sf0.001")).drop("event_id")
    state = str(tmp_path / "state")
    daily_out = str(tmp_path / "daily")
    jobs.build_history(feed.filter("event_time < TIMESTAMP_NTZ'2024-01-08 00:00:00'"),
                       "2024-01-05", "2024-01-07", jobs.parquet_sink(daily_out), state_path=state)
    for day in ("2024-01-08", "2024-01-09", "2024-01-10"):
        todays = feed.filter(f"to_date(event_time) = DATE'{day}'")
        res = jobs.build_history(todays, day, None, jobs.parquet_sink(daily_out), state_path=state)
        assert res.written
    full_out = str(tmp_path / "full")
    jobs.build_history(feed.filter("event_time < TIMESTAMP_NTZ'2024-01-11 00:00:00'"),
                       "2024-01-05", "2024-01-10", jobs.parquet_sink(full_out))
    a = jobs.read_history(spark, daily_out, "2024-01-05", "2024-01-10")
    b = jobs.read_history(spark, full_out, "2024-01-05", "2024-01-10")
    key = lambda r: (r.account_id, r.user_id, r.partition_date)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
    assert a.count() == 6 * feed.select("account_id", "user_id").distinct().count()


def test_jdbc_sink_skips_empty_frames_without_connecting(spark):
    from ledgerline.sources import jdbc
    empty = spark.createDataFrame([], "a int")
    assert jdbc.write_table(empty, "jdbc:none://nowhere", "t", {}, decides=empty) is False
    sink = jobs.jdbc_sink("jdbc:none://nowhere", "t", {}, decides=empty)
    from pyspark.sql import Observation
    assert sink(empty, Observation("x")) is False


def test_jdbc_write_runs_no_job_on_the_frame_first(spark, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter
    from ledgerline.sources import jdbc
    written = []
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, **kw: written.append((self, kw)))
    ran = spark.sparkContext.accumulator(0)
    frame = spark.range(10).mapInPandas(lambda parts: (ran.add(1) or p for p in parts), "id long")
    assert jdbc.write_table(frame, "jdbc:none://x", "t", {}, writers=3)
    assert len(written) == 1 and ran.value == 0
    for writers in (0, jdbc.MAX_WRITERS + 1):
        with pytest.raises(ValueError, match="writers"):
            jdbc.write_table(frame, "jdbc:none://x", "t", {}, writers=writers)


def test_a_rerun_removes_days_without_rows(spark, tmp_path):
    day = dt.date(2024, 3, 5)
    history = spark.createDataFrame([("u", "a", 500.0, day)], "user_id string, account_id string, "
                                    "immovable_balance double, partition_date date")
    rates = spark.createDataFrame([(day, 0.2)], "partition_date date, cdi_rate double")
    sink = jobs.parquet_sink(str(tmp_path / "p"))
    args = ("2024-03-05", "2024-03-05", sink)
    assert jobs.calculate_interest(history, rates, *args).written
    again = jobs.calculate_interest(history, rates.where("false"), *args)
    assert not again.written and again.cleared == ["2024-03-05"]
    assert not list((tmp_path / "p").glob("partition_date=*"))


def test_late_events_fail_an_incremental_run(spark, tmp_path):
    from tests.helpers import cdc
    rows = [("w1", "k1", "DEPOSIT", 40, "2024-03-01 08:00"), ("w1", "k1", "DEPOSIT", 60, "2024-03-02 08:00")]
    late = [*rows, ("w1", "k1", "DEPOSIT", 7, "2024-03-01 23:00")]
    sink, state = jobs.parquet_sink(str(tmp_path / "h")), str(tmp_path / "s")
    jobs.build_history(cdc(spark, rows), "2024-03-01", "2024-03-01", sink, state_path=state)
    with pytest.raises(ValueError, match="rebuild"):
        jobs.build_history(cdc(spark, late), "2024-03-02", "2024-03-02", sink, state_path=state)
    assert jobs.build_history(cdc(spark, rows), "2024-03-02", "2024-03-02", sink, state_path=state).written


def test_jobs_refuse_another_time_zone(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        with pytest.raises(ValueError, match="UTC"):
            jobs.fetch_rates(spark, str(tmp_path), str(tmp_path / "r"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_scratch_needs_a_shared_folder():
    from types import SimpleNamespace
    from ledgerline.session import shared_dir
    none = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
                           conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError, match="checkpoint"):
        shared_dir(none)


def test_fetch_rates_keeps_the_requested_days(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.json").write_text(json.dumps([{"data": f"0{d}/01/2024", "valor": "10"} for d in (1, 2, 3, 4)]))
    res = jobs.fetch_rates(spark, str(feed), str(tmp_path / "r"), "2024-01-02", "2024-01-03")
    assert res.rows == {"rates": 2}


def test_incremental_feed_filter_reaches_the_scan(spark, tmp_path):
    import __spark_entry__ as E
    path = str(tmp_path / "cdc")
    E._cdc(E._events(spark, "/root/testdata/sf0.001")).write.parquet(path)
    feed = files.read_cdc(spark, path)
    plan = feed.filter(jobs._from_day(feed, "2024-01-10"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time,2024-01-10T00:00)" in plan


def test_audit_log_can_append_runs(spark, tmp_path):
    import __spark_entry__ as E
    r = E._Run(spark, "/root/testdata/sf0.001")
    audit_path = str(tmp_path / "audit")
    for run in ("run-a", "run-b"):
        jobs.calculate_interest(r.history(), r.rates(), r.start, r.end,
                                jobs.parquet_sink(str(tmp_path / "pay")),
                                jobs.parquet_sink(audit_path, mode="append"), job_id=run)
    log = spark.read.parquet(audit_path)
    counts = {x.job_id: x["count"] for x in log.groupBy("job_id").count().collect()}
    assert set(counts) == {"run-a", "run-b"} and counts["run-a"] == counts["run-b"] > 0


def test_reports_over_stored_tables(spark, tmp_path):
    import __spark_entry__ as E
    r = E._Run(spark, "/root/testdata/sf0.001")
    pay_path, audit_path = str(tmp_path / "pay"), str(tmp_path / "audit")
    jobs.calculate_interest(r.history(), r.rates(), r.start, r.end,
                            jobs.parquet_sink(pay_path), jobs.parquet_sink(audit_path), job_id="x")
    pay = jobs.read_payments(spark, pay_path, r.start, r.end)
    aud = jobs.read_audit(spark, audit_path, r.start, r.end)
    out = jobs.reports(pay, aud, r.start, r.end, detail_min_interest=0.0, detail_k=5)
    assert out["audit_summary"].first().total_registros == aud.count() == pay.count()
    assert out["payments_detail"].count() == 5
    assert sum(x["count"] for x in out["interest_histogram"].collect()) == pay.count()
    assert out["balance_interest_trend"].first().n_days == out["payments_by_day"].count()


def test_skipped_days_advance_the_latest_state(spark, tmp_path):
    import __spark_entry__ as E
    feed = E._cdc(E._events(spark, "/root/testdata/sf0.001")).drop("event_id")
    state, out = str(tmp_path / "state"), str(tmp_path / "hist")
    jobs.build_history(feed.filter("event_time < TIMESTAMP_NTZ'2024-01-06 00:00:00'"),
                       "2024-01-05", None, jobs.parquet_sink(out), state_path=state)
    # no runs for 01-06 .. 01-08; the 01-09 run reads 01-06 onwards only
    jobs.build_history(feed.filter("event_time < TIMESTAMP_NTZ'2024-01-10 00:00:00'"),
                       "2024-01-09", None, jobs.parquet_sink(out), state_path=state)
    full = str(tmp_path / "full")
    jobs.build_history(feed.filter("event_time < TIMESTAMP_NTZ'2024-01-10 00:00:00'"),
                       "2024-01-09", None, jobs.parquet_sink(full))
    key = lambda r: (r.account_id, r.user_id, r.partition_date)
    a = sorted(jobs.read_history(spark, out, "2024-01-09").collect(), key=key)
    b = sorted(jobs.read_history(spark, full, "2024-01-09").collect(), key=key)
    assert a == b and len(a) > 0
    assert files.state_days(spark, state) == ["2024-01-05", "2024-01-09"]


def test_zoned_event_times_round_trip(spark, tmp_path):
    """A feed with zoned TIMESTAMP event times writes and reads back its history."""
    from pyspark.sql import functions as F
    import __spark_entry__ as E
    feed = (E._cdc(E._events(spark, "/root/testdata/sf0.001")).drop("event_id")
            .withColumn("event_time", F.col("event_time").cast("timestamp")))
    out = str(tmp_path / "h")
    jobs.build_history(feed, "2024-01-05", "2024-01-06", jobs.parquet_sink(out))
    back = jobs.read_history(spark, out, "2024-01-06")
    assert dict(back.dtypes)["last_movement_ts"] == "timestamp"
    assert back.count() == feed.select("account_id", "user_id").distinct().count()


def test_job_flow_through_storage_equals_registered_queries(spark, tmp_path):
    """History -> rates -> interest through Parquet sinks gives exactly the
    rows of the registered (oracle-checked) queries."""
    from pyspark.sql import functions as F
    import __spark_entry__ as E
    from ledgerline.sources import standins
    sf, out = "/root/testdata/sf0.001", str(tmp_path)
    ev = E._events(spark, sf)
    start, end = files.data_window(E._signed(ev))
    standins.cdc_from_events(ev).write.parquet(f"{out}/cdc")
    standins.rates_raw_from_events(ev).coalesce(1).write.json(f"{out}/feed")
    jobs.build_history(files.read_cdc(spark, f"{out}/cdc"), start, end,
                       jobs.parquet_sink(f"{out}/h"), state_path=f"{out}/s")
    jobs.fetch_rates(spark, f"{out}/feed", f"{out}/r", start, end)
    jobs.calculate_interest(jobs.read_history(spark, f"{out}/h", start, end),
                            files.read_rates(spark, f"{out}/r", start, end), start, end,
                            jobs.parquet_sink(f"{out}/p"), jobs.parquet_sink(f"{out}/a"),
                            job_id=E.JOB_ID, job_timestamp=E.JOB_TS)

    def rows(df):
        df = df.withColumn("partition_date", F.col("partition_date").cast("string"))
        cols = sorted(df.columns)
        return sorted(tuple(str(r[c]) for c in cols) for r in df.select(*cols).collect())

    assert rows(jobs.read_history(spark, f"{out}/h", start, end)) == \
        rows(E.queries()["wallet_history"](spark, sf))
    assert rows(jobs.read_payments(spark, f"{out}/p", start, end)) == \
        rows(E.queries()["interest_payments"](spark, sf))
    assert rows(jobs.read_audit(spark, f"{out}/a", start, end)) == \
        rows(E.queries()["interest_audit"](spark, sf))
