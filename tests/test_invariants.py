"""Invariants over the supplied events (sf0.01)."""

import datetime as dt

from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline.operators import interest as i
from ledgerline.plans import jobs

SF = "/root/testdata/sf0.01"


def test_history_is_one_row_per_pair_and_day(spark):
    r = E._Run(spark, SF)
    hist = r.history()
    days = (dt.date.fromisoformat(r.end) - dt.date.fromisoformat(r.start)).days + 1
    pairs = r.signed().select("account_id", "user_id").distinct().count()
    assert hist.count() == pairs * days
    assert hist.select("account_id", "user_id", "partition_date").distinct().count() == pairs * days
    moving = hist.filter("transactions_count > 0").count()
    quiet = hist.filter("transactions_count = 0").count()
    assert moving + quiet == pairs * days
    # quiet days earn nothing and have no movement time in the default mode
    assert hist.filter("transactions_count = 0 AND (balance <> 0 OR last_movement_ts IS NOT NULL)").count() == 0


def test_counts_add_up_to_the_feed(spark):
    r = E._Run(spark, SF)
    # an account's days repeat for each of its users; count each day once
    days = r.history().groupBy("account_id", "partition_date").agg(
        F.min("transactions_count").alias("n"), F.max("transactions_count").alias("same"))
    assert days.filter("n <> same").count() == 0
    assert days.agg(F.sum("n")).first()[0] == r.signed().count()


def test_immovable_never_exceeds_previous_balance(spark):
    hist = E._Run(spark, SF).history(quiet_days="carry")
    bad = hist.filter("immovable_balance > greatest(balance_previous, 0) OR immovable_balance < 0")
    assert bad.count() == 0


def test_payments_and_audit_rows_match(spark):
    r = E._Run(spark, SF)
    d = r.decision()
    pay, aud = i.payments(d), i.audit(d, "j", dt.datetime(2024, 1, 1))
    assert pay.count() == aud.count()
    rated = {x.partition_date for x in r.rates().collect()}
    assert {x.partition_date for x in pay.select("partition_date").distinct().collect()} <= rated
    assert pay.filter("interest_amount > 0 AND eligible_balance < 100").count() == 0


def test_empty_rate_window_writes_nothing(spark, tmp_path):
    r = E._Run(spark, SF)
    res = jobs.calculate_interest(r.history(), r.rates(), "2030-01-01", None,
                                  jobs.parquet_sink(str(tmp_path / "p")))
    assert not res.written
