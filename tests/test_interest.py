"""Interest decision, payments and audit."""

import datetime as dt

import pytest

from ledgerline.operators import interest as ops

JOB_TS = dt.datetime(2024, 5, 2, 3, 4, 5)


ROW = "user_id string, account_id string, immovable_balance double, partition_date date"
DAY = dt.date(2024, 9, 17)


@pytest.fixture()
def history(spark):
    return spark.createDataFrame(
        [("nadia", "w31", 1250.0, DAY), ("omar", "w5", 99.99, DAY), ("lia", "w8", 100.0, DAY),
         ("lia", "w8", 640.0, dt.date(2024, 9, 18))],     # no rate that day
        ROW)


@pytest.fixture()
def rates(spark):
    return spark.createDataFrame([(DAY, 0.073)], "partition_date date, cdi_rate double")


def _by_acct(df, col):
    return {r["account_id"]: r[col] for r in df.collect()}


@pytest.mark.parametrize("decimals, w31", [(2, 0.25), (8, 0.25)])
def test_interest_of_a_day(history, rates, decimals, w31):
    pay = ops.payments(ops.decide(history, rates, 100.0, decimals))
    assert _by_acct(pay, "interest_amount") == {"w31": w31, "w5": 0.0, "w8": round(0.02, decimals)}


def test_small_interest_keeps_eight_decimals(spark, rates):
    h = spark.createDataFrame([("u", "a", 333.33, DAY)], ROW)
    assert ops.decide(h, rates).first()["interest_amount"] == 0.066666


def test_threshold_is_inclusive(history, rates):
    assert _by_acct(ops.decide(history, rates), "qualified") == {"w31": True, "w5": False, "w8": True}


def test_two_rates_of_a_day(spark, history, rates):
    twice = rates.union(rates)
    assert ops.decide(history, twice).count() == 6      # each of them pays
    assert ops.decide(history, rates, unique_rates=True).count() == 3
    with pytest.raises(Exception, match="two rates"):
        ops.decide(history, twice, unique_rates=True).collect()


def test_days_without_rate_get_no_row(history, rates):
    assert ops.payments(ops.decide(history, rates)).count() == 3


def test_payment_columns(history, rates):
    pay = ops.payments(ops.decide(history, rates))
    assert pay.columns == ["user_id", "account_id", "eligible_balance", "interest_rate",
                           "interest_amount", "is_paid", "payment_date", "partition_date"]
    r = pay.filter("account_id = 'w31'").first()
    assert (r.is_paid, r.payment_date, r.interest_rate, r.eligible_balance) == (False, None, 0.073, 1250.0)


def test_audit_rows(history, rates):
    a = ops.audit(ops.decide(history, rates), "job-1", JOB_TS)
    rows = {r.account_id: r for r in a.collect()}
    assert rows["w5"].qualified is False
    assert rows["w5"].reason == "Saldo inmovilizado menor a $100.0"
    assert rows["w31"].reason == "Califica para interés"
    assert rows["w31"].process_status == "success" and rows["w31"].error_description is None
    assert {r.job_id for r in rows.values()} == {"job-1"}
    assert {r.job_timestamp for r in rows.values()} == {JOB_TS}
    assert ops.audit(ops.decide(history, rates, min_balance=50), "j", JOB_TS) \
        .filter("account_id = 'w5'").first().reason == "Califica para interés"


def test_reason_label_follows_threshold(history, rates):
    a = ops.audit(ops.decide(history, rates, min_balance=2000), "j", JOB_TS)
    assert _by_acct(a, "reason")["w31"] == "Saldo inmovilizado menor a $2000.0"


def test_audit_defaults_fill_gaps(spark):
    rows = spark.createDataFrame(
        [(None, "", None, "", None, None, None, None, None, dt.date(2024, 5, 1)),
         ("", None, True, None, 5.0, 0.1, 0.2, "", "boom", dt.date(2024, 5, 1))],
        "user_id string, account_id string, qualified boolean, reason string, relevant_balance double, "
        "calculated_interest double, interest_rate double, process_status string, "
        "error_description string, partition_date date")
    out = ops.with_audit_defaults(rows, "j", JOB_TS, partition_date="2024-06-01").collect()
    for r in out:
        assert r.user_id == "UNKNOWN_USER" and r.account_id == "UNKNOWN_ACCOUNT"
        assert r.reason == "No reason provided" and r.process_status == "unknown"
        assert r.partition_date == dt.date(2024, 6, 1)
    assert sorted((r.relevant_balance, r.calculated_interest, r.interest_rate) for r in out) == \
        [(0.0, 0.0, 0.0), (5.0, 0.1, 0.2)]
    assert sorted(str(r.error_description) for r in out) == ["None", "boom"]


def test_small_rate_table_is_broadcast(history, rates):
    plan = ops.decide(history, rates)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_shuffle_join_fallback_gives_the_same_rows(spark):
    import __spark_entry__ as E
    r = E._Run(spark, "/root/testdata/sf0.001")
    h, rates = r.history(), r.rates()
    key = lambda x: (x.account_id, x.user_id, x.partition_date)
    a = sorted(ops.decide(h, rates, broadcast_rates=True).collect(), key=key)
    b = sorted(ops.decide(h, rates, broadcast_rates=False).collect(), key=key)
    c = sorted(ops.decide(h, rates).collect(), key=key)
    assert a == b == c
