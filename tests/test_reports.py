"""Reporting queries and the chart-side reductions."""

import datetime as dt

import pytest

from ledgerline.operators import reports as rep

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
AUDIT_SCHEMA = "account_id string, qualified boolean, reason string, relevant_balance double, " \
               "process_status string, partition_date date"
PAY_SCHEMA = "user_id string, account_id string, eligible_balance double, interest_rate double, " \
             "interest_amount double, partition_date date"


@pytest.fixture()
def audit(spark):
    return spark.createDataFrame([
        ("a", True, "ok", 150.10, "success", D1),
        ("b", False, "low", 20.20, "success", D1),
        ("c", False, "low", 30.30, "error", D2),
        ("d", None, "unknown", None, "success", D2),
        ("e", False, "other", 1.00, "success", dt.date(2024, 3, 1)),
    ], AUDIT_SCHEMA)


@pytest.fixture()
def pay(spark):
    return spark.createDataFrame([
        ("u1", "a", 300.0, 0.1, 0.08, D1),
        ("u2", "b", 100.0, 0.1, 0.03, D1),
        ("u3", "c", 500.0, 0.1, 0.14, D2),
        ("u4", "d", 500.0, 0.1, 0.14, D2),
        ("u5", "e", 50.0, 0.1, 0.0, D2),
    ], PAY_SCHEMA)


def test_audit_summary(audit):
    r = rep.audit_summary(audit, "2024-01-01", "2024-01-31").first()
    assert r.total_registros == 4 and r.cuentas_calificadas == 1
    assert r.saldo_promedio == pytest.approx((150.10 + 20.20 + 30.30) / 3)
    assert r.tasa_error == 25.0


def test_audit_summary_of_empty_window(audit):
    r = rep.audit_summary(audit, "2025-01-01", "2025-01-31").collect()
    assert len(r) == 1 and r[0].total_registros == 0 and r[0].saldo_promedio is None


def test_audit_reasons_leave_out_null_decisions(audit):
    rows = rep.audit_reasons(audit, "2024-01-01", "2024-01-31").collect()
    assert [(r.reason, r["count"]) for r in rows] == [("low", 2)]


def test_payments_by_day(pay):
    rows = rep.payments_by_day(pay, "2024-01-01", "2024-01-02").collect()
    assert [(r.partition_date, r.cuentas) for r in rows] == [(D1, 2), (D2, 3)]
    assert rows[0].interes_total == 0.11 and rows[1].interes_total == 0.28
    assert rows[0].saldo_promedio == 200.0 and rows[1].saldo_promedio == 350.0


def test_payments_detail_top_k_is_deterministic(pay):
    rows = rep.payments_detail(pay, "2024-01-01", "2024-01-02", min_balance=100,
                               min_interest=0.03, k=2).collect()
    assert [r.account_id for r in rows] == ["c", "d"]
    rows = rep.payments_detail(pay, "2024-01-01", "2024-01-02", k=1000).collect()
    assert rows == []   # default minimum interest of 10 filters everything here


def test_payments_distribution(pay):
    assert rep.payments_distribution(pay, "2024-01-02", "2024-01-02").count() == 3


def test_histogram_edges_and_counts(spark):
    vals = [(f"a{i}", float(i), D1) for i in range(0, 101)]
    pay = spark.createDataFrame(vals, "account_id string, interest_amount double, partition_date date")
    rows = rep.interest_histogram(pay, "2024-01-01", "2024-01-01", bins=10).collect()
    assert [r.bin for r in rows] == list(range(1, 11))
    assert sum(r["count"] for r in rows) == 101
    assert rows[-1]["count"] == 11          # the maximum belongs to the last bin
    assert rows[0].bin_lo == 0.0 and rows[-1].bin_hi == 100.0


def test_histogram_of_constant_column(spark):
    pay = spark.createDataFrame([("a", 0.0, D1), ("b", 0.0, D1)],
                                "account_id string, interest_amount double, partition_date date")
    rows = rep.interest_histogram(pay, "2024-01-01", "2024-01-01").collect()
    assert [(r.bin, r["count"]) for r in rows if r["count"]] == [(1, 2)]
    assert len(rows) == 20


def test_histogram_of_empty_window(pay):
    assert rep.interest_histogram(pay, "2030-01-01", "2030-01-02").count() == 0


def test_eligibility_split(audit):
    rows = {r.estado: (r.cantidad, r.share) for r in rep.eligibility_split(audit, "2024-01-01", "2024-01-31").collect()}
    assert rows == {"Calificadas": (1, 0.25), "No Calificadas": (3, 0.75)}
    rows = {r.estado: r.cantidad for r in rep.eligibility_split(audit, "2024-03-01", "2024-03-01").collect()}
    assert rows == {"Calificadas": 0, "No Calificadas": 1}


def test_trend_of_a_straight_line(spark):
    by_day = spark.createDataFrame([(float(x), 2.0 * x + 1.0) for x in range(1, 8)],
                                   "saldo_promedio double, interes_total double")
    r = rep.balance_interest_trend(by_day).first()
    assert (r.n_days, r.correlation, r.slope, r.intercept) == (7, 1.0, 2.0, 1.0)
