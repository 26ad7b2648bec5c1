"""Incremental runs from a stored state equal full recomputation."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
from ledgerline.operators import cdc as cdc_ops
from ledgerline.operators import history as h
from tests.helpers import cdc

SF = "/root/testdata/sf0.001"


def _rows(df):
    key = lambda r: (r["account_id"], r["user_id"] is None, r["user_id"] or "",
                     r["partition_date"])
    return sorted(df.collect(), key=key)


def _signed(spark):
    return E._signed(E._events(spark, SF))


def test_opening_state_gives_the_same_history(spark):
    sg = _signed(spark)
    state = h.account_state(sg, "2024-01-09")
    for mode in ("zero", "carry"):
        full = h.wallet_history(sg, "2024-01-10", "2024-01-20", quiet_days=mode)
        inc = h.wallet_history(sg, "2024-01-10", "2024-01-20", quiet_days=mode, opening=state)
        assert _rows(full) == _rows(inc)


def test_only_new_events_are_needed(spark):
    sg = _signed(spark)
    state = h.account_state(sg, "2024-01-09")
    new = sg.filter("partition_date >= DATE'2024-01-10'")
    full = h.wallet_history(sg, "2024-01-10", "2024-01-12")
    assert _rows(full) == _rows(h.wallet_history(new, "2024-01-10", "2024-01-12", opening=state))


def test_state_advances_with_new_events_only(spark):
    sg = _signed(spark)
    early = h.account_state(sg, "2024-01-05")
    later = h.advance_state(early, sg.filter("partition_date > DATE'2024-01-05'"), "2024-01-12")
    assert _rows(later.withColumnRenamed("as_of", "partition_date")) == \
        _rows(h.account_state(sg, "2024-01-12").withColumnRenamed("as_of", "partition_date"))


def test_incremental_scan_starts_at_the_window(spark):
    sg = _signed(spark)
    df = h.wallet_history(sg, "2024-01-10", "2024-01-10", opening=h.account_state(sg, "2024-01-09"))
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-10T00:00)" in plan


TYPES = ["WALLET_CREATED", "DEPOSIT", "WITHDRAWAL", "TRANSFER_OUT"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["u1", "u2", None]),
                               st.sampled_from(TYPES), st.integers(0, 500), st.integers(0, 9)),
                     min_size=1, max_size=20),
       start=st.integers(1, 8), carry=st.booleans())
def test_incremental_matches_full_on_random_feeds(spark, rows, start, carry):
    feed = [(a, u, k, m, f"2024-01-{1 + d:02d} 10:00") for a, u, k, m, d in rows]
    sg = cdc_ops.signed(cdc(spark, feed))
    s = dt.date(2024, 1, 1) + dt.timedelta(days=start)
    e = s + dt.timedelta(days=2)
    mode = "carry" if carry else "zero"
    state = h.account_state(sg, (s - dt.timedelta(days=1)).isoformat())
    full = h.wallet_history(sg, s.isoformat(), e.isoformat(), quiet_days=mode)
    inc = h.wallet_history(sg, s.isoformat(), e.isoformat(), quiet_days=mode, opening=state)
    assert _rows(full) == _rows(inc)


def test_running_balance_from_state(spark):
    sg = _signed(spark)
    full = {r.event_id: r.running_balance
            for r in cdc_ops.running_balance(sg, tie="event_id")
            .filter("partition_date >= DATE'2024-01-10'").collect()}
    new = sg.filter("partition_date >= DATE'2024-01-10'")
    inc = {r.event_id: r.running_balance
           for r in cdc_ops.running_balance(new, tie="event_id",
                                            opening=h.account_state(sg, "2024-01-09")).collect()}
    assert inc == full


def test_history_with_state_matches_separate_runs(spark):
    sg = _signed(spark)
    hist, state, _ = h.history_with_state(sg, "2024-01-10", "2024-01-20")
    assert _rows(hist) == _rows(h.wallet_history(sg, "2024-01-10", "2024-01-20"))
    as_rows = lambda df: _rows(df.withColumnRenamed("as_of", "partition_date"))
    assert as_rows(state) == as_rows(h.account_state(sg, "2024-01-20"))
    opening = h.account_state(sg, "2024-01-09")
    new = sg.filter("partition_date >= DATE'2024-01-10'")
    hist2, state2, _ = h.history_with_state(new, "2024-01-10", "2024-01-20", opening=opening)
    assert _rows(hist2) == _rows(hist)
    assert as_rows(state2) == as_rows(state)


def test_null_user_is_a_pair_of_its_own(spark):
    feed = [("a", None, "DEPOSIT", 100, "2024-01-01 10:00"),
            ("a", "u1", "DEPOSIT", 50, "2024-01-02 10:00"),
            ("a", None, "WITHDRAWAL", 30, "2024-01-04 10:00")]
    sg = cdc_ops.signed(cdc(spark, feed))
    for mode in ("zero", "carry"):
        full = h.wallet_history(sg, "2024-01-03", "2024-01-04", quiet_days=mode)
        rows = {(r.user_id, r.partition_date.day): r.balance for r in full.collect()}
        assert set(rows) == {(None, 3), (None, 4), ("u1", 3), ("u1", 4)}
        assert rows[(None, 4)] == rows[("u1", 4)] == 120.0
        inc = h.wallet_history(sg, "2024-01-03", "2024-01-04", quiet_days=mode,
                               opening=h.account_state(sg, "2024-01-02"))
        assert _rows(inc) == _rows(full)


def test_state_of_the_wrong_day_fails_the_run(spark):
    import pytest
    sg = _signed(spark)
    wrong = h.account_state(sg, "2024-01-05")
    with pytest.raises(Exception, match="opening state must be as of the day before 2024-01-10"):
        h.wallet_history(sg, "2024-01-10", "2024-01-12", opening=wrong).collect()


def test_advance_state_ignores_events_the_state_holds(spark):
    sg = _signed(spark)
    early = h.account_state(sg, "2024-01-05")
    later = h.advance_state(early, sg, "2024-01-12")     # the whole feed, on purpose
    as_rows = lambda df: _rows(df.withColumnRenamed("as_of", "partition_date"))
    assert as_rows(later) == as_rows(h.account_state(sg, "2024-01-12"))


def test_running_balance_from_state_skips_old_events(spark):
    sg = _signed(spark)
    state = h.account_state(sg, "2024-01-09")
    lines = cdc_ops.running_balance(sg, tie="event_id", opening=state)   # whole feed, on purpose
    full = cdc_ops.running_balance(sg, tie="event_id").filter("partition_date >= DATE'2024-01-10'")
    assert {r.event_id: r.running_balance for r in lines.collect()} == \
        {r.event_id: r.running_balance for r in full.collect()}
