"""Plan shape: pushdown, pruning, no cartesian products, one scan per rule set."""

import __spark_entry__ as E
from ledgerline.operators import cdc as cdc_ops
from ledgerline.operators import history as h
from ledgerline.sources import standins

SF = "/root/testdata/sf0.001"


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_state_pushes_its_day_into_scan(spark):
    plan = _plan(h.account_state(E._signed(E._events(spark, SF)), "2024-01-09"))
    assert "PushedFilters: [Or(IsNull(ts),LessThan(ts,2024-01-10T00:00))" in plan


def test_history_has_no_cartesian_product(spark):
    for mode in ("zero", "carry"):
        plan = _plan(h.wallet_history(E._signed(E._events(spark, SF)), "2024-01-03", "2024-01-09", quiet_days=mode))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_history_reads_only_needed_columns(spark):
    plan = _plan(E.q_wallet_history(spark, SF))
    assert "props" not in plan     # events.props is never read


def test_quality_rules_are_one_scan(spark):
    df = cdc_ops.quality_report(standins.dirty_cdc(E._cdc(E._events(spark, SF))))
    plan = _plan(df)
    assert plan.count("FileScan parquet") == 1
    assert plan.count("Exchange") <= 1


def test_top_k_is_take_ordered(spark):
    plan = E.q_payments_detail(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_history_grid_is_never_shuffled(spark):
    """Pairs meet intervals in a join; the days are generated above every
    exchange, sort and window."""
    for mode in ("zero", "carry"):
        plan = _plan(h.wallet_history(E._signed(E._events(spark, SF)), "2024-01-03", "2024-01-09",
                                      quiet_days=mode))
        top = plan.split("Generate explode(sequence")[0]
        assert not any(x in top for x in ("Exchange", "Window", "Sort "))
        assert "CartesianProduct" not in plan


def test_reports_start_no_job_when_built(spark):
    import datetime as dt
    from ledgerline.plans import jobs
    pay = E._Run(spark, SF).payments()
    audit = E._Run(spark, SF).audit()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("reports-built", "no job expected")
    try:
        made = jobs.reports(pay, audit, "2024-01-03", dt.date(2024, 1, 9).isoformat())
        assert len(tracker.getJobIdsForGroup("reports-built")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "RangePartitioning" not in made["balance_interest_trend"]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in made["balance_interest_trend"]._jdf.queryExecution().executedPlan().toString()


def test_queries_without_a_window_look_for_no_span(spark, monkeypatch):
    monkeypatch.setattr(E.files, "data_window", lambda sg: 1 / 0)
    for key in ("signed_amounts", "running_balance", "daily_rollup", "previous_balance", "rates_normalized"):
        E.QUERIES[key](spark, SF)


def test_running_balance_is_one_scan_and_one_exchange_of_the_events(spark):
    """Both sides of the join read the same dealt events."""
    df = E.q_running_balance(spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 1 and plan.count("ReusedExchange") == 1
