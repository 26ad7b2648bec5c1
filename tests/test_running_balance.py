"""Statement-line running balance against a brute-force sort, with a hot account."""

import random
import re

import pytest

from ledgerline.operators import cdc as ops
from tests.helpers import cdc


def _fixture(spark):
    random.seed(7)
    rows = []
    for i in range(3000):
        acct = "hot" if i % 3 == 0 else f"a{i % 17}"
        kind = random.choice(["DEPOSIT", "WITHDRAWAL", "TRANSFER_IN", "TRANSFER_OUT", "WALLET_CREATED"])
        amount = 0 if kind == "WALLET_CREATED" else random.randint(1, 500)
        day = 1 + random.randint(0, 3)
        minute = random.randint(0, 5)  # many ties in time, broken by event_id
        rows.append((acct, "u", kind, amount, f"2024-01-0{day} 10:0{minute}"))
    return cdc(spark, rows)


def _expected(rows):
    acc = {}
    out = {}
    for r in sorted(rows, key=lambda r: (r["account_id"], r["event_time"], r["event_id"])):
        n = float(r["amount"]) * (-1 if r["transaction_type"] in ("WITHDRAWAL", "TRANSFER_OUT") else 1)
        acc[r["account_id"]] = acc.get(r["account_id"], 0.0) + n
        out[r["event_id"]] = round(acc[r["account_id"]], 2)
    return out


@pytest.mark.parametrize("bucket", ["minute", "hour", "day"])
def test_matches_brute_force(spark, bucket):
    df = _fixture(spark)
    got = {r["event_id"]: float(r["running_balance"])
           for r in ops.running_balance(ops.signed(df), tie="event_id", bucket=bucket).collect()}
    assert got == _expected(df.collect())


def test_keeps_every_row_and_column(spark):
    df = _fixture(spark)
    out = ops.running_balance(ops.signed(df), tie="event_id")
    assert out.count() == df.count()
    assert set(ops.signed(df).columns) | {"running_balance"} == set(out.columns)


def test_no_task_holds_a_whole_account(spark):
    """The event-level window is partitioned by account and bucket."""
    out = ops.running_balance(ops.signed(_fixture(spark)), tie="event_id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in plan.splitlines() if " Window [" in ln and "sum(_money" in ln and "event_ts" in ln]
    assert windows and all(w.split("], [")[1].startswith("_key#") for w in windows)
    assert re.search(r"struct\(account, account_id#\d+, bucket, date_trunc\(minute", plan)


def test_rejects_unknown_tie_or_unit(spark):
    sg = ops.signed(_fixture(spark))
    with pytest.raises(ValueError):
        ops.running_balance(sg, tie="nope")
    with pytest.raises(ValueError):
        ops.running_balance(sg, tie="event_id", bucket="week")


def test_events_without_account_or_time_keep_their_rows(spark):
    rows = [("w1", "u", "DEPOSIT", 10, "2024-03-01 10:00"), ("w1", "u", "DEPOSIT", 5, None),
            (None, "u", "DEPOSIT", 3, "2024-03-01 11:00"), (None, "u", "WITHDRAWAL", 1, None)]
    out = ops.running_balance(ops.signed(cdc(spark, rows)), tie="event_id")
    assert {r["event_id"]: r["running_balance"] for r in out.collect()} == {0: 15.0, 1: 5.0, 2: 2.0, 3: -1.0}
