"""Every registered query against its DuckDB twin on the smallest supplied tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import TABLES, _norm

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    got = sdf.toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["user_id", "account_id", "eligible_balance", "interest_rate",
                          "interest_amount", "is_paid", "payment_date", "partition_date"]
    assert df.count() > 0


def test_registered_outputs_carry_days_as_text(spark):
    for key in ("wallet_history", "account_state", "interest_audit"):
        types = dict(E.queries()[key](spark, SF).dtypes)
        assert "date" not in types.values()
