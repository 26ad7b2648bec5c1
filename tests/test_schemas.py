"""Outputs carry the declared schemas (names, order and types)."""

import datetime as dt

import __spark_entry__ as E
from ledgerline import schemas
from ledgerline.operators import history as h
from ledgerline.operators import interest as i

SF = "/root/testdata/sf0.001"


def _shape(st):
    return [(f.name, f.dataType.simpleString()) for f in st.fields]


def test_history_schema(spark):
    r = E._Run(spark, SF)
    for mode in ("zero", "carry"):
        out = r.history(quiet_days=mode)
        assert _shape(out.schema) == _shape(schemas.WALLET_HISTORY)
        assert tuple(out.columns) == h.HISTORY_COLUMNS


def test_payment_and_audit_schemas(spark):
    d = E._Run(spark, SF).decision()
    assert _shape(i.payments(d).schema) == _shape(schemas.INTEREST_PAYMENTS)
    assert _shape(i.audit(d, "j", dt.datetime(2024, 1, 1)).schema) == _shape(schemas.AUDIT_LOG)


def test_rates_schema(spark):
    assert _shape(E._Run(spark, SF).rates().schema) == _shape(schemas.RATES)


def test_state_schema(spark):
    r = E._Run(spark, SF)
    assert tuple(h.account_state(r.signed(), r.end).columns) == h.STATE_COLUMNS


def test_declared_cdc_schema_reads_and_signs(spark, tmp_path):
    from ledgerline.operators import cdc as ops
    from ledgerline.sources import files
    path = str(tmp_path / "cdc")
    E._cdc(E._events(spark, SF)).drop("event_id").write.parquet(path)
    df = files.read_cdc(spark, path, schemas.CDC)
    assert ops.validate(df)[0]
    assert ops.signed(df).count() == df.count()
