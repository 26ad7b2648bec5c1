"""Small builders for hand-made inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

CDC_SCHEMA = T.StructType([
    T.StructField("account_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("transaction_type", T.StringType(), True),
    T.StructField("amount", T.DecimalType(18, 2), True),
    T.StructField("event_time", T.TimestampNTZType(), True),
    T.StructField("event_id", T.LongType(), True),
])


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def cdc(spark, rows):
    """rows: (account, user, type, amount, 'YYYY-MM-DD HH:MM[:SS]')"""
    data = [(a, u, t, None if m is None else Decimal(str(m)), None if e is None else ts(e), i)
            for i, (a, u, t, m, e) in enumerate(rows)]
    return spark.createDataFrame(data, CDC_SCHEMA)


def by_day(df, *cols):
    """{(account, user, 'YYYY-MM-DD'): {col: value}}"""
    out = {}
    for r in df.collect():
        key = (r["account_id"], r["user_id"], r["partition_date"].isoformat())
        out[key] = {c: r[c] for c in cols}
    return out
