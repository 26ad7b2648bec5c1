"""Rate feed normalisation and dated rate selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import in_window


def normalize(raw: DataFrame) -> DataFrame:
    """``data`` (day-first date text) -> ``partition_date`` DATE, ``valor``
    (percent text) -> ``cdi_rate`` fraction. Rows whose date or number does
    not parse are dropped; under ANSI mode the ``try_`` forms keep that from
    failing the job."""
    day = F.try_to_date(F.col("data"), K.RATE_DATE_FORMAT)
    rate = F.col("valor").try_cast("double") / F.lit(K.RATE_PERCENT_DIVISOR)
    out = raw.select(day.alias("partition_date"), rate.alias("cdi_rate"))
    return out.filter(F.col("partition_date").isNotNull() & F.col("cdi_rate").isNotNull())


def in_range(rates: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Rates of one day (``end`` None) or of an inclusive range."""
    return rates.filter(in_window("partition_date", start, end))
