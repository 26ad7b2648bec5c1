"""Column expressions for amounts, balances and interest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from ledgerline import constants as K


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def signed_amount(amount: Column | str = "amount",
                  transaction_type: Column | str = "transaction_type") -> Column:
    """The sign comes from the type, never from the stored amount.

    Outflow types book ``-abs(amount)``; everything else, unknown and NULL
    types included, books ``+abs(amount)``.
    """
    a = _c(amount)
    return F.when(_c(transaction_type).isin(*K.OUTFLOW_TYPES), -F.abs(a)).otherwise(F.abs(a))


def event_timestamp(event_time: Column | str, data_type: T.DataType) -> Column:
    """Timestamps pass through unchanged (NTZ stays NTZ); text is parsed,
    and unparseable text becomes NULL instead of failing the job."""
    c = _c(event_time)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(data_type, T.DateType):
        return c.cast("timestamp")
    return F.try_to_timestamp(c.cast("string"))


def summable(amount: Column | str, data_type: T.DataType) -> tuple[Column, bool]:
    """Money ready to be summed, and whether sums of it are exact: decimals
    and integers widened to DECIMAL(38, scale), so a sum has all the digits
    there are; floating point stays double."""
    a = _c(amount)
    if isinstance(data_type, T.DecimalType):
        return a.cast(T.DecimalType(38, data_type.scale)), True
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return a.cast(T.DecimalType(38, 0)), True
    return a.cast("double"), False


def money_sum(col: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum that is NULL only when there is nothing to sum: a sum beyond 38
    digits fails the job in every ANSI mode instead of turning NULL."""
    total, n = F.sum(_c(col)), F.count(_c(col))
    if over is not None:
        total, n = total.over(over), n.over(over)
    return F.coalesce(total, F.when(n > 0, F.raise_error(F.lit("a money sum exceeds 38 digits"))))


# Grids of ``order_free_sum``: doubles are split into multiples of 2^-20 and of 2^-60.
COARSE_BITS, FINE_BITS = 20, 40


def order_free_sum(value: Column | str, over: WindowSpec | None = None) -> Column:
    """Sum of doubles that is the same bit for bit in whatever order and
    partitions the rows come: each value is split into whole multiples of
    2^-20 and, of the rest, of 2^-60 (what is below goes); both are summed
    exactly as decimals and put together once. NULLs are skipped, the sum of
    none is NULL; values of 1e31 and more, infinite or NaN, fail the cast."""
    v = _c(value).cast("double")
    coarse = F.rint(v * F.lit(2.0 ** COARSE_BITS))
    fine = F.rint((v * F.lit(2.0 ** COARSE_BITS) - coarse) * F.lit(2.0 ** FINE_BITS))

    def total(x: Column, digits: int) -> Column:
        s = F.sum(x.cast(T.DecimalType(digits, 0)))
        return (s if over is None else s.over(over)).cast("double")

    return (total(coarse, 38) * F.lit(2.0 ** -COARSE_BITS)
            + total(fine, 20) * F.lit(2.0 ** -(COARSE_BITS + FINE_BITS)))


def order_free_avg(value: Column | str, over: WindowSpec | None = None) -> Column:
    """``order_free_sum`` by the number of values; NULL for none."""
    n = F.count(_c(value))
    return F.try_divide(order_free_sum(value, over), (n if over is None else n.over(over)).cast("double"))


def immovable(previous: Column | str, withdrawals: Column | str,
              deposits: Column | str, netting: str = "observed") -> Column:
    """Part of yesterday's balance that today's movement did not touch.

    ``observed``: ``greatest`` skips NULLs, so a day with withdrawals but no
    deposits (or the reverse) is not netted and the full previous balance
    stays immovable. ``full``: a missing side counts as 0, so every
    withdrawal is netted against the day's deposits.
    """
    prev, wd, dep = _c(previous), _c(withdrawals), _c(deposits)
    zero = F.lit(0)
    if netting == "full":
        wd, dep = F.coalesce(wd, zero), F.coalesce(dep, zero)
    elif netting != "observed":
        raise ValueError(f"netting must be 'observed' or 'full', not {netting!r}")
    return F.greatest(prev - F.greatest(F.abs(wd) - dep, zero), zero)


def daily_interest(balance: Column | str, annual_rate: Column | str,
                   decimals: int = K.DEFAULT_DECIMALS) -> Column:
    """``round(balance * (annual_rate / 365), decimals)``, HALF_UP on double."""
    return F.round(_c(balance) * (_c(annual_rate) / F.lit(K.DAYS_PER_YEAR)), decimals)


def first_non_empty(col: Column | str, default: str) -> Column:
    """``value or default`` for text: NULL and '' both take the default."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(default))
