"""Column expressions shared by the operators (all built-in Spark functions)."""

from ledgerline.functions.dates import calendar, date_lit, in_window, validate_dates
from ledgerline.functions.money import (
    daily_interest, event_timestamp, first_non_empty, immovable, money_sum, order_free_avg, order_free_sum, signed_amount, summable,
)

__all__ = [
    "calendar", "date_lit", "in_window", "validate_dates", "daily_interest", "event_timestamp",
    "first_non_empty", "immovable", "money_sum", "order_free_avg", "order_free_sum", "signed_amount", "summable",
]
