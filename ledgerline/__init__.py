"""ledgerline: daily balances, interest and audit on Spark.

Pure ``DataFrame -> DataFrame`` functions over change events, rates and the
tables derived from them; the caller owns the SparkSession.
"""

from ledgerline.operators.cdc import quality_report, require_valid, running_balance, signed, validate
from ledgerline.operators.history import (
    account_state, advance_state, calendar_accounts, daily_rollup, daily_transaction_counts,
    history_with_state, wallet_history, with_balances, with_immovable,
)
from ledgerline.operators.interest import audit, decide, payments, with_audit_defaults
from ledgerline.operators.rates import in_range, normalize

__version__ = "0.1.0"

__all__ = [
    "signed", "quality_report", "validate", "require_valid", "running_balance",
    "daily_rollup", "daily_transaction_counts", "with_balances", "with_immovable",
    "calendar_accounts", "wallet_history", "history_with_state", "account_state",
    "advance_state", "normalize", "in_range", "decide", "payments", "audit",
    "with_audit_defaults",
]
