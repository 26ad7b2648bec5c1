"""Declared schemas of the tables the engine reads and writes."""

from pyspark.sql import types as T

# Change events. Amounts are exact decimals; an integer column is accepted too.
CDC = T.StructType([
    T.StructField("account_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("transaction_type", T.StringType(), True),
    T.StructField("amount", T.DecimalType(18, 2), True),
    T.StructField("event_time", T.TimestampType(), True),
])

# Dense daily history, one row per account, user and calendar day.
WALLET_HISTORY = T.StructType([
    T.StructField("account_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("balance", T.DoubleType(), True),
    T.StructField("balance_previous", T.DoubleType(), True),
    T.StructField("immovable_balance", T.DoubleType(), True),
    T.StructField("last_movement_ts", T.TimestampNTZType(), True),
    T.StructField("total_deposits", T.DoubleType(), True),
    T.StructField("total_withdrawals", T.DoubleType(), True),
    T.StructField("transactions_count", T.LongType(), True),
    T.StructField("partition_date", T.DateType(), True),
])

# Raw rate feed rows: day-first date text and a percent as text.
RATES_RAW = T.StructType([
    T.StructField("data", T.StringType(), True),
    T.StructField("valor", T.StringType(), True),
])

# Stored rates. The partition column is pinned to string so that Spark does
# not infer it; readers turn it into a DATE after partition pruning.
RATES_STORED = T.StructType([
    T.StructField("cdi_rate", T.DoubleType(), True),
    T.StructField("partition_date", T.StringType(), True),
])

RATES = T.StructType([
    T.StructField("partition_date", T.DateType(), True),
    T.StructField("cdi_rate", T.DoubleType(), True),
])

INTEREST_PAYMENTS = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("account_id", T.StringType(), True),
    T.StructField("eligible_balance", T.DoubleType(), True),
    T.StructField("interest_rate", T.DoubleType(), True),
    T.StructField("interest_amount", T.DoubleType(), True),
    T.StructField("is_paid", T.BooleanType(), True),
    T.StructField("payment_date", T.StringType(), True),
    T.StructField("partition_date", T.DateType(), True),
])

AUDIT_LOG = T.StructType([
    T.StructField("job_id", T.StringType(), False),
    T.StructField("job_timestamp", T.TimestampNTZType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("account_id", T.StringType(), False),
    T.StructField("qualified", T.BooleanType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("relevant_balance", T.DoubleType(), True),
    T.StructField("calculated_interest", T.DoubleType(), True),
    T.StructField("interest_rate", T.DoubleType(), True),
    T.StructField("process_status", T.StringType(), False),
    T.StructField("error_description", T.StringType(), True),
    T.StructField("partition_date", T.DateType(), False),
])
