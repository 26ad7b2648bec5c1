"""Fixed values.

Every value in this module must equal the behaviour the engine reproduces:
transaction type names, message texts, labels, formats and default
parameters. They are listed plainly, in the order the pipeline uses them.
"""

# --- Fixed values (must equal the reference's output) -----------------------

# Transaction types
WALLET_CREATED = "WALLET_CREATED"
DEPOSIT = "DEPOSIT"
TRANSFER_IN = "TRANSFER_IN"
WITHDRAWAL = "WITHDRAWAL"
TRANSFER_OUT = "TRANSFER_OUT"
# Types whose amount is booked with a negative sign; every other type,
# unknown or NULL ones included, is booked positive.
OUTFLOW_TYPES = (WITHDRAWAL, TRANSFER_OUT)
# Types that must never carry a negative amount.
INFLOW_TYPES = (DEPOSIT, TRANSFER_IN)

# Run window
MSG_INVALID_DATES = "❌ Fechas inválidas: {error}"
MSG_START_AFTER_END = "La fecha de inicio no puede ser posterior a la de fin"

# Data-quality rules
REQUIRED_FIELDS = ("account_id", "event_time", "amount")
CREATED_AMOUNT_TOLERANCE = 0.001
MSG_CREATED_WITH_AMOUNT = "⚠️ {count} cuentas creadas con monto distinto de cero"
MSG_NEGATIVE_INFLOW = "⚠️ {count} depósitos/transferencias con monto negativo"
MSG_MISSING_COLUMNS = "❌ Faltan columnas requeridas: {missing}"
MSG_NULL_REQUIRED = "⚠️ {count} registros con campos obligatorios nulos"

# Rate feed
RATE_DATE_FORMAT = "dd/MM/yyyy"
RATE_PERCENT_DIVISOR = 100

# Interest decision
DEFAULT_MIN_BALANCE = 100.0
DEFAULT_DECIMALS = 8
DAYS_PER_YEAR = 365
REASON_QUALIFIED = "Califica para interés"
REASON_BELOW_THRESHOLD = "Saldo inmovilizado menor a ${threshold}"
STATUS_SUCCESS = "success"
STATUS_ERROR = "error"

# Audit defaults for missing values
UNKNOWN_USER = "UNKNOWN_USER"
UNKNOWN_ACCOUNT = "UNKNOWN_ACCOUNT"
NO_REASON = "No reason provided"
UNKNOWN_STATUS = "unknown"

# Reports
DETAIL_MIN_BALANCE = 100
DETAIL_MIN_INTEREST = 10
DETAIL_LIMIT = 1000
HISTOGRAM_BINS = 20
SPLIT_QUALIFIED = "Calificadas"
SPLIT_NOT_QUALIFIED = "No Calificadas"

# Sinks
JDBC_BATCH_SIZE = 10000
MIN_JDBC_WRITERS = 8

# --- end of fixed values ----------------------------------------------------


def below_threshold_reason(min_balance: float) -> str:
    """Rejection label; the threshold is printed the way Python prints a float."""
    return REASON_BELOW_THRESHOLD.format(threshold=float(min_balance))
