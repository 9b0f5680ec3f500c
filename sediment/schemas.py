"""Entity schemas and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 4)
TOTAL = T.DecimalType(38, 4)

# The domains below must match the extracts exactly.
CHANNELS = ["ONLINE", "IN_STORE"]
ACCOUNT_STATUSES = ["ACTIVE", "SUSPENDED", "CLOSED"]
RUN_STATUSES = ["SUCCESS", "FAILED", "SKIPPED"]
REASONS = [
    "NULL_REQUIRED_FIELD",
    "INVALID_AMOUNT",
    "INVALID_TRANSACTION_CODE",
    "INVALID_CHANNEL",
    "DUPLICATE_TRANSACTION_ID",
    "INVALID_TRANSACTION_DATE",
    "INVALID_ACCOUNT_STATUS",
]
# Daily mart column prefix -> transaction code it reports on.
DAILY_CODES = {
    "purchases": "PURCH01",
    "payments": "PAY01",
    "fees": "FEE01",
    "interest": "INT01",
    "refunds": "REF01",
}


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_STRING, _DATE, _BOOL, _LONG = T.StringType(), T.DateType(), T.BooleanType(), T.LongType()
_UTC_NAIVE, _INSTANT = T.TimestampNTZType(), T.TimestampType()

# Position of a row in its source file: byte offset of the file split, then line in the split.
ROW_ORDINAL = _struct(block=_LONG, line=_LONG)

TRANSACTION_SOURCE = _struct(
    transaction_id=_STRING,
    account_id=_STRING,
    transaction_date=_DATE,
    amount=MONEY,
    transaction_code=_STRING,
    merchant_name=_STRING,
    channel=_STRING,
)
# The extract also carries customer_name; it is personal data and never leaves the file.
ACCOUNT_SOURCE = _struct(
    account_id=_STRING,
    open_date=_DATE,
    credit_limit=MONEY,
    current_balance=MONEY,
    billing_cycle_start=_DATE,
    billing_cycle_end=_DATE,
    account_status=_STRING,
)
CODE_SOURCE = _struct(
    transaction_code=_STRING,
    transaction_type=_STRING,
    description=_STRING,
    debit_credit_indicator=_STRING,
    affects_balance=_BOOL,
)

_BRONZE_AUDIT = _struct(
    _source_file=_STRING,
    _ingested_at=_UTC_NAIVE,
    _pipeline_run_id=_STRING,
    _row_ordinal=ROW_ORDINAL,
)
_QUARANTINE_AUDIT = _struct(
    _source_file=_STRING,
    _pipeline_run_id=_STRING,
    _rejected_at=_INSTANT,
    _rejection_reason=_STRING,
)
_PARTITION = _struct(date=_DATE)


def _join(*parts: T.StructType) -> T.StructType:
    return T.StructType([field for part in parts for field in part.fields])


BRONZE_TRANSACTIONS = _join(TRANSACTION_SOURCE, _BRONZE_AUDIT, _PARTITION)
BRONZE_ACCOUNTS = _join(ACCOUNT_SOURCE, _BRONZE_AUDIT, _PARTITION)
BRONZE_CODES = _join(CODE_SOURCE, _BRONZE_AUDIT)

SILVER_CODES = _join(
    CODE_SOURCE,
    _struct(_source_file=_STRING, _bronze_ingested_at=_UTC_NAIVE, _pipeline_run_id=_STRING),
)
SILVER_ACCOUNTS = _join(
    ACCOUNT_SOURCE,
    _struct(
        _source_file=_STRING,
        _bronze_ingested_at=_UTC_NAIVE,
        _pipeline_run_id=_STRING,
        _record_valid_from=_INSTANT,
    ),
)
SILVER_TRANSACTIONS = _struct(
    transaction_id=_STRING,
    account_id=_STRING,
    transaction_date=_DATE,
    amount=MONEY,
    _signed_amount=MONEY,
    transaction_code=_STRING,
    merchant_name=_STRING,
    channel=_STRING,
    debit_credit_indicator=_STRING,
    _source_file=_STRING,
    _bronze_ingested_at=_UTC_NAIVE,
    _pipeline_run_id=_STRING,
    _promoted_at=_INSTANT,
    _is_resolvable=_BOOL,
    date=_DATE,
)
# A reject keeps its position in the file, so that it can be traced to its raw row.
_POSITION = _struct(_row_ordinal=ROW_ORDINAL)
QUARANTINE_TRANSACTIONS = _join(TRANSACTION_SOURCE, _QUARANTINE_AUDIT, _POSITION, _PARTITION)
QUARANTINE_ACCOUNTS = _join(ACCOUNT_SOURCE, _QUARANTINE_AUDIT, _POSITION, _PARTITION)

GOLD_DAILY = _struct(
    transaction_date=_DATE,
    total_transactions=_LONG,
    total_signed_amount=TOTAL,
    online_transactions=_LONG,
    instore_transactions=_LONG,
    **{
        f"{name}_{kind}": (_LONG if kind == "count" else TOTAL)
        for name in DAILY_CODES
        for kind in ("count", "amount")
    },
    _computed_at=_INSTANT,
    _pipeline_run_id=_STRING,
    _source_period_start=_DATE,
    _source_period_end=_DATE,
)
GOLD_WEEKLY = _struct(
    account_id=_STRING,
    week_start_date=_DATE,
    week_end_date=_DATE,
    total_purchases=_LONG,
    avg_purchase_amount=T.DoubleType(),
    total_payments=TOTAL,
    total_fees=TOTAL,
    total_interest=TOTAL,
    closing_balance=MONEY,
    _computed_at=_INSTANT,
    _pipeline_run_id=_STRING,
)

CONTROL = _struct(
    last_processed_date=_DATE, updated_at=_UTC_NAIVE, updated_by_run_id=_STRING
)
# The columns of the control table and of the run log.
RUN_LOG = T.StructType(
    [
        T.StructField("run_id", _STRING, False),
        T.StructField("pipeline_type", _STRING, False),
        T.StructField("model_name", _STRING, False),
        T.StructField("layer", _STRING, False),
        T.StructField("started_at", _INSTANT, False),
        T.StructField("completed_at", _INSTANT, False),
        T.StructField("status", _STRING, False),
        T.StructField("records_processed", _LONG, True),
        T.StructField("records_written", _LONG, True),
        T.StructField("records_rejected", _LONG, True),
        T.StructField("error_message", _STRING, True),
        # Lets "is this date done?" be asked of the log itself.
        T.StructField("process_date", _DATE, True),
    ]
)
