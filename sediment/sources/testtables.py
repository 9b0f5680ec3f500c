"""The given tables seen as the lake's source entities.

The tables hold no card data and no faults, so both are derived from their columns: every event
becomes a transaction and every customer sends account deltas. All rows of both tables are used.
Faults depend on the key alone, so the same rules can be written in any SQL dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sediment.schemas import (
    BRONZE_ACCOUNTS,
    BRONZE_CODES,
    BRONZE_TRANSACTIONS,
    CODE_SOURCE,
)

RUN_ID = "run-0001"

# The code table of the card extracts.
CODES = [
    ("PURCH01", "PURCHASE", "Purchase", "DR", True),
    ("PAY01", "PAYMENT", "Payment", "CR", True),
    ("FEE01", "FEE", "Annual Fee", "DR", True),
    ("INT01", "INTEREST", "Interest Charge", "DR", True),
]
EVENT_CODES = {"purchase": "PURCH01", "click": "PAY01", "view": "FEE01", "signup": "INT01"}

# Every event is delivered once; some again. (copy number, one event in how many gets this copy,
# day shift of the file it arrives in, shift of its transaction date).
COPIES = [(0, 1, 0, 0), (1, 7, 0, 0), (2, 5, 1, 0), (3, 11, 1, 1), (4, 13, -1, -1)]
DELTAS = [0, 1, 2]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _audited(rows: DataFrame, entity: str, names: list[str]) -> DataFrame:
    return rows.selectExpr(
        "*",
        f"concat('{entity}_', date, '.csv') AS _source_file",
        "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS _ingested_at",
        f"'{RUN_ID}' AS _pipeline_run_id",
    ).select(*names)


def bronze_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = ", ".join(f"struct({c}L, {every}, {file}, {day})" for c, every, file, day in COPIES)
    codes = " ".join(f"WHEN '{name}' THEN '{code}'" for name, code in EVENT_CODES.items())
    shaped = (
        table(spark, sf_dir, "events")
        .selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k", "CAST(ts AS DATE) AS day")
        .selectExpr("*", f"inline(array({copies})) AS (copy, every, file_shift, date_shift)")
        .where("event_id % every = 0")
        .selectExpr(
            "CASE WHEN event_id % 101 <> 0 THEN concat('TXN-', event_id) END AS transaction_id",
            "concat('ACC-', user_id) AS account_id",
            "date_add(day, date_shift - IF(event_id % 113 = 0, 1, 0)) AS transaction_date",
            "CAST(IF(event_id % 103 = 0, 0, value) AS DECIMAL(18,4)) AS amount",
            f"CASE event_type {codes} ELSE 'ERR99' END AS transaction_code",
            "CASE WHEN event_type = 'purchase' THEN concat('M-', k) END AS merchant_name",
            "CASE WHEN k = 50 THEN ' ' WHEN k = 51 THEN '\u00a0' WHEN k = 52 THEN '\n' "
            "WHEN k % 10 = 9 THEN 'DRIVE_THRU' WHEN k % 2 = 0 THEN 'ONLINE' ELSE 'IN_STORE' END AS channel",
            "named_struct('block', copy, 'line', event_id) AS _row_ordinal",
            "date_add(day, file_shift) AS date",
        )
    )
    return _audited(shaped, "transactions", BRONZE_TRANSACTIONS.fieldNames())


def bronze_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = (
        table(spark, sf_dir, "customer")
        .selectExpr("*", f"explode(array({', '.join(map(str, DELTAS))})) AS n")
        .selectExpr(
            "CASE WHEN NOT (c_custkey % 97 = 0 AND n = 1) "
            "THEN concat('ACC-', c_custkey) END AS account_id",
            "date_add(DATE '2020-01-01', CAST(c_custkey % 1000 AS INT)) AS open_date",
            "CAST(1000 + (c_custkey % 50) * 100 AS DECIMAL(18,4)) AS credit_limit",
            "CAST(CAST(c_acctbal AS DECIMAL(18,4)) + n * 10 AS DECIMAL(18,4)) AS current_balance",
            "DATE '2024-01-01' AS billing_cycle_start",
            "DATE '2024-01-31' AS billing_cycle_end",
            "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'SUSPENDED' "
            "WHEN c_mktsegment = 'FURNITURE' THEN 'PENDING' "
            "WHEN c_mktsegment = 'HOUSEHOLD' AND n = 0 THEN NULL "
            "WHEN c_mktsegment = 'HOUSEHOLD' THEN 'CLOSED' ELSE 'ACTIVE' END AS account_status",
            "named_struct('block', 0L, 'line', c_custkey) AS _row_ordinal",
            "date_add(DATE '2024-01-01', CAST(c_custkey % 20 + n * 4 AS INT)) AS date",
        )
    )
    return _audited(shaped, "accounts", BRONZE_ACCOUNTS.fieldNames())


def reference_codes(spark: SparkSession) -> DataFrame:
    """The code table as a local relation, so the optimizer knows its size."""
    rows = ", ".join(str(row) for row in CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS codes({', '.join(CODE_SOURCE.names)})")


def bronze_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes that occur in the events, with their reference attributes."""
    codes = " ".join(f"WHEN '{name}' THEN '{code}'" for name, code in EVENT_CODES.items())
    seen = (
        table(spark, sf_dir, "events")
        .selectExpr(f"CASE event_type {codes} END AS transaction_code")
        .distinct()
    )
    return (
        seen.join(reference_codes(spark), "transaction_code")
        .selectExpr(
            "*",
            "'transaction_codes.csv' AS _source_file",
            "TIMESTAMP_NTZ '2024-02-01 00:00:00' AS _ingested_at",
            f"'{RUN_ID}' AS _pipeline_run_id",
            "named_struct('block', 0L, 'line', 0L) AS _row_ordinal",
        )
        .select(*BRONZE_CODES.fieldNames())
    )
