"""Small raw-layer frames for tests."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from sediment.schemas import BRONZE_ACCOUNTS, BRONZE_TRANSACTIONS, CODE_SOURCE

LOADED = datetime(2024, 2, 1)
CODES = [
    ("PURCH01", "PURCHASE", "Purchase", "DR", True),
    ("PAY01", "PAYMENT", "Payment", "CR", True),
    ("FEE01", "FEE", "Annual Fee", "DR", True),
    ("INT01", "INTEREST", "Interest Charge", "DR", True),
]


def day(n: int) -> date:
    return date(2024, 1, n)


def codes(spark, extra=()):
    return spark.createDataFrame([*CODES, *extra], CODE_SOURCE)


def tx(
    line,
    id="T1",
    file_day=1,
    tx_day=None,
    account="ACC-001",
    amount="10.00",
    code="PURCH01",
    channel="ONLINE",
    merchant=None,
):
    when = None if tx_day == 0 else day(tx_day or file_day)
    value = None if amount is None else Decimal(amount)
    return (
        id, account, when, value, code, merchant, channel,
        f"transactions_{day(file_day)}.csv", LOADED, "run", (0, line), day(file_day),
    )


def transactions(spark, rows):
    return spark.createDataFrame(rows, BRONZE_TRANSACTIONS)


def account(line, id="ACC-001", file_day=1, status="ACTIVE", balance="100.00", opened=day(1)):
    value = None if balance is None else Decimal(balance)
    return (
        id, opened, Decimal("5000"), value, day(1), day(31), status,
        f"accounts_{day(file_day)}.csv", LOADED, "run", (0, line), day(file_day),
    )


def accounts(spark, rows):
    return spark.createDataFrame(rows, BRONZE_ACCOUNTS)
