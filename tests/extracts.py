"""A week of extracts, written out for a test."""


from __future__ import annotations

from decimal import Decimal
from pathlib import Path

TX_HEADER = "transaction_id,account_id,transaction_date,amount,transaction_code,merchant_name,channel"
ACCOUNT_HEADER = (
    "account_id,customer_name,account_status,credit_limit,current_balance,open_date,"
    "billing_cycle_start,billing_cycle_end"
)
# The four codes. The order in the file is not the order of the stored columns.
CODES = """transaction_code,description,debit_credit_indicator,transaction_type,affects_balance
PURCH01,Purchase,DR,PURCHASE,true
PAY01,Payment,CR,PAYMENT,true
FEE01,Annual Fee,DR,FEE,true
INT01,Interest Charge,DR,INTEREST,true
"""

# Per day: account, amount, code, merchant as written, channel. Ids are numbered in order.
WEEK = {
    "2024-01-01": [
        ("K-10", "12.40", "PURCH01", '"Corner, Shop"', "ONLINE"),
        ("K-11", "310.05", "PURCH01", "Tea House", "IN_STORE"),
        ("K-99", "8.88", "PURCH01", '"The ""Quick"" Bite"', "ONLINE"),
        ("K-10", "40.00", "PAY01", "", "KIOSK"),
    ],
    "2024-01-02": [
        ("K-12", "77.70", "PAY01", "", "ONLINE"),
        ("K-12", "5.5", "FEE01", "", "IN_STORE"),
        ("K-11", "0", "PURCH01", "Tea House", "ONLINE"),
        ("K-10", "19.99", "PURCH01", "Book \\ Nook", "IN_STORE"),
        ("K-99", "3.10", "INT01", "", "ONLINE"),
        ("K-10", "60.01", "PURCH01", "Florist", "ONLINE"),
    ],
    "2024-01-03": [
        ("K-11", "250", "PAY01", "", "ONLINE"),
        ("K-12", "33.33", "PURCH01", "Bakery", "IN_STORE"),
        ("K-10", "1.25", "INT01", "", "ONLINE"),
        ("K-11", "9.75", "GIFT9", "Bakery", "ONLINE"),
    ],
    "2024-01-04": [
        ("K-12", "14.95", "PURCH01", "Cinema", "ONLINE"),
        ("K-12", "14.95", "PURCH01", "Cinema", "ONLINE"),
        ("K-99", "120.00", "PAY01", "", "IN_STORE"),
    ],
    "2024-01-05": [
        ("K-10", "500.5", "PAY01", "", "IN_STORE"),
        ("K-11", "2.02", "FEE01", "", "ONLINE"),
        ("", "4.00", "PURCH01", "Newsagent", "ONLINE"),
        ("K-12", "81.19", "PURCH01", '"Hats\nand more"', "IN_STORE"),
    ],
    "2024-01-06": [
        ("K-11", "64.00", "PURCH01", "Garage", "IN_STORE"),
        ("K-10", "7.07", "PURCH01", "Newsagent", "ONLINE"),
        ("K-99", "15.15", "PURCH01", "Garage", "IN_STORE"),
        ("K-12", "11.00", "INT01", "", "FAX"),
    ],
    "2024-01-07": [
        ("K-11", "18.80", "PURCH01", "Tea House", "ONLINE"),
        ("K-12", "260.00", "PAY01", "", "ONLINE"),
        ("K-10", "45.45", "PURCH01", "Florist", "IN_STORE"),
        ("K-10", "45.45", "PURCH01", "Florist", "DOOR"),
    ],
}
BALANCES = {
    "K-10": [410, 395, 501, 388, 142, 260, 331],
    "K-11": [95, 105, 77, 210, 64, 128, 12],
    "K-12": [None, 1010, 990, 1203, 940, 955, 870],
}
KINDS = {"PURCH01": "purchases", "PAY01": "payments", "FEE01": "fees", "INT01": "interest"}


def reason(row: tuple) -> str | None:
    """Why a row of the week is rejected, worked out one row at a time."""
    account, amount, code, _, channel = row
    if not account:
        return "NULL_REQUIRED_FIELD"
    if Decimal(amount) <= 0:
        return "INVALID_AMOUNT"
    if code not in KINDS:
        return "INVALID_TRANSACTION_CODE"
    return None if channel in ("ONLINE", "IN_STORE") else "INVALID_CHANNEL"


def promoted(day: str) -> list[tuple[str, Decimal, str, str, bool]]:
    """Account, signed amount, code, channel and account flag of a day's good rows."""
    known = [a for a, b in BALANCES.items() if any(x is not None for x in b[: int(day[-2:])])]
    return [
        (account, Decimal(amount) * (-1 if code == "PAY01" else 1), code, channel, account in known)
        for account, amount, code, _, channel in [r for r in WEEK[day] if reason(r) is None]
    ]


def transaction_lines(day: str) -> list[str]:
    return [
        f"P-{day[-2:]}-{n},{account},{day},{amount},{code},{merchant},{channel}"
        for n, (account, amount, code, merchant, channel) in enumerate(WEEK[day], start=1)
    ]


def account_line(account: str, balance, status: str = "ACTIVE", name: str = "Someone") -> str:
    return f"{account},{name},{status},2500.00,{balance}.00,2021-06-30,2024-01-01,2024-01-31"


def account_lines(day: str) -> list[str]:
    index = int(day[-2:]) - 1
    return [account_line(a, b[index]) for a, b in BALANCES.items() if b[index] is not None]


def write_transactions(folder: Path, day: str, lines: list[str]) -> None:
    (folder / f"transactions_{day}.csv").write_text("\n".join([TX_HEADER, *lines]) + "\n")


def write_accounts(folder: Path, day: str, lines: list[str]) -> None:
    (folder / f"accounts_{day}.csv").write_text("\n".join([ACCOUNT_HEADER, *lines]) + "\n")


def write_week(folder: Path, days: list[str] | None = None) -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "transaction_codes.csv").write_text(CODES)
    for day in days or WEEK:
        write_transactions(folder, day, transaction_lines(day))
        write_accounts(folder, day, account_lines(day))
    return folder
