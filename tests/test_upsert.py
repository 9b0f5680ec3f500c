from __future__ import annotations

from decimal import Decimal

import frames
from frames import account
from sediment.operators.rules import check_accounts
from sediment.operators.upsert import retained, upsert_accounts
from sediment.plans import silver


def promoted(spark, rows):
    return silver.promote_accounts(check_accounts(frames.accounts(spark, rows)), "r1")


def balances(df):
    return {r["account_id"]: r["current_balance"] for r in df.collect()}


def test_latest_day_wins(spark):
    rows = [
        account(1, "A", file_day=1, balance="1"),
        account(2, "A", file_day=3, balance="3"),
        account(3, "A", file_day=2, balance="2"),
        account(4, "B", file_day=1, balance="9"),
        account(5, "B", file_day=4, status="PENDING", balance="0"),
    ]
    assert balances(upsert_accounts(promoted(spark, rows))) == {"A": Decimal(3), "B": Decimal(9)}


def test_upsert_on_stored_accounts(spark):
    stored = upsert_accounts(
        promoted(spark, [account(1, "A", file_day=5, balance="5"), account(2, "B", balance="1")])
    )
    new = promoted(
        spark,
        [
            account(1, "B", file_day=6, balance="6"),
            account(2, "C", file_day=6, balance="7"),
            # An older day filled in late must not bring back its balance.
            account(3, "A", file_day=2, balance="2"),
        ],
    )
    merged = upsert_accounts(new, stored)
    assert merged.columns == stored.columns
    assert balances(merged) == {"A": Decimal(5), "B": Decimal(6), "C": Decimal(7)}
    assert balances(retained(stored, new)) == {}
    assert balances(retained(stored, new.where("account_id <> 'A'"))) == {"A": Decimal(5)}
