from __future__ import annotations

import pytest

import frames
from frames import tx
from sediment.operators.dedup import tag_transactions
from sediment.operators.lookup import known_accounts
from sediment.operators.rules import accepted, check_accounts, check_transactions
from sediment.plans import silver

NULL, AMOUNT = "NULL_REQUIRED_FIELD", "INVALID_AMOUNT"
CODE, CHANNEL = "INVALID_TRANSACTION_CODE", "INVALID_CHANNEL"
REPEAT, WRONG_DAY = "DUPLICATE_TRANSACTION_ID", "INVALID_TRANSACTION_DATE"

# (row, expected reason, expected account flag)
CASES = [
    (tx(1, "clean"), None, True),
    (tx(2, None), NULL, None),
    (tx(3, " "), NULL, None),
    (tx(4, "nbsp", channel="\u00a0"), NULL, None),
    (tx(5, "tab", channel="\t"), CHANNEL, None),
    (tx(6, "no-date", tx_day=0), NULL, None),
    (tx(7, "no-amount", amount=None), NULL, None),
    (tx(8, "no-account", account=""), NULL, None),
    (tx(9, "zero", amount="0"), AMOUNT, None),
    (tx(10, "negative", amount="-5.00"), AMOUNT, None),
    (tx(11, "bad-code", code="XXXXXX"), CODE, None),
    (tx(12, "bad-channel", channel="ATM"), CHANNEL, None),
    (tx(13, "case-matters", channel="online"), CHANNEL, None),
    (tx(14, "no-sign", code="ODD01"), AMOUNT, None),
    (tx(15, None, channel="ATM"), NULL, None),
    (tx(16, "zero-and-code", amount="0", code="XXXXXX"), AMOUNT, None),
    (tx(17, "code-and-channel", code="XXXXXX", channel="ATM"), CODE, None),
    (tx(20, "twice"), None, True),
    (tx(21, "twice"), REPEAT, None),
    (tx(22, "bad-then-good", channel="DRIVE_THRU"), CHANNEL, None),
    (tx(23, "bad-then-good"), None, True),
    (tx(24, "next-day"), None, True),
    (tx(25, "next-day", file_day=2), REPEAT, None),
    (tx(26, "wrong-day", tx_day=3), WRONG_DAY, None),
    (tx(27, "early"), None, True),
    (tx(28, "early", file_day=2, tx_day=1), REPEAT, None),
    # The first row of the day decides even when its own date is wrong.
    (tx(29, "wrong-then-right", tx_day=5), WRONG_DAY, None),
    (tx(30, "wrong-then-right"), REPEAT, None),
    # A wrong-day row does not claim the id for later days.
    (tx(31, "claims-nothing", tx_day=9), WRONG_DAY, None),
    (tx(32, "claims-nothing", file_day=2), None, True),
    (tx(40, "unknown", account="ACC-UNKNOWN"), None, False),
    (tx(41, "later", account="ACC-LATER"), None, False),
    (tx(42, "later-known", file_day=3, account="ACC-LATER"), None, True),
]


@pytest.fixture(scope="module")
def outcome(spark):
    bronze = frames.transactions(spark, [case[0] for case in CASES])
    deltas = [frames.account(1), frames.account(2, "ACC-LATER", file_day=3)]
    known = known_accounts(accepted(check_accounts(frames.accounts(spark, deltas))))
    codes = frames.codes(spark, [("ODD01", "ODD", "No sign", "XX", True)])
    return tag_transactions(check_transactions(bronze, codes), known)


def test_every_row_gets_its_reason(outcome):
    got = {
        r["_row_ordinal"]["line"]: (
            r["_rejection_reason"],
            r["_is_resolvable"] if r["_rejection_reason"] is None else None,
        )
        for r in outcome.collect()
    }
    want = {case[0][10][1]: (case[1], case[2]) for case in CASES}
    assert got == want


def test_split_is_exact(outcome):
    good = silver.promote_transactions(outcome, "r1")
    bad = silver.quarantine_transactions(outcome, "r1")
    assert good.count() + bad.count() == len(CASES)
    assert good.count() == sum(case[1] is None for case in CASES)


def test_source_values_are_kept_verbatim(outcome):
    bad = silver.quarantine_transactions(outcome, "r1")
    row = bad.where("transaction_id = 'nbsp'").first()
    assert row["channel"] == "\u00a0"
    assert row["_source_file"] == "transactions_2024-01-01.csv"


def test_signed_amounts(spark):
    rows = [tx(1, "debit"), tx(2, "credit", code="PAY01")]
    checked = check_transactions(frames.transactions(spark, rows), frames.codes(spark))
    signed = {r["transaction_id"]: float(r["_signed_amount"]) for r in checked.collect()}
    assert signed == {"debit": 10.0, "credit": -10.0}


def test_stored_ids_win_over_new_rows(spark):
    rows = [
        tx(1, "stored", file_day=2),
        tx(2, "stored", file_day=3),
        tx(3, "stored-wrong-day", file_day=2, tx_day=9),
        tx(4, "new", file_day=2),
    ]
    bronze = frames.transactions(spark, rows)
    known = known_accounts(accepted(check_accounts(frames.accounts(spark, [frames.account(1)]))))
    stored = spark.createDataFrame(
        [("stored",), ("stored",), ("stored-wrong-day",)], "transaction_id string"
    )
    tagged = tag_transactions(check_transactions(bronze, frames.codes(spark)), known, stored)
    got = {r["_row_ordinal"]["line"]: r["_rejection_reason"] for r in tagged.collect()}
    assert got == {1: REPEAT, 2: REPEAT, 3: REPEAT, 4: None}


def test_account_rules(spark):
    rows = [
        frames.account(1, "A"),
        frames.account(2, None),
        frames.account(3, "B", status="PENDING"),
        frames.account(4, "C", status=None),
        frames.account(5, "D", balance=None),
        frames.account(6, "E", status="active"),
        frames.account(7, "F", status="CLOSED", opened=None),
    ]
    tagged = check_accounts(frames.accounts(spark, rows))
    got = {r["_row_ordinal"]["line"]: r["_rejection_reason"] for r in tagged.collect()}
    status = "INVALID_ACCOUNT_STATUS"
    assert got == {1: None, 2: NULL, 3: status, 4: NULL, 5: NULL, 6: status, 7: NULL}
