"""The one-pass result must equal processing the days one after another."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import frames
from frames import tx
from sediment.operators.dedup import tag_transactions
from sediment.operators.lookup import known_accounts
from sediment.operators.rules import accepted, check_accounts, check_transactions
from sediment.operators.upsert import upsert_accounts
from sediment.plans import silver

REPEAT, WRONG_DAY = "DUPLICATE_TRANSACTION_ID", "INVALID_TRANSACTION_DATE"


def loop(rows, deltas, days, stored=(), stored_accounts=()):
    """One day after another, rows in file order, remembering what earlier days promoted."""
    promoted = {d: set(ids) for d, ids in dict(stored).items()}
    known, outcome = set(stored_accounts), {}
    for d in days:
        known |= {a[0] for a in deltas if a[11] == frames.day(d)}
        others = set().union(*[ids for other, ids in promoted.items() if other != d], set())
        seen, mine = set(), set()
        for row in sorted((r for r in rows if r[11] == frames.day(d)), key=lambda r: r[10]):
            if row[6] == "ATM":
                result = "INVALID_CHANNEL"
            elif row[0] in seen:
                result = REPEAT
            else:
                seen.add(row[0])
                if row[0] in others:
                    result = REPEAT
                elif row[2] != row[11]:
                    result = WRONG_DAY
                else:
                    mine.add(row[0])
                    result = row[1] in known
            outcome[row[10]] = result
        promoted[d] = mine
    return outcome, promoted, known


def made_up(seed, hot_share):
    """Few ids and accounts over eight days; one id and one account hold ``hot_share`` of rows."""
    rng = random.Random(seed)
    rows = []
    for line in range(600):
        file_day = rng.randint(1, 8)
        hot = rng.random() < hot_share
        rows.append(
            tx(
                line,
                "hot" if hot else f"T{rng.randint(1, 150)}",
                file_day=file_day,
                tx_day=file_day if rng.random() < 0.7 else rng.randint(1, 8),
                account="A-hot" if rng.random() < hot_share else f"A{rng.randint(1, 20)}",
                channel="ONLINE" if rng.random() < 0.8 else "ATM",
            )
        )
    deltas, line = [], 0
    for d in range(1, 9):
        for name in ["A-hot", *[f"A{n}" for n in range(1, 16)]]:
            if rng.random() < 0.15:
                deltas.append(frames.account(line, name, file_day=d, balance=str(line)))
                line += 1
    return rows, deltas


def one_pass(spark, rows, deltas, days, stored_ids=None, stored_accounts=None):
    picked = F.dayofmonth("date").isin(list(days))
    checked = check_transactions(frames.transactions(spark, rows).where(picked), frames.codes(spark))
    tagged_deltas = check_accounts(frames.accounts(spark, deltas).where(picked))
    known = known_accounts(accepted(tagged_deltas), stored_accounts)
    tagged = tag_transactions(checked, known, stored_ids)
    got = {
        tuple(r["_row_ordinal"]): r["_rejection_reason"]
        if r["_rejection_reason"]
        else r["_is_resolvable"]
        for r in tagged.collect()
    }
    return got, tagged, silver.promote_accounts(tagged_deltas, "r")


@pytest.mark.parametrize("seed", range(4))
def test_all_days_at_once(spark, seed):
    rows, deltas = made_up(seed, hot_share=0.33 if seed % 2 else 0.0)
    expected, _, _ = loop(rows, deltas, range(1, 9))
    got, _, promoted = one_pass(spark, rows, deltas, range(1, 9))
    assert got == expected
    latest = {}
    for a in deltas:
        if a[0] not in latest or a[11] > latest[a[0]][11]:
            latest[a[0]] = a
    accounts = {r["account_id"]: r["current_balance"] for r in upsert_accounts(promoted).collect()}
    assert accounts == {name: a[3] for name, a in latest.items()}


@pytest.mark.parametrize(
    "seed, first", [(10, [1, 2, 3]), (11, [2, 5, 6]), (12, [1, 2, 3, 4, 5, 6, 7]), (13, [4, 8])]
)
def test_on_top_of_stored_days(spark, seed, first):
    rows, deltas = made_up(seed, hot_share=0.33)
    rest = [d for d in range(1, 9) if d not in first]
    _, stored, known = loop(rows, deltas, first)
    expected, _, _ = loop(rows, deltas, rest, stored, known)
    ids = [(i,) for ids in stored.values() for i in ids]
    stored_accounts = spark.createDataFrame([(a,) for a in known], "account_id string")
    got, _, _ = one_pass(
        spark,
        rows,
        deltas,
        rest,
        spark.createDataFrame(ids, "transaction_id string"),
        stored_accounts,
    )
    assert got == {key: expected[key] for key in got}
    assert len(got) == sum(r[11].day in rest for r in rows)
