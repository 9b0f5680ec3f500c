"""Ordered validation rules: the first rule a row breaks names its rejection reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.functions.money import signed_amount
from sediment.functions.text import missing_sql
from sediment.schemas import ACCOUNT_STATUSES, CHANNELS

REASON = "_rejection_reason"


@dataclass(frozen=True)
class Rule:
    """A rejection reason and the SQL condition under which a row earns it."""

    reason: str
    broken: str


def _one_of(values: list[str]) -> str:
    return ", ".join(f"'{value}'" for value in values)


TRANSACTION_RULES = [
    Rule(
        "NULL_REQUIRED_FIELD",
        missing_sql(
            ["transaction_id", "account_id", "transaction_code", "channel"],
            ["transaction_date", "amount"],
        ),
    ),
    Rule("INVALID_AMOUNT", "amount <= 0"),
    Rule("INVALID_TRANSACTION_CODE", "NOT _code_known"),
    Rule("INVALID_CHANNEL", f"channel NOT IN ({_one_of(CHANNELS)})"),
    Rule("INVALID_AMOUNT", "_signed_amount IS NULL OR _signed_amount = 0"),
]

ACCOUNT_RULES = [
    Rule(
        "NULL_REQUIRED_FIELD",
        missing_sql(
            ["account_id", "account_status"],
            [
                "open_date",
                "credit_limit",
                "current_balance",
                "billing_cycle_start",
                "billing_cycle_end",
            ],
        ),
    ),
    Rule("INVALID_ACCOUNT_STATUS", f"account_status NOT IN ({_one_of(ACCOUNT_STATUSES)})"),
]


def first_broken(rules: list[Rule]) -> Column:
    """Reason of the first broken rule, null for a clean row."""
    branches = " ".join(f"WHEN {rule.broken} THEN '{rule.reason}'" for rule in rules)
    return F.expr(f"CASE {branches} END")


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull())


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())


def with_code(transactions: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach the debit/credit indicator and the signed amount; ``_code_known`` says if matched.

    ``codes`` must hold one row per code (see ``contracts.duplicate_keys``). Spark broadcasts it
    by its size; else the join shuffles, and adaptive execution splits the partitions of frequent
    codes.
    """
    lookup = codes.selectExpr("transaction_code", "debit_credit_indicator", "true AS _matched")
    signed = signed_amount(F.col("amount"), F.col("debit_credit_indicator"))
    return transactions.join(lookup, "transaction_code", "left").select(
        *[F.col(name) for name in transactions.columns],
        "debit_credit_indicator",
        F.isnotnull("_matched").alias("_code_known"),
        signed.alias("_signed_amount"),
    )


def check_transactions(bronze: DataFrame, codes: DataFrame) -> DataFrame:
    """Row-level rules for transactions. Needs no shuffle."""
    return with_code(bronze, codes).withColumn(REASON, first_broken(TRANSACTION_RULES))


def check_accounts(bronze: DataFrame) -> DataFrame:
    """Row-level rules for account deltas. Needs no shuffle."""
    return bronze.withColumn(REASON, first_broken(ACCOUNT_RULES))
