"""Each contract must be silent on good data and find a planted violation."""

from __future__ import annotations

import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import frames
from frames import day
from sediment.operators import contracts
from sediment.operators.compare import differing_groups, row_surplus, side_by_side
from sediment.operators.contracts import ContractViolation
from sediment.plans import gold
from sediment.schemas import RUN_LOG, SILVER_CODES


def promoted(spark, rows):
    """id, account, day of file, day of transaction, amount, signed, indicator, code, flag."""
    return spark.createDataFrame(
        rows,
        "transaction_id string, account_id string, date date, transaction_date date, "
        "amount decimal(18,4), _signed_amount decimal(18,4), debit_credit_indicator string, "
        "transaction_code string, _is_resolvable boolean, channel string",
    )


def row(id="T1", account="A", file_day=1, tx_day=None, amount=5, signed=5, sign="DR",
        code="PURCH01", flag=True):
    return (id, account, day(file_day), day(tx_day or file_day), Decimal(amount),
            None if signed is None else Decimal(signed), sign, code, flag, "ONLINE")


def test_row_surplus_counts_both_ways(spark):
    left = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, v int")
    right = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v int")
    got = {(r["k"], r["v"]): r["surplus"] for r in row_surplus(left, right, ["k", "v"]).collect()}
    assert got == {("a", 1): 1, ("c", 3): -1}
    assert contracts.missing_rows(right, left, ["k", "v"]).count() == 1
    assert contracts.missing_rows(left, left, ["k", "v"]).isEmpty()


def test_untraceable(spark):
    at = "date string, _row_ordinal struct<block: bigint, line: bigint>, v string"
    raw = spark.createDataFrame([("d1", (0, 1), None), ("d1", (0, 2), "b"), ("d2", (0, 1), "c")], at)
    rejects = spark.createDataFrame(
        [("d1", (0, 1), None), ("d1", (0, 2), "x"), ("d2", (0, 9), "c"), ("d2", (0, 1), "c")], at
    )
    found = contracts.untraceable(rejects, raw, ["v"])
    assert sorted(tuple(r)[2] for r in found.collect()) == ["c", "x"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan


def test_conservation(spark):
    days = spark.createDataFrame([(day(1),), (day(1),), (day(2),)], "date date")
    one = spark.createDataFrame([(day(1),)], "date date")
    assert contracts.conservation(days, days, one.limit(0)).isEmpty()
    gaps = {r["date"]: r["gap"] for r in contracts.conservation(days, one, one).collect()}
    assert gaps == {day(2): 1}
    counts = side_by_side("date", a=days, b=one).orderBy("date").collect()
    assert [(r["a"], r["b"]) for r in counts] == [(2, 1), (1, 0)]
    assert contracts.same_counts(days, days, "date").isEmpty()
    assert contracts.same_counts(days, one, "date").count() == 2


def test_unique_and_domain(spark):
    df = promoted(spark, [row("T1"), row("T1"), row("T2")])
    found = contracts.duplicate_keys(df, "transaction_id").collect()
    assert [(r["transaction_id"], r["rows"]) for r in found] == [("T1", 2)]
    reasons = spark.createDataFrame(
        [("INVALID_CHANNEL",), ("UNRESOLVABLE_ACCOUNT_ID",), (None,)], "_rejection_reason string"
    )
    bad = {r["_rejection_reason"] for r in contracts.unknown_reasons(reasons).collect()}
    assert bad == {"UNRESOLVABLE_ACCOUNT_ID", None}


def test_orphan_codes(spark):
    df = promoted(spark, [row(), row("T2", code="NEW01")])
    found = contracts.orphan_codes(df, frames.codes(spark)).collect()
    assert [r["transaction_code"] for r in found] == ["NEW01"]


def test_wrong_signs(spark):
    df = promoted(
        spark,
        [
            row("ok-debit"),
            row("ok-credit", signed=-5, sign="CR"),
            row("flipped", signed=-5),
            row("zero", amount=0, signed=0),
            row("null", signed=None),
            row("no-sign", sign="XX"),
        ],
    )
    bad = {r["transaction_id"] for r in contracts.wrong_signs(df).collect()}
    assert bad == {"flipped", "zero", "null", "no-sign"}


def test_wrong_flags(spark):
    known = spark.createDataFrame([("A", day(2))], "account_id string, known_from date")
    df = promoted(
        spark,
        [
            row("early-ok", file_day=1, flag=False),
            row("early-wrong", file_day=1, flag=True),
            row("late-ok", file_day=2, flag=True),
            row("late-wrong", file_day=3, flag=False),
            row("unknown-ok", account="B", flag=False),
            row("unknown-wrong", account="B", flag=True),
        ],
    )
    bad = {r["transaction_id"] for r in contracts.wrong_flags(df, known).collect()}
    assert bad == {"early-wrong", "late-wrong", "unknown-wrong"}


def test_places(spark):
    df = promoted(spark, [row("ok"), row("wrong", file_day=1, tx_day=2)])
    assert [r["transaction_id"] for r in contracts.misplaced_rows(df).collect()] == ["wrong"]
    raw = frames.transactions(spark, [frames.tx(1), frames.tx(2)]).withColumn(
        "date", F.when(F.col("_row_ordinal.line") == 2, F.lit(day(9))).otherwise(F.col("date"))
    )
    assert contracts.misfiled_rows(raw).count() == 1


def test_nulls_and_schema(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert contracts.null_counts(df, ["x", "y"]).first().asDict() == {"x": 1, "y": 2}
    assert contracts.missing_audit(df, ["x"]).count() == 1
    assert contracts.schema_differences(df, df.schema) == []
    other = spark.createDataFrame([], "x int, z string")
    assert contracts.schema_differences(df, other.schema) == ["x", "y", "z"]
    assert "affects_balance" in contracts.schema_differences(df, SILVER_CODES)


@pytest.fixture()
def marts(spark):
    silver = promoted(
        spark,
        [
            row("T1", file_day=1),
            row("T2", file_day=1, signed=-5, sign="CR", code="PAY01"),
            row("T3", file_day=2),
            row("T4", file_day=2, flag=False),
        ],
    )
    accounts = spark.createDataFrame(
        [("A", Decimal(7))], "account_id string, current_balance decimal(18,4)"
    )
    daily = gold.daily_summary(silver, "r1")
    weekly = gold.weekly_account_summary(silver, frames.codes(spark), accounts, "r1")
    return silver, daily, weekly, accounts


def test_marts_reconcile(spark, marts):
    silver, daily, weekly, accounts = marts
    codes = frames.codes(spark)
    assert contracts.daily_differences(daily, silver).isEmpty()
    assert contracts.weekly_differences(weekly, silver, codes).isEmpty()
    assert contracts.overstated_days(daily, silver).isEmpty()
    assert contracts.unbacked_accounts(weekly, accounts).isEmpty()
    assert contracts.mixed_runs(daily).isEmpty()
    totals = {r["transaction_date"]: r["total_transactions"] for r in daily.collect()}
    assert totals == {day(1): 2, day(2): 1}


def test_marts_that_do_not_reconcile(spark, marts):
    silver, daily, weekly, accounts = marts
    codes = frames.codes(spark)
    first = F.col("transaction_date") == F.lit(day(1))
    shifted = daily.withColumn("total_signed_amount", F.col("total_signed_amount") + 1)
    assert contracts.daily_differences(shifted, silver).count() == 2
    assert contracts.daily_differences(daily.where(first), silver).count() == 1
    more = daily.withColumn("total_transactions", F.col("total_transactions") + 1)
    assert contracts.overstated_days(more, silver).count() == 2
    fewer = weekly.withColumn("total_payments", F.lit(None).cast("decimal(18,4)"))
    assert contracts.weekly_differences(fewer, silver, codes).count() == 1
    assert contracts.unbacked_accounts(weekly, accounts.limit(0)).count() == 1
    other = daily.where(first).withColumn("_pipeline_run_id", F.lit("r2"))
    assert contracts.mixed_runs(daily.unionByName(other)).count() == 1


def test_run_log(spark):
    at = datetime(2024, 1, 1)
    log = spark.createDataFrame(
        [
            ("r1", "HISTORICAL", "m", "SILVER", at, at, "SUCCESS", 1, 1, 0, None, day(1)),
            ("r2", "HISTORICAL", "m", "SILVER", at, at, "FAILED", None, None, None, "x", day(2)),
            ("r3", "HISTORICAL", "m", "SILVER", at, at, "DONE", None, None, None, None, day(3)),
        ],
        RUN_LOG,
    )
    silver = spark.createDataFrame([("r1",), ("r2",), ("r2",), ("r9",)], "_pipeline_run_id string")
    bad = {r["_pipeline_run_id"] for r in contracts.orphan_runs(silver, log).collect()}
    assert bad == {"r2", "r9"}
    assert [r["run_id"] for r in contracts.invalid_log_rows(log).collect()] == ["r3"]


def test_require_empty(spark):
    df = spark.createDataFrame([("a",)], "x string")
    contracts.require_empty(df.limit(0), "fine")
    with pytest.raises(ContractViolation, match="broken.*'a'"):
        contracts.require_empty(df, "broken")


def test_raw_values_are_not_sent_to_trace_rejects(spark):
    at = "date string, _row_ordinal struct<block: bigint, line: bigint>, v string, w string"
    raw = spark.createDataFrame([("d1", (0, 1), None, "x"), ("d1", (0, 2), "x", None)], at)
    swapped = spark.createDataFrame([("d1", (0, 1), "x", None), ("d1", (0, 2), "x", None)], at)
    found = contracts.untraceable(swapped, raw, ["v", "w"])
    assert [tuple(r)[1:] for r in found.collect()] == [((0, 1), "x", None)] and found.columns == raw.columns
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    (sent,) = [line for line in plan.splitlines() if "AS _raw" in line]
    assert re.search(r"Project \[date#\d+, _row_ordinal#\d+, (named_)?struct\(", sent)


@pytest.mark.parametrize(
    "other, keys",
    [
        ([("a", 1, None), ("a", 2, "y"), ("b", 3, "z"), (None, 4, "n")], []),
        ([("b", 3, "z"), (None, 4, "n"), ("a", 2, "y"), ("a", 1, None)], []),
        ([("a", 1, "y"), ("a", 2, None), ("b", 3, "z"), (None, 4, "n")], ["a"]),
        ([("a", 1, None), ("a", 2, "y"), ("b", 3, "z"), ("b", 3, "z"), (None, 4, "n")], ["b"]),
        ([("a", 1, None), ("a", 2, "y"), ("c", 3, "z"), (None, 4, "m")], [None, "b", "c"]),
        ([], [None, "a", "b"]),
    ],
)
def test_differing_groups(spark, other, keys):
    schema = "k string, v int, w string"
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, "y"), ("b", 3, "z"), (None, 4, "n")], schema)
    found = differing_groups(rows, spark.createDataFrame(other, schema), "k", ["k", "v", "w"])
    assert sorted((r["k"] for r in found.collect()), key=str) == sorted(keys, key=str)
    assert "Sort" not in found._jdf.queryExecution().executedPlan().toString()
